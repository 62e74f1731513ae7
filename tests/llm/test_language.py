import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from dayline.llm import language
from tests.llm.cases import frame

SOUNDS = {"en": "th er on an re he in ed nd ha".split(), "de": "sch ein ich ung gen ver ge tz ö ü".split(),
          "fr": "eau tion é è que eux oi ou aux ç".split()}


def rows(n=300, seed=2):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(SOUNDS))
        words = ["".join(rng.choices(SOUNDS[lang], k=rng.randrange(1, 4))) for _ in range(rng.randrange(5, 80))]
        out.append((i, " ".join(words), lang, "a", 0))
    return out


def test_held_out_accuracy_and_odd_rows(spark):
    odd = [(1000, None, "en", "a", 0), (1001, "", "de", "a", 0), (1002, "12 !? 34", "fr", "a", 0), (1003, "漢", None, "a", 0),
           (None, "th er on", None, None, None), (1004, "sch ein ich ungen " * 20000, "de", "a", 0)]
    data = rows() + odd + [rows()[3]]
    got = language.identify(frame(spark, data).withColumn("score", F.lit("clash"))).collect()
    assert len(got) == len(data)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 1000]
    assert len(held) > 40 and np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    for r in got:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and (r.lang_pred == "und") == (r.doc_id in (1000, 1001, 1002))
        assert not (r.accepted and r.lang_pred == "und")
    assert {r.doc_id: r.lang_pred for r in got}[1004] == "de"


def test_held_out_labels_and_ids_do_not_matter(spark):
    a = rows(120)
    b = [(i, t, None if zlib.crc32(str(i).encode()) % 4 == 2 else lang, None, n) for i, t, lang, _, n in a]
    first, second = ({r.doc_id: (r.lang_pred, r.score) for r in language.identify(frame(spark, x)).collect()} for x in (a, b))
    assert first == second


def test_nothing_to_learn(spark):
    got = language.identify(frame(spark, [(1, "the", None, "a", 0), (2, None, "en", "a", 0)])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
    assert language.identify(frame(spark, [])).count() == 0


def test_buckets_are_those_of_each_gram():
    data = np.frombuffer("Aé".encode(), np.uint8)
    padded = b" a" + "é".encode() + b" "
    want = sorted(((int.from_bytes(padded[i:i + n], "big") + (n << 40)) * 0x9E3779B97F4A7C15 % (1 << 64)) >> 50
                  for n in (1, 2, 3, 4) for i in range(len(padded) - n + 1))
    assert sorted(language.buckets(data).tolist()) == want


def plain_answer(text, model):
    """Language and score from their definition, one n-gram at a time."""
    if not any(map(str.isalpha, text or "")):
        return "und", 0.0
    padded = b" " + text.encode().lower() + b" "  # bytes.lower is A-Z alone
    total, n = np.zeros(len(model["langs"])), 0
    for size in (1, 2, 3, 4):
        for i in range(len(padded) - size + 1):
            total += model["table"][((int.from_bytes(padded[i:i + size], "big") + (size << 40)) * 0x9E3779B97F4A7C15 % (1 << 64)) >> 50]
            n += 1
    e = np.exp((total / n + model["bias"]) / model["temperature"])
    return model["langs"][int(e.argmax())], float((e / e.sum()).max())


def test_predictions_against_their_definition(spark):
    rng = np.random.default_rng(6)
    model = {"langs": ["de", "en", "fr"], "table": rng.normal(size=(language.BUCKETS, 3)).astype(np.float32) * 3,
             "bias": np.array([0.1, -0.2, 0.0]), "temperature": 0.7, "reject": 0.6}
    texts = [r[1] for r in rows(60)] + [None, "", "12 !? 34", "漢", "x", "ÀÉ Ñandú", "\t\n", "Sch EIN ich ungen " * 400, *"abcdefghijklmnop"]
    got = language.predict(frame(spark, [(i, t, None, "a", 0) for i, t in enumerate(texts)]), model).collect()
    assert len(got) == len(texts)
    for r in got:
        lang, score = plain_answer(r.text, model)
        assert r.lang_pred == lang and abs(r.score - score) < 1e-4 and r.accepted == (lang != "und" and r.score >= 0.6)
    assert {r.lang_pred for r in got} == {"de", "en", "fr", "und"} and {r.accepted for r in got} == {True, False}


def test_many_languages(spark):
    letters = [chr(0x4E00 + i) for i in range(70 * 6)]
    rng = random.Random(4)
    data = [(i, " ".join(rng.choices(letters[i % 70 * 6:i % 70 * 6 + 6], k=30)), f"l{i % 70}", "a", 0) for i in range(70 * 12)]
    data += [(5000 + i, "12 34", "l3", "a", 0) for i in range(100)]  # nothing to learn from
    got = [r for r in language.identify(frame(spark, data)).collect() if r.held_out and r.doc_id < 5000]
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.9
    assert len({r.lang_pred for r in got}) == len({r.lang for r in got}) > 64
    few = language.training_sample(frame(spark, data), sample_docs=30).collect()
    assert sorted(r.lang for r in few) == sorted({f"l{i}" for i in range(70)})
    assert len(language.train([(f"l{i}", np.array([i]), np.ones(1, np.float32)) for i in range(70)], epochs=1)["langs"]) == 70
