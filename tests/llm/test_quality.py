import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayline.llm import quality as q
from tests.llm.cases import documents, frame, prose


def plain_model(texts, order):
    """Interpolated modified Kneser-Ney from its definition, on dictionaries."""
    grams = Counter()
    for t in texts:
        b = bytes([q.PAD]) * (order - 1) + t.encode()
        grams.update(b[i:i + order] for i in range(len(b) - order + 1))
    levels = {order: grams}
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    cuts, totals, weights = {}, {}, {}
    for n, counts in levels.items():
        c = [sum(v == k for v in counts.values()) for k in (1, 2, 3, 4)]
        y = c[0] / (c[0] + 2 * c[1]) if c[0] else 0.5
        raw = [k - (k + 1) * y * c[k] / c[k - 1] if c[k - 1] else 0.5 * k for k in (1, 2, 3)]
        cuts[n] = [min(max(d, 0.1 * k), 0.95 * k) for k, d in enumerate(raw, 1)]
        total, freed = defaultdict(int), defaultdict(float)
        for g, v in counts.items():
            total[g[:-1]] += v
            freed[g[:-1]] += cuts[n][min(v, 3) - 1]
        totals[n], weights[n] = total, {h: freed[h] / total[h] for h in total}

    def p(gram):
        if not gram:
            return 1 / 256
        n, h = len(gram), gram[:-1]
        if h not in totals[n]:
            return p(gram[1:])
        v = levels[n].get(gram, 0)
        own = (v - cuts[n][min(v, 3) - 1]) / totals[n][h] if v else 0
        return own + weights[n][h] * p(gram[1:])
    return p


@pytest.mark.parametrize("order", [2, 5])
def test_model_against_its_definition(spark, order):
    rng = random.Random(7)
    texts = [prose(rng, 30) for _ in range(20)] + ["é"]
    model = q.kneser_ney(spark.createDataFrame([(t,) for t in texts], "text string"), order)
    p = plain_model(texts, order)
    rows = [(1, prose(rng, 50), "en", "a", 0), (2, "QQ??\x01 the", "en", "a", 0), (3, None, "en", "a", 0), (4, "", "en", "a", 0)]
    for r in q.scored(frame(spark, rows), model, order).collect():
        text = (r.text or "").encode()
        b = bytes([q.PAD]) * (order - 1) + text
        want = sum(math.log10(p(b[i:i + order])) for i in range(len(text)))
        assert r.n_bytes == len(text) and r.log_prob == pytest.approx(want, rel=1e-4, abs=1e-6)
        assert (r.bits is None) == (not text)
    assert sum(p(b"\n" * (order - 1) + bytes([x])) for x in range(256)) == pytest.approx(1)


def test_junk_goes_and_clean_stays(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, 60), "en" if i % 2 else None, "a", 0) for i in range(200)]
    rows += [(1000 + i, "".join(chr(rng.randrange(33, 127)) for _ in range(300)), "en" if i % 2 else None, "a", 0) for i in range(20)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 200, 2)], "doc_id long, quality int, toxic int")
    got = q.classify(frame(spark, rows).withColumn("bits", F.lit("x")), labels).collect()
    assert len(got) == 220 and {r.doc_id for r in got if not r.accepted} == set(range(1000, 1020))
    kept = q.accepted_documents(frame(spark, rows).withColumn("bits", F.lit("x")), labels)
    assert kept.count() == 200 and {r.bits for r in kept.collect()} == {"x"}


def test_copies_do_not_set_the_threshold(spark):
    rng = random.Random(9)
    junk, plain = "".join(chr(rng.randrange(33, 127)) for _ in range(300)), "the of and " * 80
    rows = [(i, prose(rng, 60), "en" if i % 2 else "de", "a", 0) for i in range(200)]
    rows += [(1000 + i, junk, "en", "a", 0) for i in range(300)] + [(2000 + i, plain, "de", "a", 0) for i in range(300)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 40)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.accepted for r in q.classify(frame(spark, rows), labels).collect()}
    assert not any(got[1000 + i] for i in range(300)) and all(got[i] for i in range(200))


def test_repeated_words_and_fragments_go(spark):
    rng = random.Random(10)
    words = ["".join(rng.choices("etaoinsrhldu", k=rng.randrange(2, 9))) for _ in range(400)]

    def text(n):
        return " ".join(rng.choices(words, k=n))
    rows = [(i, text(rng.randrange(40, 400)), "en", "a", 0) for i in range(500)]
    junk = [" ".join([w] * 300) for w in ("the", "Verung", "ea", "nthabl", "hareb")]
    junk += [" | ".join(w + "." for w in rng.choices(words, k=120)) for _ in range(5)] + [(words[0] + " " + words[1] + "\n") * 200]
    rows += [(1000 + i, t, "en", "a", 0) for i, t in enumerate(junk)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 500)], "doc_id long, quality int, toxic int")
    got = q.classify(frame(spark, rows), labels).collect()
    assert [(junk[r.doc_id - 1000][:20], r.bits, r.threshold) for r in got if r.accepted and r.doc_id >= 1000] == []
    assert sum(not r.accepted for r in got if r.doc_id < 1000) <= 5


def test_bounds_of_a_thin_language(spark):
    """Ten trusted texts of a language: its junk goes and its clean texts stay."""
    rng = random.Random(11)

    def text(letters, n):
        words = ["".join(rng.choices(letters, k=rng.randrange(2, 8))) for _ in range(150)]
        return " ".join(rng.choices(words, k=n))
    rows = [(i, prose(rng, rng.randrange(40, 200)), "en", "a", 0) for i in range(300)]
    words = ["".join(rng.choices("αβγδεζηικλμνοπρστυ", k=rng.randrange(2, 8))) for _ in range(80)]
    rows += [(500 + i, " ".join(rng.choices(words, k=rng.randrange(60, 200))), "el", "a", 0) for i in range(60)]
    junk = ["".join(chr(rng.randrange(33, 127)) for _ in range(400)) for _ in range(5)] + [text("qxzjkvw#%&", 60)] * 3
    rows += [(900 + i, t, "el", "a", 0) for i, t in enumerate(junk)]
    labels = spark.createDataFrame([(i, 1, 0) for i in [*range(300), *range(500, 510)]], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in q.classify(frame(spark, rows), labels).collect()}
    assert not any(got[900 + i].accepted for i in range(len(junk)))
    assert sum(not got[500 + i].accepted for i in range(60)) <= 2 and sum(not got[i].accepted for i in range(300)) <= 3


def test_copies_stay_on_one_side(spark):
    """No text is in the model and among those that calibrate, whatever the ids of its copies."""
    rows = [(i, f"text {i % 40} of some words", "en", "a", 0) for i in range(400)] + [(None, "text 1 of some words", "en", "a", 0)] * 50
    labels = spark.createDataFrame([(i, 1, 0) for i in range(400)], "doc_id long, quality int, toxic int")
    sample = [r.text for r in q.trusted_sample(frame(spark, rows), labels).collect()]
    kept = {r.text for r in frame(spark, rows).where(q.kept_out(F.xxhash64("text"))).select("text").distinct().collect()}
    assert len(sample) == len(set(sample)) and not kept & set(sample) and len(kept) + len(sample) == 40 and kept


def test_the_model_is_of_all_trusted_texts(spark):
    """Long texts, and more of one language than a bounded sample had room for."""
    rows = [(i, f"text {i} of one language", "en", "a", 0) for i in range(900)] + [(2000, "long words " * 3000, "de", "a", 0)]
    labels = spark.createDataFrame([(r[0], 1, 0) for r in rows], "doc_id long, quality int, toxic int")
    got = sorted(r.text for r in q.trusted_sample(frame(spark, rows), labels).collect())
    assert got == sorted(r.text for r in frame(spark, rows).where(~q.kept_out(F.xxhash64("text"))).collect())
    assert len(got) > 500


def test_only_chosen_texts_are_shuffled(spark, capsys):
    """Where labels are not broadcast, texts still go through one exchange only, behind a filter of ids."""
    rows = [(i, f"text {i % 300} of some words", "en", "a", 0) for i in range(900)] + [(None, "text 7 of some words", "en", "a", 0)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 900, 3)], "doc_id long, quality int, toxic int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = q.trusted_sample(frame(spark, rows), labels)
        got.explain("formatted")
        texts = sorted(r.text for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    trusted = frame(spark, rows).where(F.col("doc_id") % 3 == 0)
    assert texts == sorted(r.text for r in trusted.where(~q.kept_out(F.xxhash64("text"))).select("text").distinct().collect())
    exchanged = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out)
    assert len(exchanged) == 2 and sum("text#" in x or "min#" in x for x in exchanged) == 1


def test_a_carried_text_is_written_once(spark, monkeypatch):
    """Scores are stored with the documents: each column of theirs once."""
    written, stored = {}, q.stored
    monkeypatch.setattr(q, "stored", lambda df, name: written.setdefault(name, df.schema) and stored(df, name))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(5)], "doc_id long, quality int, toxic int")
    docs = frame(spark).withColumn("name", F.lit("x")).withColumn("n_bytes", F.lit("y")).withColumn("a.b", F.lit("z"))
    kept = q.accepted_documents(docs, labels)
    assert kept.columns == docs.columns and {(r.name, r.n_bytes, r["a.b"]) for r in kept.collect()} == {("x", "y", "z")}
    assert written["scores"].simpleString().count("text:string") == 1


def test_every_language_is_in_the_sample(spark):
    rows = [(i, f"text {i} of language {i % 12}", f"l{i % 12}" if i % 12 else None, "a", 0) for i in range(120)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(120)], "doc_id long, quality int, toxic int")
    got = Counter(r.text.split()[-1] for r in q.trusted_sample(frame(spark, rows), labels, 3).collect())
    assert set(got) == {str(i) for i in range(12)} and set(got.values()) == {3}


def test_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = q.classify(frame(spark), none).collect()
    assert len(got) == len(documents())
    assert all(r.accepted == (r.n_bytes > 0) for r in got)
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    assert q.classify(frame(spark, []), labels).count() == 0
    assert q.classify(frame(spark), labels).count() == len(documents())


def test_byte_scores_without_tables():
    assert np.allclose(q.byte_scores(np.arange(5, dtype=np.uint64), {}, 3), -math.log10(256))
