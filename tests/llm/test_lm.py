import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayline.llm import lm
from tests.llm.cases import documents, frame


def out(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w] + [None]


@pytest.mark.parametrize("chunk_bytes", [1 << 23, 2000])
def test_base_and_shape(spark, chunk_bytes):
    rows = documents(80)
    got = lm.score(frame(spark, rows).withColumn("score", F.lit("clash")).withColumn("chunk", F.lit(1)), chunk_bytes=chunk_bytes).collect()
    times = Counter(w for r in rows if not out(r[0]) for w in words(r[1]))
    n, v = sum(times.values()), len(times)
    want = sorted([(r[0], out(r[0]), len(words(r[1])), sum(times[w] > 0 for w in words(r[1])), n,
                    round(sum(math.log10((times[w] + 1) / (n + v + 1)) for w in words(r[1])), 6)) for r in rows], key=repr)
    assert sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got], key=repr) == want
    assert all(r.score < 0 and (r.bits_per_byte is None) == (r.n_bytes == 0) for r in got)


def test_what_is_held_out_is_not_learned(spark):
    rows = documents(80)
    changed = [r if not out(r[0]) else (r[0], "qqq zzz " * 50, *r[2:]) for r in rows]
    one, two = ({(r.doc_id, r.n_bytes): r.score for r in lm.score(frame(spark, x)).collect() if not r.held_out} for x in (rows, changed))
    assert one == two


def test_known_words_are_likelier_than_unknown():
    known = [b"the", b"ertion", b"ingou", lm.END]
    zeros, ones = np.zeros(lm._STARTS[-1]), np.zeros(lm._STARTS[-1])
    lm.bit_counts(known, np.array([500, 100, 100, 50]), zeros, ones)
    model = lm.learn([b"the ertion the ingou the the"] * 40, zeros, ones)
    s = dict(zip(known + [b"xqjkz9", b"thing"], lm.token_scores(known + [b"xqjkz9", b"thing"], model)))
    assert s[b"the"] > s[b"ertion"] > s[b"xqjkz9"] and s[b"thing"] > s[b"xqjkz9"] - 3
    assert sum(10 ** s[w] for w in known) < 1


def test_weights_are_learned_from_all_training_texts(spark, monkeypatch):
    """Also from a long one, of which a sample of short texts has nothing; parts add up alike in each run."""
    keep, fit = [], lm.fit
    monkeypatch.setattr(lm, "fit", lambda *args: keep.append(fit(*args)) or keep[-1])
    taught = [i for i in range(20) if not out(i)]
    rows = [(taught[0], " ".join(f"w{i}x{i * 7 % 31}" for i in range(6000)), None, None, None)]
    lm.score(frame(spark, rows)).count()
    assert len(np.unique(keep[0]["weights"])) > 100
    monkeypatch.setattr(lm, "TASK_TOKENS", 1000)
    for _ in range(2):
        lm.score(frame(spark, rows).repartition(3)).count()
    assert all((keep[1][k] == keep[2][k]).all() for k in keep[1])


def test_counts_join_the_spelled_probabilities():
    spelled, c = np.log10([0.2, 0.1, 0.05, 1e-300]) + [0, 0, 0, -300], np.array([5, 1, 0, 0])
    off = lm.discount(1, 1)
    got = lm.with_counts(spelled, c, 6, 2, off)
    rest = off * 2 / 6
    assert off == pytest.approx(1 / 3) and np.isfinite(got).all()
    assert 10 ** got[:3] == pytest.approx([(5 - off) / 6 + rest * 0.2, (1 - off) / 6 + rest * 0.1, rest * 0.05])
    assert sum(np.maximum(c - off, 0)) / 6 + rest == pytest.approx(1)  # so the sum over all tokens is one as well
    assert (lm.with_counts(spelled, c, 0, 0, lm.discount(0, 0)) == spelled).all()


def test_bits_of_a_byte_sum_to_one():
    """All continuations of a prefix by one byte: their probabilities sum to that of the prefix."""
    zeros, ones = np.zeros(lm._STARTS[-1]), np.zeros(lm._STARTS[-1])
    lm.bit_counts([b"a", b"ab", b"b", lm.END], np.array([5, 3, 2, 4]), zeros, ones)
    model = lm.learn([b"a ab b"] * 20, zeros, ones)
    one = [bytes([x]) for x in range(256)]  # spelled as a byte and a blank: less than the byte alone
    total = sum(10 ** lm.token_scores(one, model)) + 10 ** lm.token_scores([lm.END], model)[0]
    assert 0.3 < total <= 1 + 1e-6


def test_spelling_and_contexts():
    data, offsets = lm.spell([b"ab", lm.END, b"ab"])
    assert data.tobytes() == b"ab \nab " and offsets.tolist() == [0, 3, 4, 7]
    for h in lm.context_hashes(data, offsets):
        assert (h[0:3] == h[4:7]).all()  # what stands before a token does not matter
    whole = lm.context_hashes(*lm.spell([b"ab", b"ba"]))[-1]
    assert whole[2] != whole[5]  # the order of the bytes does


def test_empty_and_untrained(spark):
    assert lm.score(frame(spark, [])).count() == 0
    held = next(i for i in range(100) if out(i))
    r = lm.score(frame(spark, [(held, "a b", None, None, None), (held, None, None, None, None)])).collect()
    assert sorted((x.n_tokens, x.n_known, x.train_tokens, x.base_score) for x in r) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]


def test_every_text_is_predicted_in_its_order(spark):
    """Texts of the same tokens: what stands before a token counts, also beyond it."""
    taught = [i for i in range(400) if not out(i)][:200]
    held = [i for i in range(400) if out(i)][:2]
    rows = [(i, "red green blue " * 8, None, None, None) for i in taught]
    rows += [(held[0], "red green blue " * 8, None, None, None), (held[1], "green red blue " * 8, None, None, None)]
    got = {r.doc_id: r for r in lm.score(frame(spark, rows)).collect()}
    usual, turned = got[held[0]], got[held[1]]
    assert usual.n_tokens == turned.n_tokens and usual.base_score == pytest.approx(turned.base_score)
    assert usual.score > turned.score + 3
    assert usual.score > usual.base_score  # which knows the tokens but not what follows what


def taught_model(texts):
    counts = np.zeros(lm._STARTS[-1], np.int64)
    lm.add_fours(*lm.spell_texts(texts), None, counts)
    return lm.learn(texts, *lm.by_bit(counts))


def test_next_bytes_sum_to_one_and_texts_stand_alone():
    texts = [b"the cat sat on the mat"] * 20 + ["été élève Zoë 7%".encode()] * 5
    model = taught_model(texts)
    for before in (b"", b"the ", b"the cat s", b"the cat sat on the mat \xc3"):
        pieces = [before + bytes([x]) + b" " for x in range(256)]
        ends = np.cumsum([len(p) for p in pieces])
        scores = lm.byte_scores(np.frombuffer(b"".join(pieces), np.uint8), np.concatenate(([0], ends)), model)
        assert 0.99 < sum(10 ** scores[ends - 2]) <= 1 + 1e-6  # the longest code can spell usual bytes as well
    together, sizes = next(lm.text_scores(texts[-8:], model))
    alone = [next(lm.text_scores([t], model))[0] for t in texts[-8:]]
    assert (together == np.concatenate(alone)).all() and sizes.tolist() == [len(lm.tokens(t)) for t in texts[-8:]]


def test_plain_version_of_counts_and_mix():
    """Counts bit by bit and the mix of one text, in plain loops over what each predictor looks back on."""
    texts = [b"one two one two three", "Où 3 % one".encode()]
    data, offsets = lm.spell_texts(texts)
    hashes = np.stack(lm.context_hashes(data, offsets))
    k, zeros, ones = len(lm.CONTEXTS), np.zeros(lm._STARTS[-1]), np.zeros(lm._STARTS[-1])
    for _, bit, _, base, within in lm.bits(data, hashes):
        for i in range(k):
            for s, b in zip(base[i] + within, bit):
                (ones if b else zeros)[s] += 1
    counts = np.zeros(lm._STARTS[-1], np.int64)
    lm.add_fours(data, offsets, None, counts)
    assert all((a == b).all() for a, b in zip(lm.by_bit(counts), (zeros, ones)))
    model, want = lm.learn(texts, zeros, ones), np.zeros(len(data))
    for where, bit, node, base, within in lm.bits(data, hashes):
        for j, at in enumerate(np.arange(len(data))[where]):
            own = [int(model["table"][base[i, j] + within[j]]) for i in range(k)]
            gate = (own[-1] % 4 + 4 * (own[-2] % 4)) * lm.NODES + node[j]
            x = min(max(sum((v // 4) / lm._FINE * model["weights"][gate, i] for i, v in enumerate(own)), -12), 12)
            place = (x + 12) * 2
            low = min(int(place), 47)
            r = model["refined"][gate]
            p = (1 / (1 + math.exp(-x)) + r[low] + (r[low + 1] - r[low]) * (place - low)) / 2
            want[at] += math.log10(p if bit[j] else 1 - p)
    assert lm.byte_scores(data, offsets, model) == pytest.approx(want, abs=1e-4)
    whole = lm.context_hashes(*lm.spell_texts([b"a b c", b"x b c", b"y z"]))
    assert whole[-1][2] != whole[-1][9] and whole[-1][4] == whole[-1][11]  # the token before, not the one before that
    assert whole[1][0] == whole[1][7] == whole[1][14] != whole[1][1]  # contexts do not run on from text to text
