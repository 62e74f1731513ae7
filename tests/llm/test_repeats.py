import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from dayline.llm import repeats
from tests.llm.cases import documents, frame, prose


def plain(rows, n=repeats.LENGTH):
    """Each string by its first (doc, start); a byte goes if a string over it has an earlier one."""
    texts = [(r[1] or "").encode() for r in rows]
    key = [(repeats.NO_ID + (xxhash.xxh64(t, seed=42).intdigest() >> 2) if r[0] is None else r[0], t) for r, t in zip(rows, texts)]
    first: dict[bytes, tuple[int, int]] = {}
    for doc, text in key:
        for i in range(len(text) - n + 1):
            s = text[i:i + n]
            first[s] = min(first.get(s, (doc, i)), (doc, i))
    out = []
    for (doc, text), row in zip(key, rows):
        gone = bytearray(len(text) + 1)
        for i in range(len(text) - n + 1):
            if first[text[i:i + n]] < (doc, i):
                gone[i:i + n] = b"\1" * n
        runs = sum(gone[i] == 1 and (i == 0 or gone[i - 1] == 0) for i in range(len(text)))
        kept = bytes(c for c, g in zip(text, gone) if not g)
        out.append((row[0], len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(6)
    rows = documents(40)
    passage = [prose(rng, 40) for _ in range(5)]
    for i in range(60):
        parts = [prose(rng, rng.randrange(0, 30)) for _ in range(3)]
        p = passage[i % 5]
        a = rng.randrange(0, 80)
        parts.insert(rng.randrange(3), p[a:a + rng.choice([60, 99, 100, 101, 150, 400])])
        rows.append((rng.randrange(10**6), " ".join(parts), "en", "a", 0))
    base = prose(rng, 200)
    for i in range(30):  # near copies: one letter of each differs
        k = rng.randrange(len(base))
        rows.append((2_000_000 + i, base[:k] + "#" + base[k + 1:], "en", "hot", 0))
    rows += [(3_000_000, "ab" * 400, "en", "a", 0), (2_999_999, "ab" * 90, "en", "a", 0), (3_000_001, "é" * 300, "en", "a", 0),
             (5, base, "en", "a", 0), (5, passage[0], "en", "a", 0), (3_000_002, base + base, "en", "a", 0),
             (None, base, "en", "a", 0), (3_000_003, "x" * 99, "en", "a", 0), (3_000_004, "x" * 99, "en", "a", 0)]
    return rows


def test_against_plain(spark):
    rows = cases()
    docs = frame(spark, rows).withColumn("kept", F.lit("clash")).withColumn("doc", F.lit(1))
    got = repeats.remove_repeats(docs).collect()
    assert sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], key=repr) == plain(rows)
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and sum(x.hi - x.lo for x in r.removed) == r.n_removed for r in got)


@pytest.mark.parametrize("doc", [None, 5])
def test_rows_of_one_key(spark, doc):
    """Many rows without an id lose what they share; rows of one id do so where it stands elsewhere."""
    rng = random.Random(12)
    passage = prose(rng, 30)
    rows = [(doc, prose(rng, 3 + i % 7) + passage + prose(rng, 5), "en", "a", 0) for i in range(200)]
    rows += [rows[0]] * 40 + [(7, passage, "en", "a", 0)]
    got = repeats.remove_repeats(frame(spark, rows)).collect()
    assert sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], key=repr) == plain(rows)
    if doc is None:
        assert all(r.n_removed >= len(passage) for r in got if r.doc_id is None)


def test_pieces_of_long_texts(monkeypatch):
    rng = random.Random(9)
    text = prose(rng, 3000).encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    whole = repeats.segments(data, offsets)
    monkeypatch.setattr(repeats, "PIECE", 1000)
    parts = [np.concatenate(x) for x in zip(*repeats._pieces(data, offsets))]
    starts = lambda x: np.concatenate([np.arange(a, a + n) for a, n in zip(x[3], x[4])])
    assert (starts(whole) == np.arange(len(text) - 99)).all() and (starts(parts) == starts(whole)).all()
    for part in range(len(parts[0])):  # the gram of a segment depends on its bytes alone
        a, n, g = parts[3][part], parts[4][part], parts[5][part]
        i = np.searchsorted(whole[3], a, "right") - 1
        assert whole[0][i] == parts[0][part] and whole[3][i] + whole[5][i] == a + g
    assert (whole[4] <= repeats.LENGTH - repeats.GRAM + 1).all()


def test_suffix_order_is_sorted():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(0, 12))).encode() for _ in range(30)]
    text, length, flat = repeats.suffix_order(texts)
    assert len(flat) == len(texts) * (max(map(len, texts)) + 1)
    got = [texts[t][len(texts[t]) - n:] for t, n in zip(text, length)]
    assert got == sorted(got) and len(got) == sum(len(t) + 1 for t in texts)


@pytest.mark.parametrize("block", [3, 2048])
def test_groups_in_blocks_and_open(block, monkeypatch):
    """Segments of groups, some too large for a block, in batches that cut groups."""
    import pyarrow as pa
    monkeypatch.setattr(repeats, "BLOCK_SEGMENTS", block)
    monkeypatch.setattr(repeats, "LARGE", block)
    rng = random.Random(2)
    passages, rows = [prose(rng, 40) for _ in range(4)], []
    for doc in range(60):  # documents that share passages of about LENGTH bytes: many segments a gram
        p = passages[doc % 4]
        cut = rng.randrange(0, 60)
        data = np.frombuffer((prose(rng, 20) + p[cut:cut + rng.randrange(80, 180)] + prose(rng, 20)).encode(), np.uint8)
        kh, _, _, at, n, _ = repeats.segments(data, np.array([0, len(data)]))
        rows += [(int(k.view(np.int64)), doc, int(x), data[x:x + y + 99].tobytes()) for k, x, y in zip(kh, at, n)]
    rows.sort(key=lambda r: r[:3])
    batches = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[i:i + 4]], t) for k, t in (
        (0, pa.int64()), (1, pa.int64()), (1, pa.int64()), (2, pa.int64()), (3, pa.binary()))], names=["kh", "doc", "th", "at", "segment"]) for i in range(0, len(rows), 4)]
    closed, opened = set(), []
    for out in repeats._in_groups(iter(batches)):
        for r in out.to_pylist():
            if r["open"]:
                opened.append((r["kh"], r["ch"], (r["doc"], r["lo"])))
            else:
                closed |= {(r["kh"], r["doc"], x) for x in range(r["lo"], r["hi"] - repeats.LENGTH + 1)}
    least = {}
    for kh, ch, place in opened:
        least[kh, ch] = min(least.get((kh, ch), place), place)
    closed |= {(kh, *place) for kh, ch, place in opened if place != least[kh, ch]}
    first, want = {}, set()
    strings = [(kh, s[o:o + 100], (doc, at + o)) for kh, doc, at, s in rows for o in range(len(s) - 99)]
    for kh, s, place in strings:
        first[kh, s] = min(first.get((kh, s), place), place)
    want = {(kh, *place) for kh, s, place in strings if place != first[kh, s]}
    assert closed == want and (bool(opened) == (block == 3))


def test_empty(spark):
    assert repeats.remove_repeats(frame(spark, [])).count() == 0
