import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa

from dayline.llm import phrases
from dayline.llm.phrases import Transducer, collocations, composed, tree, united
from dayline.llm.queries import PHRASES_SQL
from tests.llm.cases import documents, frame

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=10, contained=50, top=2000):
    counts, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i:i + size])] += 1
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, words), a in found.items():
        sides = [(counts[lang, words[:k]], counts[lang, words[k:]], k) for k in range(1, len(words))]
        score, _, left, right = min((10**6 * a * a // (x * y), k, x, y) for x, y, k in sides)
        holders = [b for (other, long), b in found.items() if other == lang and len(long) == 3 and len(words) == 2
                   and words in (long[:2], long[1:])] if len(words) == 2 else []
        if not any(100 * b >= contained * a for b in holders):
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s)
                  for lang, held in out.items() for i, (s, a, p, x, y) in enumerate(sorted(held)[:top]))


def corpus(n=150, seed=4):
    rng = random.Random(seed)
    words = "the of and New new York york city \u00e9t\u00e9 \u6f22 a\u00a0b x\x00y".split(" ")
    rows = documents(60)
    for i in range(n):
        text = "".join(rng.choice(words[:4 + i % 8]) + rng.choice([" ", " ", " ", " \t", ", ", ".", "\n", "\x0b", ""]) for _ in range(rng.randint(1, 120)))
        rows.append((2000 + i, text, rng.choice(["en", "de", None, "und", "\u00e9"]), "a", 0))
    return rows


def test_against_plain(spark):
    rows = corpus()
    docs = frame(spark, rows).withColumnsRenamed({"source": "phrase", "n_chars": "range", "doc_id": "n"})
    want = plain(rows)
    assert sorted(map(tuple, collocations(docs).collect())) == want
    assert len({r[0] for r in want}) >= 4 and any(r[2].count(" ") == 2 for r in want)


def test_many_chunks_and_ranges(spark):
    """Chunks of a few texts and ranges that cut between phrases of one first word."""
    rows = corpus(300, 5)
    docs = frame(spark, rows).repartition(5)
    for fan in (128, 3):  # 3: three rounds of cutting
        got = collocations(docs, least=3, top=40, chunk_bytes=3000, range_bytes=4000, fan=fan)
        assert sorted(map(tuple, got.collect())) == plain(rows, 3, top=40)
    assert len(phrases._bounds(docs.selectExpr("coalesce(lang, 'und') AS lang", "coalesce(text, '') AS text"), 4000)) > 9


def test_sql_on_cases(spark):
    rows = corpus(200, 6)
    con = duckdb.connect()
    con.register("documents", frame(spark, rows).toArrow())
    names = "lang, rank, phrase, a, l, r, n, score"
    want = sorted(map(tuple, con.sql(f"SELECT {names} FROM ({PHRASES_SQL})").fetchall()))
    assert sorted(map(tuple, collocations(frame(spark, rows)).collect())) == want


def some_tree(seed, n=400):
    rng = random.Random(seed)
    words = [rng.choice("abcdefg") * rng.randint(1, 2) for _ in range(n)]
    langs = np.sort(np.array([rng.randint(0, 1) for _ in range(n)]))
    new = np.array([i == 0 or rng.random() < 0.2 or langs[i] != langs[i - 1] for i in range(n)])
    return tree(pa.array([w.encode() for w in words]), langs, [b"x", b"y"], new)


def as_dict(t):
    labels, out = t.labels.to_pylist(), {}
    one = [(labels[a], labels[b]) for a, b in zip(t.lang, t.w1)]
    two = [(*one[p], labels[w]) for p, w in zip(t.p2, t.w2)]
    three = [(*two[p], labels[w]) for p, w in zip(t.p3, t.w3)]
    for names, counts in ((one, t.c1), (two, t.c2), (three, t.c3)):
        out |= {k: int(c) for k, c in zip(names, counts) if c}
    return out


def test_transducers_keep_counts_and_share_states():
    for seed in range(20):
        t = some_tree(seed)
        made = Transducer.of(t)
        assert as_dict(Transducer.loads(made.dumps()).tree()) == as_dict(t)
        assert len(made.s3) < len(t.w2)


def test_states_of_equal_hashes_stay_apart(monkeypatch):
    monkeypatch.setattr(phrases, "scramble", lambda h: h * np.uint64(0))
    t = some_tree(3)
    assert as_dict(Transducer.of(t).tree()) == as_dict(t)


def test_union_of_parts_and_composition():
    trees = [some_tree(s) for s in range(5)]
    want = Counter()
    for t in trees:
        want.update(as_dict(t))
    assert as_dict(united(trees)) == dict(want)
    keys = sorted(want)
    bounds = [keys[len(keys) * i // 7] for i in range(1, 7)] + [(b"x",), (b"y", b"zzz"), (b"x", b"a", b"", b"q")]
    bounds.sort()
    found = {}
    for t in trees[:1]:
        cuts = [(0, 0, 0), *t.cuts(bounds), (len(t.w1), len(t.w2), len(t.w3))]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            part = as_dict(t.part(a, b))
            assert all((i == 0 or bounds[i - 1] <= k) and (i == len(bounds) or k < bounds[i]) for k in part)
            found |= part
        assert found == as_dict(t)
    asked, whole = some_tree(77, 60), united(trees)
    one, two = composed(asked, whole)
    labels = asked.labels.to_pylist()
    assert [int(x) for x in one] == [want[labels[a], labels[b]] for a, b in zip(asked.lang, asked.w1)]
    assert [int(x) for x in two] == [want[labels[asked.lang[p]], labels[asked.w1[p]], labels[w]] for p, w in zip(asked.p2, asked.w2)]


def test_at_least():
    t = some_tree(9)
    assert as_dict(t.at_least(3)) == {k: c for k, c in as_dict(t).items() if c >= 3}


def test_products_beyond_64_bits(spark):
    """a = 5 * 10^9 gives 10^6 a^2 = 2.5 * 10^25; the same arithmetic on a table of counts."""
    a, left, right = 5 * 10**9, 7 * 10**9, 11 * 10**9
    row = spark.sql(f"SELECT cast(cast({a} AS decimal(19,0)) * {a}BD * 1000000BD AS decimal(38,0)) div cast({left}BD * {right}BD AS decimal(38,0)) AS s").first()
    assert row.s == 10**6 * a * a // (left * right)


def test_empty(spark):
    assert collocations(frame(spark, [])).count() == 0
    assert collocations(frame(spark, [(1, None, None, None, None), (2, " .,\t", "en", None, 0)])).count() == 0
