import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from dayline.llm import simhash
from dayline.llm.components import components
from tests.llm.cases import documents, frame, prose


def plain_fingerprint(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    grams = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, bits=4):
    """The least id that is reachable, from (id, fingerprint)."""
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for (i, a), (j, b) in combinations(enumerate(fps), 2):
        if (a[1] ^ b[1]).bit_count() <= bits:
            label[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(fps):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [least.get(root(i)) for i in range(len(fps))]


def test_triples_cover_all_sets_of_four():
    assert len(simhash.TRIPLES) == 20
    assert all(any(set(t) <= set(four) for t in simhash.TRIPLES) for four in combinations(range(8), 4))


def near_rows():
    rng = random.Random(3)
    rows = documents(50)
    base = prose(rng, 300).split()
    for i in range(40):  # a chain of small edits
        base = base[:]
        base[rng.randrange(300)] = "edit" + str(i)
        rows.append((500 + i, " ".join(base), "en", "hot", 0))
    return rows


def test_against_plain(spark):
    rows = near_rows()
    got = simhash.near_duplicates(frame(spark, rows).withColumn("fp", F.lit(1))).collect()
    fps = [(r[0], plain_fingerprint(r[1])) for r in rows]
    want = sorted(zip([f[0] for f in fps], [f[1] for f in fps], plain_components(fps)), key=repr)
    assert sorted([(r.doc_id, r.fp % (1 << 64), r.component_id) for r in got], key=repr) == want
    assert len({w[2] for w in want}) < len(want) - 5


@pytest.mark.parametrize("refine", [20_000, 60])
def test_links_in_dense_postings(spark, refine):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2**63, 6, dtype=np.uint64)
    fps = set(rng.integers(0, 2**63, 300, dtype=np.uint64).tolist())
    for s in seeds:
        for _ in range(250):
            x = int(s)
            for bit in rng.integers(0, 64, rng.integers(0, 6)):
                x ^= 1 << int(bit)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    named = {r.node: r.label for r in components(simhash.links(df, refine_above=refine)).collect()}
    groups = {}
    for x, least in zip(fps, plain_components([(x, x) for x in fps])):
        signed = x - (1 << 64) if x >> 63 else x
        groups.setdefault(least, set()).add(named.get(signed, signed))
    assert all(len(labels) == 1 for labels in groups.values())
    assert len({next(iter(v)) for v in groups.values()}) == len(groups) > 200


def test_one_of_each(spark):
    rows = near_rows()
    kept = simhash.one_of_each(frame(spark, rows))
    ids = [r.doc_id for r in kept.collect()]
    fps = [(r[0], plain_fingerprint(r[1])) for r in rows if r[0] is not None]
    assert {i for i in ids if i is not None} == set(plain_components(fps)) and ids.count(None) == 2
    assert simhash.one_of_each(frame(spark, [])).count() == 0


def test_one_row_of_each_component(spark):
    rng = random.Random(9)
    text, other, third = (prose(rng, 200) for _ in range(3))
    rows = [(None, text, "en", "a", 0)] * 3 + [(5, text, "en", "a", 0)] + [(3, other, "en", "a", 0)] * 2 \
        + [(3, text, "en", "a", 0)] + [(None, third, "en", "a", 0)] * 4 + [(7, third + " end", "en", "a", 0)] * 2 \
        + [(None, "alone and without an id", "de", "b", 1)] * 2
    assert (plain_fingerprint(third) ^ plain_fingerprint(third + " end")).bit_count() <= 4
    got = sorted(map(tuple, simhash.one_of_each(frame(spark, rows)).collect()), key=repr)
    assert got == sorted([(3, other, "en", "a", 0), (3, text, "en", "a", 0), (7, third + " end", "en", "a", 0),
                          (None, "alone and without an id", "de", "b", 1)], key=repr)


def test_components_of_long_chains_and_hubs(spark):
    rows = [(i, i + 1) for i in range(400)] + [(1000, 1001 + i) for i in range(300)] + [(5000, 5000)]
    label = {r.node: r.label for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert len({label[i] for i in range(401)}) == 1 and len({label[1000 + i] for i in range(301)}) == 1
    assert len(set(label.values())) == 3 and len(label) == 401 + 301 + 1
