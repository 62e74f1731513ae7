import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dayline.llm import mixing, sharding
from dayline.llm.queries import MIX_SQL
from tests.llm.cases import SCHEMA, documents, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_level(sizes, weights=(3, 1, 2), share=1.5, limit=2.0):
    """Targets by reshares in turn, as the rule is worded."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > limit * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in open_}
        for s in full:
            target[s] = limit * sizes[s]
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


@pytest.mark.parametrize("range_rows", [20_000, 3])
def test_targets_and_budgets(spark, range_rows):
    docs = frame(spark)
    got = mixing.mix(docs, range_rows=range_rows).collect()
    assert len(got) == len(documents())
    sizes = defaultdict(int)
    for _, text, _, source, _ in documents():
        sizes[source] += len(WORD.findall(text or ""))
    want = water_level(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(taken[s] == int(want[s] + 1e-9) for s in sizes)


def test_rerun_and_partitioning_agree(spark):
    docs = frame(spark)
    a = sorted(map(tuple, mixing.mix(docs).collect()), key=repr)
    assert a == sorted(map(tuple, mixing.mix(docs.repartition(7), range_rows=2).collect()), key=repr)


def test_null_ids_spread_over_ranges(spark):
    """Rows without an id get keys of their own, so no range of keys holds them all."""
    rows = [(None, f"text {i} of many", "en", "hot", 0) for i in range(3000)]
    docs = frame(spark, rows)
    keys = docs.select(mixing.unit_hash("mix", F.col("doc_id"), F.col("text")).alias("k"))
    per = keys.groupBy(F.shiftright("k", 27)).count().agg(F.max("count"), F.count("*")).first()
    assert per[0] < 200 and per[1] == 32
    got = mixing.mix(docs, range_rows=100).collect()
    assert sum(r.taken for r in got) == 18_000 and {r.target for r in got} == {18_000.0}


def test_many_sources_without_broadcast(spark, monkeypatch):
    want = sorted(map(tuple, mixing.mix(frame(spark)).collect()), key=repr)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(tuple, mixing.mix(frame(spark), range_rows=5).collect()), key=repr) == want


def test_documents_of_the_mix(spark):
    docs = frame(spark).withColumn("name", F.lit("clash")).withColumn("taken", F.lit(-1))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    share = {(r.doc_id, r.source, r.size): r.taken for r in mixing.mix(docs).collect()}
    times = defaultdict(int)
    for r in mixed.collect():
        assert r.taken == -1 and r.name == "clash"
        times[r.doc_id, r.source, len(WORD.findall(r.text))] += 1
    for key, n in times.items():
        if sum(1 for d in documents() if (d[0], d[3]) == key[:2]) == 1:
            assert n == -(-share[key] // key[2])


def test_empty_and_wordless(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    rows = mixing.mix(frame(spark, [(1, None, None, None, None), (2, " ", None, "a", 1)])).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2


def test_sql_agrees_on_cases(spark):
    unique = list({d[0]: d for d in documents()}.values())
    con = duckdb.connect()
    con.register("documents", frame(spark, unique).toArrow())
    want = sorted(map(tuple, con.sql(f"SELECT doc_id, size, taken FROM ({MIX_SQL})").fetchall()), key=repr)
    got = mixing.mix(frame(spark, unique)).select("doc_id", "size", "taken").collect()
    assert sorted(map(tuple, got), key=repr) == want


def test_lookup_table_is_even_and_stable():
    names = sharding.shard_names(8)
    table = sharding.lookup_table(names, 809)
    counts = [table.count(i) for i in range(8)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == 809
    fewer = sharding.lookup_table(names[:-1], 809)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 7)
    assert moved < 0.35 * 809
    for bad in ((names, 800), ([], 809), (["a", "a"], 809), (names, 7)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


def test_placement(spark):
    docs = frame(spark).withColumn("shard", F.lit("old"))
    placed = sharding.place(docs)
    assert placed.columns == [c for c in docs.columns if c != "shard"] + ["slot", "shard"]
    table = sharding.lookup_table(sharding.shard_names(sharding.SHARDS))
    rows = placed.collect()
    assert len(rows) == len(documents()) and all(table[r.slot] == r.shard for r in rows)
    assert len({r.slot for r in rows if r.doc_id is None}) == 1
    assert sharding.place(frame(spark, [])).count() == 0


def test_shards_as_folders(spark, tmp_path):
    sharding.write_shards(sharding.place(frame(spark), 3, 101), str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == len(documents()) and {r.shard for r in back.select("shard").distinct().collect()} <= {0, 1, 2}


def test_stage_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "leaks", "mixing", "shards"]
    assert SCHEMA.startswith("doc_id")
