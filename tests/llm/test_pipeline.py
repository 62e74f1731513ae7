import hashlib
import random
from collections import defaultdict

import corpus_pipeline
from dayline.llm import sharding
from tests.llm import test_decontamination, test_mixing_sharding, test_simhash
from tests.llm.cases import SCHEMA, prose


def tables():
    """Documents, labels and benchmark; the ids of the documents that the classifier must reject."""
    rng = random.Random(21)
    place = {i: "hot" if i % 3 == 0 else rng.choice(["a", "B", "é", None]) for i in range(3000)}
    rows = [(i, prose(rng, rng.randrange(60, 200)), "en" if i % 2 else "de", place[i], i) for i in range(220)]
    rows += [(300 + i, rows[i % 3][1] + (" end" if i % 2 else ""), "en", "hot", None) for i in range(60)]  # groups of copies
    long = prose(rng, 400).split()
    for i in range(12):  # a chain of small edits
        long[rng.randrange(400)] = f"ingou{i}"
        rows.append((400 + i, " ".join(long), "en", place[i], 1))
    items = [(i, prose(rng, rng.choice([4, 10, 30]))) for i in range(8)] + [(8, None), (9, "")]
    rows += [(500 + i, rows[i][1] + " " + text.upper() + ", " + prose(rng, 90), "en", place[i], 1) for i, (_, text) in enumerate(items[:8])]
    rows += [(None, prose(rng, 120), "en", "a", 1), (None, rows[5][1], "en", "hot", 1)]
    junk = [(1000 + i, "".join(chr(rng.randrange(33, 127)) for _ in range(400)), "en", "hot", 1) for i in range(20)]
    junk += [(1100, None, "en", "a", 1), (1101, "", None, None, 0), (1102, None, None, None, None)]
    labels = [(i, 1, 0) for i in range(0, 220, 2)] + [(1000, 0, 1), (None, 1, 0), (1, None, None)]
    return rows + junk, labels, items, {r[0] for r in junk}


def number(*parts):
    return int(hashlib.md5(":".join("" if p is None else str(p) for p in parts).encode()).hexdigest()[:8], 16)


def one_of_each(rows):
    fps = [(i, test_simhash.plain_fingerprint(r[1])) for i, r in enumerate(rows)]
    groups = defaultdict(list)
    for label, row in zip(test_simhash.plain_components(fps), rows):
        groups[label].append(row)
    return [min(group, key=lambda r: (r[0] is None, r[0])) for group in groups.values()]


def leak_free(rows, items):
    # rows without an id are told apart by their place
    marks = test_decontamination.plain([(i, r[1]) for i, r in enumerate(rows)], items)
    return [rows[i] for i, _, hits, _ in sorted(marks) if not hits]


def mixed(rows):
    sizes, by_source = defaultdict(int), defaultdict(list)
    for r in rows:
        n = len(test_mixing_sharding.WORD.findall(r[1]))
        sizes[r[3]] += n
        by_source[r[3]].append((number("mix", r[0], r[1]), n, r))
    out = []
    for source, target in test_mixing_sharding.water_level(sizes).items():
        left = int(target + 1e-9)
        while left > 0:
            for _, n, row in sorted(by_source[source], key=lambda x: x[0]):
                if left > 0:
                    out.append(row)
                left -= n
    return out


def test_all_stages_against_plain_ones(spark, tmp_path):
    rows, labels, items, rejected = tables()
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    good = [r for r in rows if r[0] not in rejected]
    single = one_of_each(good)
    clean = leak_free(single, items)
    mix = mixed(clean)
    assert len(rows) > len(good) > len(single) > len(clean) > 150 and len(mix) > len(set(mix)) > 100
    table = sharding.lookup_table(sharding.shard_names(sharding.SHARDS))
    slots = [number("slot", r[0]) % sharding.SLOTS for r in mix]
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert result.columns == [*(f.split()[0] for f in SCHEMA.split(", ")), "slot", "shard"]
    assert sorted(map(tuple, result.collect()), key=repr) == sorted([(*r, s, table[s]) for r, s in zip(mix, slots)], key=repr)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
