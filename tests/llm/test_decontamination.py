import random
import re

from pyspark.sql import functions as F

from dayline.llm import decontamination as d
from tests.llm.cases import documents, frame, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TABLE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(TABLE))


def plain(docs, items, n=10):
    grams = {}
    for item, text in items:
        w = words(text)
        if item is not None:
            for i in range(max(1, len(w) - n + 1) if w else 0):
                grams.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    out = []
    for doc in docs:
        w, hit, ids = words(doc[1]), set(), set()
        for i in range(len(w)):
            for k in range(1, n + 1):
                if i + k <= len(w) and (found := grams.get(tuple(w[i:i + k]))):
                    hit |= set(range(i, i + k))
                    ids |= found
        out.append((doc[0], len(w), len(hit), tuple(sorted(ids))))
    return sorted(out, key=repr)


def planted():
    rng = random.Random(4)
    items = [(i, prose(rng, rng.choice([0, 1, 4, 9, 10, 11, 30]))) for i in range(30)]
    items += [(30, None), (31, ""), (None, "the of and"), (32, items[5][1]), (33, "É漢字 Ñandú x9")]
    docs = documents(40)
    for i in range(25):
        a = items[i][1]
        docs.append((1000 + i, prose(rng, 8) + "! " + a.upper().replace(" ", ", ") + "; " + prose(rng, 5), "en", "a", 0))
    docs.append((2000, "x É漢字 ñandú X9 É漢字 Ñandú x9", "en", "a", 0))
    return docs, items


def run(spark, **options):
    docs, items = planted()
    found = d.find_leaks(frame(spark, docs).withColumn("hit_items", F.lit("clash")),
                         spark.createDataFrame(items, "item_id long, text string"), **options)
    rows = found.select("doc_id", "n_words", d.hit_words().alias("n"), "hit_items").collect()
    return sorted([(r.doc_id, r.n_words, r.n, tuple(r.hit_items)) for r in rows], key=repr), plain(docs, items)


def test_against_plain(spark):
    got, want = run(spark)
    assert got == want and sum(r[2] > 0 for r in want) > 20


def test_in_blocks(spark):
    got, want = run(spark, block_windows=40)
    assert got == want


def test_empty_tables_and_removal(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    docs = frame(spark)
    assert d.leak_free(docs, items).count() == len(documents())
    assert d.find_leaks(frame(spark, []), items).count() == 0
    item = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    one = frame(spark, [(1, "Say alpha, BETA now", "en", "a", 0), (2, "alpha", "en", "a", 0)])
    found = d.find_leaks(one, item)
    assert {r.doc_id: r.t for r in found.select("doc_id", d.without_spans(F.col("text"), F.col("hit_spans")).alias("t")).collect()} \
        == {1: "say now", 2: "alpha"}
    assert [r.doc_id for r in d.leak_free(one, item).collect()] == [2]
