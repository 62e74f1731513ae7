import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dayline.operators.aggregates import fold_stats
from dayline.operators.incremental import new_rows, rewind
from dayline.operators.windows import (daily_change, densify, difference, ffill, fold_table, hold_last,
                                       last_n, latest_row, moving_trend, running_total, walk_forward)

FIRST = dt.date(2021, 1, 1)


def at(n):
    return FIRST + dt.timedelta(n)


def series(spark, values, key="a"):
    return spark.createDataFrame([(key, at(n), v) for n, v in values], "k string, date date, v double")


def test_missing_days_leading_and_trailing_nulls(spark, rows):
    df = series(spark, [(0, None), (1, 4.0), (4, 6.0), (6, None)]).unionByName(
        series(spark, [(2, 1.0)], "b"))
    dense = densify(df, ["k"], "date")
    assert dense.count() == 7 + 1
    filled = ffill(dense, ["k"], "date", flag="filled")
    assert [(r["v"], r["filled"]) for r in filled.filter("k = 'a'").orderBy("date").collect()] == [
        (None, False), (4.0, False), (4.0, True), (4.0, True), (6.0, False), (6.0, True), (6.0, True)]
    again = ffill(filled.drop("filled"), ["k"], "date")
    assert rows(again) == rows(filled.drop("filled"))


def test_densify_without_keys(spark):
    df = series(spark, [(0, 1.0), (3, 2.0)]).drop("k")
    assert densify(df, [], "date").count() == 4


@pytest.mark.parametrize("cut", [0, 1, 17, 39])
def test_increments_equal_one_run(spark, rows, cut):
    rng = random.Random(cut)
    data = [(k, at(n), rng.randrange(9), rng.randrange(100)) for k in "abc" for n in range(40)
            if rng.random() < 0.8]
    df = spark.createDataFrame(data, "k string, date date, new int, level int")

    def build(part, seed=None):
        out = running_total(part, ["k"], "date", {"new": "total"}, seed)
        return daily_change(out, ["k"], "date", {"level": "change"}, seed)

    whole = build(df)
    before = build(df.filter(F.col("date") <= at(cut)))
    later = new_rows(df, before, ["k"], "date")
    assert rows(before.unionByName(build(later, latest_row(before, ["k"], "date")))) == rows(whole)


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("bucket", [1, 7, 1000])
def test_buckets_do_not_change_results(spark, rows, keys, bucket):
    rng = random.Random(bucket)
    data = [(k, at(n), None if rng.random() < 0.4 else rng.randrange(50)) for k in "ab" for n in range(45)
            if rng.random() < 0.9 and (keys or k == "a")]
    df = spark.createDataFrame(data, "k string, date date, v int")
    seed = spark.createDataFrame([("a", 100)], "k string, t int")
    plain = running_total(df, keys, "date", {"v": "t"}, seed)
    assert rows(running_total(df, keys, "date", {"v": "t"}, seed, bucket)) == rows(plain)
    filled = ffill(df, keys, "date", ["v"], flag="f")
    assert rows(ffill(df, keys, "date", ["v"], flag="f", bucket_days=bucket)) == rows(filled)


def test_change_of_total_is_the_daily_value(spark):
    df = series(spark, [(n, float(n % 5)) for n in range(30)])
    out = daily_change(running_total(df, ["k"], "date", {"v": "t"}), ["k"], "date", {"t": "c"})
    assert out.filter("c <> v").count() == 0


def test_seed_is_used_on_the_first_row_only(spark):
    df = spark.createDataFrame([("a", at(1), 5), ("a", at(2), None), ("a", at(3), 9)],
                               "k string, date date, level int")
    seed = spark.createDataFrame([("a", at(0), 2)], "k string, date date, level int")
    out = daily_change(df, ["k"], "date", {"level": "c"}, seed)
    assert [r["c"] for r in out.orderBy("date").collect()] == [3, None, None]


def test_new_key_starts_at_the_epoch(spark, rows):
    src = spark.createDataFrame([("a", dt.date(2020, 2, 22)), ("a", dt.date(2020, 2, 23))], "k string, date date")
    assert rows(new_rows(src, src.limit(0), ["k"], "date", "2020-02-23")) == [("a", dt.date(2020, 2, 23))]
    assert new_rows(src, src.limit(0), ["k"], "date").count() == 2


def test_rewind_keeps_other_keys(spark, rows):
    df = spark.createDataFrame([(k, at(n)) for k in "ab" for n in range(4)], "k string, date date")
    late = spark.createDataFrame([("a", at(2))], "k string, date date")
    assert rows(rewind(df, late, ["k"], "date")) == [("a", at(0)), ("a", at(1))] + [("b", at(n)) for n in range(4)]


def public_rule(n, splits, cap):
    size = n // (splits + 1)
    starts = range(n - splits * size, n, size)
    return [(s, min(size, cap) if cap else size) for s in starts][:splits]


@pytest.mark.parametrize("n, splits, cap", [(23, 4, None), (100, 9, 7), (45, 10, 3), (11, 10, None)])
def test_folds_follow_the_public_rule(spark, n, splits, cap):
    df = series(spark, [(i, float(i)) for i in range(n)])
    folds = fold_table(df, ["k"], splits, cap).orderBy("fold").collect()
    assert [(r["train_size"], r["test_size"]) for r in folds] == public_rule(n, splits, cap)
    stats = fold_stats(fold_table(df, ["k"], splits, cap), ["k"]).first()
    assert (stats["train_min"], stats["train_max"]) == (folds[0]["train_size"], folds[-1]["train_size"])
    members = walk_forward(df, ["k"], "date", splits, cap).collect()
    for fold, (train, test) in enumerate(public_rule(n, splits, cap)):
        assert sorted(r["v"] for r in members if r["fold"] == fold and r["role"] == "train") == list(range(train))
        assert sorted(r["v"] for r in members if r["fold"] == fold and r["role"] == "test") \
            == list(range(train, train + test))


def test_too_short_for_folds(spark):
    df = series(spark, [(0, 1.0), (1, 2.0)])
    assert fold_table(df, ["k"], 5).count() == 0
    assert walk_forward(df, ["k"], "date", 5).count() == 0


def test_last_n(spark):
    out = last_n(series(spark, [(n, float(n)) for n in range(5)]), ["k"], "date", 2)
    assert {r["v"]: r["role"] for r in out.collect()} == {0: "train", 1: "train", 2: "train", 3: "test", 4: "test"}


def test_differences_undo(spark):
    df = series(spark, [(n, float(n * n)) for n in range(12)])
    twice = difference(df, ["k"], "date", "v", d=2)
    assert {r["v"] for r in twice.collect()} == {2.0} and twice.count() == 10
    assert difference(df, ["k"], "date", "v", d=0, D=1, m=7).count() == 5


def test_even_period_trend_halves_its_ends(spark):
    out = moving_trend(series(spark, [(n, float(n)) for n in range(6)]), ["k"], "date", "v", 4)
    assert [r["trend"] for r in out.orderBy("date").collect()] == [None, None, 2.0, 3.0, None, None]


def test_scenario_holds_last_known_value(spark, rows):
    df = series(spark, [(0, 1.0), (1, 3.0), (2, None)])
    assert rows(hold_last(df, ["k"], "date", ["v"], 3)) == [("a", at(n), 3.0) for n in (3, 4, 5)]
