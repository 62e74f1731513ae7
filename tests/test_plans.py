"""Shapes of physical plans that matter at scale."""

import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from dayline.models.grid import Config
from dayline.models.series import fold_forecasts
from dayline.operators.aggregates import best_per_key, daily, high_water_mark, histogram, pivot_sum, top_k
from dayline.operators.filters import scan_between
from dayline.operators.incremental import new_rows, rewind
from dayline.operators.joins import newest_per_key
from dayline.operators.regression import ols_residuals, sums_of_products
from dayline.operators.windows import (daily_change, densify, ffill, hold_last, lags, latest_row,
                                       running_total)
from dayline.session import scratch_path
from dayline.sinks.audit import audit_keys
from dayline.sinks.tables import insert_if_absent

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_series_chain_shuffles_once(spark):
    days = spark.read.parquet(f"{SF_DIR}/events.parquet").groupBy(
        "user_id", F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    before = plan(days).count("Exchange hashpartitioning")
    chain = ffill(densify(days, ["user_id"], "date"), ["user_id"], "date")
    chain = daily_change(running_total(chain, ["user_id"], "date", {"n": "t"}), ["user_id"], "date", {"n": "c"})
    chain = lags(chain, ["user_id"], "date", "n", [1, 7])
    assert plan(chain).count("Exchange hashpartitioning") == before + 1


def test_filters_and_columns_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    text = plan(scan_between(orders, "o_orderdate", "1997-01-01", "1997-12-31").select("o_orderkey"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate", text)
    assert "o_totalprice" not in text


def test_pivot_is_one_aggregate(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    text = plan(pivot_sum(orders, ["o_orderdate"], "o_orderstatus", ["F", "O"], {"o_totalprice": "p"}))
    assert text.count("Exchange") == 1 and "partial_sum" in text


def test_groups_are_cut_before_they_are_shuffled(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    assert "WindowGroupLimit" in plan(top_k(orders, ["o_orderstatus"], [F.col("o_totalprice").desc()], 3))
    text = plan(best_per_key(orders, ["o_orderstatus"], {"o_totalprice": "desc"}))
    assert "partial_min" in text and "Window" not in text


def test_hot_keys_are_combined_before_the_shuffle(spark):
    """Every reduction to one row per key has a partial step, so a hot key is small on arrival."""
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").withColumn("date", F.to_date("ts"))
    reductions = {
        "daily": daily(events, ["user_id"], "ts", {"n": F.count(F.lit(1))}),
        "mark": high_water_mark(events, "date", ["user_id"]),
        "newest": newest_per_key(events, ["user_id"], "event_id"),
        "latest": latest_row(events, ["user_id"], "ts"),
        "insert": insert_if_absent(events, events.filter("event_type = 'view'"), ["user_id"], "event_id"),
        "regression": sums_of_products(events, ["event_type"], "value", ["user_id"]),
        "keys": audit_keys(events, ["user_id"]),
        "scenario": hold_last(events, ["user_id"], "date", ["value"], 3),
    }
    for name, df in reductions.items():
        text = plan(df)
        assert "partial_" in text and "Window" not in text, name


def test_rows_meet_the_numbers_of_their_key_where_they_are(spark):
    """Raw rows are not dealt by key to attach what an aggregate has found for it."""
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    old = lines.filter("l_shipdate < DATE '1995-01-01'")
    for df in (histogram(lines, "l_extendedprice", 10, ["l_returnflag"]),
               ols_residuals(lines, ["l_returnflag"], "l_extendedprice", ["l_quantity"]),
               new_rows(lines, old, ["l_returnflag"], "l_shipdate"), rewind(lines, old, ["l_returnflag"], "l_shipdate")):
        text = plan(df)
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
        assert "partial_" in text or "Exchange hashpartitioning" not in text


def test_scoring_asks_for_its_tasks(spark):
    days = spark.read.parquet(f"{SF_DIR}/events.parquet").groupBy(
        "event_type", F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    text = plan(fold_forecasts(days, ["event_type"], "date", "n", [], [Config(1)] * 40, 3, block=4))
    assert "REPARTITION_BY_NUM" in text


def test_a_cluster_needs_a_shared_folder():
    def session(master, folder):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: folder),
                               sparkContext=SimpleNamespace(master=master))

    assert scratch_path(session("spark://head:7077", "/shared"), "t").startswith("/shared/t-")
    assert scratch_path(session("local[2]", None), "t")
    with pytest.raises(ValueError):
        scratch_path(session("spark://head:7077", None), "t")
