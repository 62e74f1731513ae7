"""Grouped reductions and rankings."""

from pyspark.sql import functions as F

from dayline.functions.columns import reband, rmse, row_sum
from dayline.operators.aggregates import (availability, best_per_key, fold_stats, high_water_mark,
                                          histogram, mean_se, null_profile, pivot_sum,
                                          series_profile, top_k, total, unbanded_count)
from dayline.operators.windows import fold_table
from dayline.queries import query
from dayline.queries.columns import age_text
from dayline.queries.tables import event_days, event_days_sql, order_days, order_days_sql, table


@query("SELECT CAST(sum(l_quantity) AS BIGINT) AS quantity, count(*) AS lines FROM lineitem")
def grand_total(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("long").alias("quantity"),
                                                    F.lit(1).cast("long").alias("lines"))
    return total(lines, ["quantity", "lines"])


@query("SELECT user_id, CAST(max(ts) AS DATE) AS latest FROM events GROUP BY 1")
def newest_day_per_user(spark, sf_dir):
    return high_water_mark(table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("d")),
                           "d", ["user_id"])


@query("SELECT CAST(max(l_shipdate) AS DATE) AS latest FROM lineitem")
def newest_day_of_all(spark, sf_dir):
    return high_water_mark(table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("d")), "d")


@query("""
    SELECT CAST(o_orderdate AS DATE) AS date,
           count(*) FILTER (WHERE o_orderstatus = 'F') AS orders_F,
           count(*) FILTER (WHERE o_orderstatus = 'O') AS orders_O,
           count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS orders,
           round(coalesce(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 0), 2) AS price_F,
           round(coalesce(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 0), 2) AS price_O,
           round(coalesce(sum(o_totalprice) FILTER (WHERE o_orderstatus IN ('F', 'O')), 0), 2) AS price
    FROM orders GROUP BY 1""")
def pivot_with_totals(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("date"), "o_orderstatus", F.lit(1).cast("long").alias("one"),
        "o_totalprice")
    wide = pivot_sum(orders, ["date"], "o_orderstatus", ["F", "O"],
                     {"one": "orders", "o_totalprice": "price"})
    return wide.withColumns({c: F.round(c, 2) for c in ("price_F", "price_O", "price")})


_BANDED = """
    b AS (SELECT l.*, CASE WHEN p_size >= 46 THEN 2
                 WHEN p_size * 2 + CASE WHEN p_size % 7 = 0 THEN 20 ELSE 9 END < 30 THEN 0
                 WHEN p_size * 2 >= 60 THEN 2
                 WHEN p_size * 2 >= 30 AND p_size * 2 + CASE WHEN p_size % 7 = 0 THEN 20 ELSE 9 END < 60
                 THEN 1 END AS band FROM lineitem l JOIN part ON p_partkey = l_partkey)"""


def _banded_lines(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"),
                                                reband(age_text(F.col("p_size"))).alias("band"))
    return table(spark, sf_dir, "lineitem").join(parts, "l_partkey")


@query(f"""
    WITH {_BANDED}
    SELECT l_returnflag, CAST(l_shipdate AS DATE) AS date,
           CAST(coalesce(sum(l_quantity) FILTER (WHERE band = 0), 0) AS BIGINT) AS quantity_ag0,
           CAST(coalesce(sum(l_quantity) FILTER (WHERE band = 1), 0) AS BIGINT) AS quantity_ag1,
           CAST(coalesce(sum(l_quantity) FILTER (WHERE band = 2), 0) AS BIGINT) AS quantity_ag2,
           CAST(coalesce(sum(l_quantity) FILTER (WHERE band IS NOT NULL), 0) AS BIGINT) AS quantity
    FROM b GROUP BY 1, 2""")
def banded_pivot_per_day(spark, sf_dir):
    lines = _banded_lines(spark, sf_dir).select(
        "l_returnflag", F.to_date("l_shipdate").alias("date"), "band",
        F.col("l_quantity").cast("long").alias("l_quantity"))
    return pivot_sum(lines, ["l_returnflag", "date"], "band", [0, 1, 2], {"l_quantity": "quantity"},
                     name="{col}_ag{value}")


@query(f"WITH {_BANDED} SELECT l_returnflag, count(*) FILTER (WHERE band IS NULL) AS rejected FROM b GROUP BY 1")
def rows_left_out_of_pivot(spark, sf_dir):
    return unbanded_count(_banded_lines(spark, sf_dir), "band", [0, 1, 2], ["l_returnflag"])


@query("""
    SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_custkey END
                            + CASE WHEN o_totalprice < 1000 THEN 0 ELSE o_orderkey END AS BIGINT) AS total
    FROM orders""")
def row_sums_without_nulls(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    a = F.when(F.col("o_orderstatus") != "F", F.col("o_custkey"))
    b = F.when(F.col("o_totalprice") >= 1000, F.col("o_orderkey"))
    return orders.select("o_orderkey", row_sum([a, b]).alias("total"))


@query("""
    SELECT s_nationkey, s_suppkey, level FROM (
        SELECT s_nationkey, s_suppkey, CAST(floor(s_acctbal / 2500) AS BIGINT) AS level,
               CAST(length(s_name) + s_suppkey % 2 AS INTEGER) AS elev FROM supplier)
    QUALIFY rank() OVER (PARTITION BY s_nationkey ORDER BY level DESC, elev) = 1""")
def best_suppliers_with_ties(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(
        "s_nationkey", "s_suppkey", F.floor(F.col("s_acctbal") / 2500).cast("long").alias("level"),
        (F.length("s_name") + F.col("s_suppkey") % 2).cast("int").alias("elev"))
    return best_per_key(suppliers, ["s_nationkey"], {"level": "desc", "elev": "asc"}).drop("elev")


@query("""
    SELECT 'event_id' AS "column", 0 AS nulls UNION ALL
    SELECT 'value', count(*) FILTER (WHERE event_type = 'error') FROM events UNION ALL
    SELECT 'props', count(*) FILTER (WHERE user_id < 20) FROM events""")
def null_counts(spark, sf_dir):
    return null_profile(table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.when(F.col("user_id") >= 20, F.col("props")).alias("props")))


@query("""
    WITH seen AS (
        SELECT user_id, bool_and(value < 80) AS low_available, bool_and(event_type <> 'error') AS quiet_available
        FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' GROUP BY 1)
    SELECT o_custkey AS user_id, coalesce(low_available, false) AS low_available,
           coalesce(quiet_available, false) AS quiet_available,
           CAST(coalesce(low_available, false) AS INTEGER)
           + CAST(coalesce(quiet_available, false) AS INTEGER) AS n_sensors
    FROM (SELECT DISTINCT o_custkey FROM orders) LEFT JOIN seen ON user_id = o_custkey""")
def available_measures(spark, sf_dir):
    stations = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id")).distinct()
    readings = table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("date"), F.when(F.col("value") < 80, F.col("value")).alias("low"),
        F.when(F.col("event_type") != "error", F.lit(1)).alias("quiet"))
    return availability(stations, readings, "user_id",
                        {"low": "low_available", "quiet": "quiet_available"}, "date",
                        "2024-01-10", "2024-01-12")


@query("""
    SELECT l_suppkey, round(avg(l_quantity), 9) AS quantity_mean,
           round(stddev_samp(l_quantity) / sqrt(count(*)), 6) AS quantity_se
    FROM lineitem GROUP BY 1""")
def mean_and_standard_error(spark, sf_dir):
    out = mean_se(table(spark, sf_dir, "lineitem").withColumnRenamed("l_quantity", "quantity"),
                  "quantity", ["l_suppkey"])
    return out.select("l_suppkey", F.round("quantity_mean", 9).alias("quantity_mean"),
                      F.round("quantity_se", 6).alias("quantity_se"))


@query("""
    SELECT l_returnflag, CASE WHEN bool_or(p_retailprice IS NULL) THEN 1000000.0
           ELSE round(sqrt(avg((l_extendedprice / l_quantity - p_retailprice) ** 2)), 4) END AS score
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND (l_returnflag <> 'R' OR p_size < 40)
    GROUP BY 1""")
def error_with_penalty(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size")
    lines = table(spark, sf_dir, "lineitem")
    match = (F.col("p_partkey") == F.col("l_partkey")) & ((F.col("l_returnflag") != "R")
                                                          | (F.col("p_size") < 40))
    return (lines.join(parts, match, "left").groupBy("l_returnflag")
            .agg(F.round(rmse(F.col("l_extendedprice") / F.col("l_quantity"), "p_retailprice"), 4)
                 .alias("score")))


@query(f"""
    SELECT event_type, min(date) AS first_date, max(date) AS last_date, count(*) AS n_rows,
           CAST(2 AS INTEGER) AS n_columns FROM ({event_days_sql("event_type")}) GROUP BY 1""")
def profile_of_series(spark, sf_dir):
    return series_profile(event_days(spark, sf_dir, "event_type"), ["event_type"], "date")


@query(f"""
    WITH s AS (SELECT o_orderpriority, count(*) AS n, count(*) // 31 AS s
               FROM ({order_days_sql("o_orderpriority")}) GROUP BY 1)
    SELECT o_orderpriority, CAST(n - 30 * s AS INTEGER) AS train_min, CAST(n - s AS INTEGER) AS train_max,
           CAST(least(s, 7) AS INTEGER) AS test_size FROM s""")
def fold_sizes(spark, sf_dir):
    folds = fold_table(order_days(spark, sf_dir, "o_orderpriority"), ["o_orderpriority"], 30, 7)
    return fold_stats(folds, ["o_orderpriority"])


@query("""
    WITH r AS (SELECT l_returnflag, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi
               FROM lineitem GROUP BY 1)
    SELECT l_returnflag, CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin,
           count(*) AS n
    FROM lineitem JOIN r USING (l_returnflag) GROUP BY 1, 2""")
def histogram_per_flag(spark, sf_dir):
    return histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 10, ["l_returnflag"]) \
        .select("l_returnflag", "bin", "n")


@query("""
    WITH v AS (SELECT sqrt(l_extendedprice) AS v FROM lineitem),
    r AS (SELECT min(v) AS lo, max(v) AS hi FROM v)
    SELECT CAST(least(floor((v - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, count(*) AS n,
           round(min(lo) + least(floor((min(v) - min(lo)) / ((min(hi) - min(lo)) / 20)), 19)
                 * (min(hi) - min(lo)) / 20, 4) AS bin_from
    FROM v, r GROUP BY 1""")
def histogram_of_roots(spark, sf_dir):
    roots = table(spark, sf_dir, "lineitem").select(F.sqrt("l_extendedprice").alias("v"))
    return histogram(roots, "v", 20).select("bin", "n", F.round("bin_from", 4).alias("bin_from"))


@query("""
    SELECT o_custkey, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3""")
def top_orders_per_customer(spark, sf_dir):
    return top_k(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice"),
                 ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3)


@query("""
    SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10""")
def longest_documents(spark, sf_dir):
    return top_k(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), [],
                 [F.col("n_chars").desc(), F.col("doc_id")], 10)


@query("""
    SELECT CAST(o_orderdate AS DATE) AS date, o_orderkey FROM orders ORDER BY 1, 2""")
def orders_by_date_and_key(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"), "o_orderkey") \
        .orderBy("date", "o_orderkey")
