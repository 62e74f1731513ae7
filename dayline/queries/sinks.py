"""Writes read back, and tables after changes."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dayline.operators.aggregates import distinct_values
from dayline.queries import query
from dayline.queries.tables import table
from dayline.schemas import conform
from dayline.session import scratch_path
from dayline.sinks.audit import audit_entities, audit_keys, load_report, orphans
from dayline.sinks.changes import (apply_changes, change_counts, count_where, delete_where, find,
                                   modified_count, update_where)
from dayline.sinks.loads import append_load, read_loads
from dayline.sinks.tables import (append_checked, insert_if_absent, overwrite, replace_by_key,
                                  replace_partitions)


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n,
           (SELECT count(*) FROM orders) AS written
    FROM orders GROUP BY 1""")
def append_with_row_count(spark, sf_dir):
    path = scratch_path(spark, "orders")
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    written = append_load(orders.filter("o_orderstatus = 'F'"), path, partition_by=["year"])
    written += append_load(orders.filter("o_orderstatus <> 'F'"), path, partition_by=["year"])
    return (read_loads(spark, path).groupBy("year").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("written", F.lit(written).cast("long")))


@query("""
    SELECT c_nationkey, count(*) AS n, (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS refused
    FROM customer WHERE c_acctbal >= 0 GROUP BY 1""")
def refused_loads_leave_no_rows(spark, sf_dir):
    """A load with a wrong count is refused; the same rows loaded twice under one name count once."""
    path, customers = scratch_path(spark, "customers"), table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    good, bad = customers.filter("c_acctbal >= 0"), customers.filter("c_acctbal < 0")
    append_load(good, path, "good")
    try:
        append_load(bad, path, "bad", expected=-1)
    except ValueError:
        append_load(good, path, "good")
    return (read_loads(spark, path).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("refused", bad.agg(F.count(F.lit(1)).alias("n")).scalar()))


@query("""
    WITH e AS (SELECT user_id, CAST(ts AS DATE) AS date, event_id, value FROM events),
    stored AS (SELECT DISTINCT user_id, date FROM e WHERE date < DATE '2024-01-11'),
    one AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_id, date
                                                       ORDER BY event_id DESC) = 1)
    SELECT user_id, date, event_id, value FROM one ANTI JOIN stored USING (user_id, date)""")
def insert_absent_user_days(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("date"), "event_id", "value")
    return insert_if_absent(events, events.filter("date < DATE '2024-01-11'"), ["user_id", "date"],
                            "event_id")


@query("""
    SELECT o_orderkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END AS o_totalprice
    FROM orders""")
def replaced_partitions(spark, sf_dir):
    path = scratch_path(spark, "orders-by-status")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    append_checked(orders, path, ["o_orderstatus"])
    pending = orders.filter("o_orderstatus = 'P'").withColumn("o_totalprice", F.lit(0.0))
    replace_partitions(pending, path, ["o_orderstatus"])
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("""
    SELECT event_type, user_id, n, value FROM (
        SELECT event_type, user_id, count(*) AS n, round(sum(value), 2) AS value
        FROM events GROUP BY 1, 2)
    WHERE event_type <> 'click'
    UNION ALL
    SELECT 'click', user_id, count(*), 0.0 FROM events WHERE event_type = 'click' GROUP BY 2""")
def replaced_keys(spark, sf_dir):
    stored = table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("value"))
    new = stored.filter("event_type = 'click'").withColumn("value", F.lit(0.0))
    return replace_by_key(new, stored, ["event_type"])


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def overwritten_table(spark, sf_dir):
    path = scratch_path(spark, "orders-again")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    overwrite(orders, path, ["o_orderstatus"])
    overwrite(orders.filter("o_orderstatus <> 'F'"), path, ["o_orderstatus"])
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P'")
def find_without_a_limit(spark, sf_dir):
    return find(table(spark, sf_dir, "orders"), {"o_orderstatus": "P"}, ["o_orderkey", "o_orderpriority"])


@query("""
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
      AND o_orderpriority IN ('1-URGENT', '5-LOW')
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def find_with_order_and_limit(spark, sf_dir):
    return find(table(spark, sf_dir, "orders"),
                {"o_orderstatus": "F", "o_orderpriority": ["1-URGENT", "5-LOW"]}, ["o_orderkey", "o_totalprice"],
                [("o_totalprice", -1), ("o_orderkey", 1)], limit=25)


@query("""
    SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 0.0
                           ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer""")
def updated_customers(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return update_where(customers, {"c_mktsegment": ["BUILDING", "MACHINERY"]}, {"c_acctbal": 0.0})


@query("""
    SELECT c_custkey, CASE WHEN c_custkey = (SELECT min(c_custkey) FROM customer
                                             WHERE c_mktsegment = 'BUILDING')
                           THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def updated_first_customer(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return update_where(customers, {"c_mktsegment": "BUILDING"}, {"c_mktsegment": "MOVED"},
                        only_one=True, order_by=["c_custkey"])


@query("""
    SELECT count(*) AS matched, count(*) FILTER (WHERE o_orderpriority <> '5-LOW') AS modified
    FROM orders WHERE o_orderstatus = 'O'""")
def modified_row_counts(spark, sf_dir):
    return modified_count(table(spark, sf_dir, "orders"), {"o_orderstatus": "O"},
                          {"o_orderpriority": "5-LOW"})


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'O'")
def deleted_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return delete_where(orders, {"o_orderstatus": "O"})


_CHANGES = """
    target AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal >= 1000),
    last AS (
        SELECT o_custkey AS c_custkey, o_orderkey AS seq, 'order ' || o_orderkey AS c_name,
               o_totalprice AS c_acctbal,
               CASE o_orderstatus WHEN 'F' THEN 'update' WHEN 'O' THEN 'upsert' ELSE 'delete' END AS op
        FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1),
    joined AS (
        SELECT coalesce(t.c_custkey, l.c_custkey) AS c_custkey, t.c_custkey IS NOT NULL AS stored, op,
               t.c_name AS old_name, t.c_acctbal AS old_bal, l.c_name AS new_name, l.c_acctbal AS new_bal
        FROM target t FULL JOIN last l ON t.c_custkey = l.c_custkey)"""


def _target_and_changes(spark, sf_dir):
    target = table(spark, sf_dir, "customer").filter("c_acctbal >= 1000") \
        .select("c_custkey", "c_name", "c_acctbal")
    kind = (F.when(F.col("o_orderstatus") == "F", "update")
            .when(F.col("o_orderstatus") == "O", "upsert").otherwise("delete"))
    changes = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("seq"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("c_name"),
        F.col("o_totalprice").alias("c_acctbal"), kind.alias("op"))
    return target, changes


@query(f"""
    WITH {_CHANGES}
    SELECT c_custkey, CASE WHEN op IS NULL THEN old_name ELSE new_name END AS c_name,
           CASE WHEN op IS NULL THEN old_bal ELSE new_bal END AS c_acctbal
    FROM joined WHERE op IS NULL OR op = 'upsert' OR (op = 'update' AND stored)""")
def bulk_changed_customers(spark, sf_dir):
    target, changes = _target_and_changes(spark, sf_dir)
    return apply_changes(target, changes, ["c_custkey"])


@query(f"""
    WITH {_CHANGES}
    SELECT count(*) FILTER (WHERE stored AND op IN ('update', 'upsert')) AS matched,
           CAST(0 AS BIGINT) AS inserted,
           count(*) FILTER (WHERE stored AND op IN ('update', 'upsert')
               AND (old_name <> new_name OR old_bal <> new_bal)) AS modified,
           count(*) FILTER (WHERE NOT stored AND op = 'upsert') AS upserted,
           count(*) FILTER (WHERE stored AND op = 'delete') AS deleted
    FROM joined""")
def bulk_change_counts(spark, sf_dir):
    target, changes = _target_and_changes(spark, sf_dir)
    return change_counts(target, changes, ["c_custkey"])


@query("SELECT count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber BETWEEN 2 AND 4")
def counted_rows(spark, sf_dir):
    return count_where(table(spark, sf_dir, "lineitem"),
                       {"l_returnflag": "R", "l_linenumber": range(2, 5)})


@query("""
    SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, CAST(p_size AS DOUBLE) AS p_size,
           TRY_CAST(p_brand AS INTEGER) AS p_brand, CAST(NULL AS DATE) AS first_sold FROM part""")
def conformed_parts(spark, sf_dir):
    return conform(table(spark, sf_dir, "part"), StructType.fromDDL(
        "p_partkey int, p_name string, p_size double, p_brand int, first_sold date"))


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY ALL HAVING count(*) > 1""")
def repeated_line_keys(spark, sf_dir):
    return audit_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    SELECT l_orderkey, l_suppkey FROM lineitem
    WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 2000)""")
def lines_without_parent(spark, sf_dir):
    return orphans(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey"),
                   table(spark, sf_dir, "supplier").filter("s_acctbal >= 2000"),
                   {"l_suppkey": "s_suppkey"})


@query("""
    WITH s AS (SELECT s_suppkey % 40 AS station_id, s_nationkey AS mun FROM supplier),
    link AS (SELECT DISTINCT c_nationkey AS code, c_custkey % 50 AS station_id FROM customer)
    SELECT 'municipality' AS entity, 'key' AS "check", 'code' AS columns, CAST(NULL AS VARCHAR) AS parent, 0 AS n
    UNION ALL SELECT 'weather_station', 'key', 'station_id', NULL,
                     (SELECT count(*) FROM (SELECT station_id FROM s GROUP BY 1 HAVING count(*) > 1))
    UNION ALL SELECT 'municipality_station_link', 'reference', 'municipality_code', 'municipality',
                     (SELECT count(*) FROM link WHERE code NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 4))
    UNION ALL SELECT 'municipality_station_link', 'reference', 'station_id', 'weather_station',
                     (SELECT count(*) FROM link WHERE station_id NOT IN (SELECT station_id FROM s))""")
def declared_keys_and_references(spark, sf_dir):
    """What the schema declares, checked on towns, stations and links made from the tables."""
    towns = table(spark, sf_dir, "nation").filter("n_regionkey < 4").select(F.col("n_nationkey").alias("code"))
    stations = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 40).alias("station_id"))
    links = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("municipality_code"),
                                                    (F.col("c_custkey") % 50).alias("station_id")).distinct()
    return audit_entities({"municipality": towns, "weather_station": stations, "municipality_station_link": links})


@query("""
    SELECT 'orders' AS entity, 'loaded' AS status, count(*) AS records,
           CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date
    FROM orders
    UNION ALL SELECT 'lineitem', 'loaded', count(*), CAST(min(l_shipdate) AS DATE),
                     CAST(max(l_shipdate) AS DATE) FROM lineitem
    UNION ALL SELECT 'future', 'empty', 0, NULL, NULL""")
def load_summary(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return load_report({"orders": (orders, "o_orderdate"),
                        "lineitem": (table(spark, sf_dir, "lineitem"), "l_shipdate"),
                        "future": (orders.filter("o_orderdate > TIMESTAMP '2100-01-01'"),
                                   "o_orderdate")})


@query("SELECT DISTINCT p_brand, p_type FROM part")
def distinct_brand_types(spark, sf_dir):
    return distinct_values(table(spark, sf_dir, "part"), "p_brand", "p_type")
