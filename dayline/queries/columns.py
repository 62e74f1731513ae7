"""Column shaping and predicates."""

from pyspark.sql import functions as F

from dayline.functions.columns import (Band, back_transform, normal_quantile, reband, row_sum,
                                       same_set)
from dayline.functions.dates import days_between
from dayline.operators.filters import crop_from, drop_empty, gate_complete, scan_between, select_where
from dayline.operators.projections import (columns_like, nan_to_null, recode, rename, select_roles,
                                           transform, with_constants)
from dayline.queries import query
from dayline.queries.tables import event_days, event_days_sql, order_days, table


@query("""
    SELECT c_custkey AS code, c_name AS name, c_acctbal AS balance, 'P1' AS province,
           CAST(22 AS INTEGER) AS province_code FROM customer""")
def renamed_customers(spark, sf_dir):
    named = rename(table(spark, sf_dir, "customer"),
                   {"c_custkey": "code", "c_name": "name", "c_acctbal": "balance"})
    return with_constants(named.drop("c_nationkey", "c_mktsegment"), province="P1", province_code=22)


@query("""
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'red' WHEN '2-HIGH' THEN 'orange'
           WHEN '3-MEDIUM' THEN 'yellow' WHEN '5-LOW' THEN 'white' END AS risk FROM orders""")
def recoded_priorities(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("risk"))
    return recode(orders, "risk", {"1-URGENT": "red", "2-HIGH": "orange", "3-MEDIUM": "yellow",
                                   "5-LOW": "white"})


def age_text(size):
    """Ranges of several widths out of a part size, the open one included."""
    return (F.when(size >= 46, "90+").when(size % 7 == 0, F.concat(F.lit(" "), (size * 2).cast("string"),
                                                             F.lit("-"), (size * 2 + 20).cast("string")))
            .otherwise(F.concat((size * 2).cast("string"), F.lit("-"), (size * 2 + 9).cast("string"),
                                F.lit(" "))))


@query("""
    WITH r AS (SELECT p_partkey, p_size * 2 AS lo,
                      p_size * 2 + CASE WHEN p_size % 7 = 0 THEN 20 ELSE 9 END AS hi,
                      p_size >= 46 AS open_ended FROM part)
    SELECT p_partkey, CAST(CASE WHEN open_ended THEN 2 WHEN hi < 30 THEN 0 WHEN lo >= 60 THEN 2
                                WHEN lo >= 30 AND hi < 60 THEN 1 END AS INTEGER) AS band FROM r""")
def rebanded_sizes(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", reband(age_text(F.col("p_size"))).alias("band"))


@query("""
    SELECT p_partkey, CAST(CASE WHEN p_size < 10 THEN 10 WHEN p_size >= 40 THEN 30
                                WHEN p_size >= 10 AND p_size < 40 THEN 20 END AS INTEGER) AS band
    FROM part""")
def rebanded_by_own_bands(spark, sf_dir):
    size = F.col("p_size").cast("string")
    bands = (Band(10, below=10), Band(30, low=40), Band(20, low=10, below=40))
    return table(spark, sf_dir, "part").select(
        "p_partkey", reband(F.concat(size, F.lit("-"), size), bands).alias("band"))


@query("SELECT event_id, CASE WHEN value < 90 THEN value END AS value FROM events")
def not_a_number_to_null(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("value") < 90, F.col("value")).otherwise(float("nan")).alias("value"))
    return nan_to_null(events, ["value"])


@query("SELECT event_type, date, value, n FROM (" + event_days_sql("event_type") + ")")
def output_and_regressors(spark, sf_dir):
    return select_roles(event_days(spark, sf_dir, "event_type"), ["event_type"], "date", "value", ["n"])


@query("""
    SELECT l_orderkey, l_linenumber, round(l_discount + l_tax, 4) AS rates FROM lineitem""")
def rate_columns_summed(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_discount").alias("rate_discount"),
        F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("rate_tax"))
    return lines.select("l_orderkey", "l_linenumber",
                        F.round(row_sum(columns_like(lines, "rate")), 4).alias("rates"))


@query("""
    SELECT o_orderkey, o_orderdate, c_name FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def predicates_and_join(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    out = select_where(table(spark, sf_dir, "orders"),
                       {"o_orderstatus": "P", "o_orderpriority": ["1-URGENT", "2-HIGH"]},
                       customers, "o_custkey")
    return out.select("o_orderkey", "o_orderdate", "c_name")


@query("""
    SELECT l_orderkey FROM lineitem GROUP BY l_orderkey
    HAVING list_sort(list_distinct(list(l_returnflag))) = ['A', 'N']""")
def orders_with_one_set_of_flags(spark, sf_dir):
    flags = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.collect_set("l_returnflag").alias("flags"))
    wanted = F.array(F.lit("N"), F.lit("A"), F.lit("N"))
    return flags.filter(same_set("flags", wanted)).select("l_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1999-07-01'")
def cropped_from_partial_date(spark, sf_dir):
    return crop_from(table(spark, sf_dir, "orders"), "o_orderdate", "1999-07").select("o_orderkey")


@query("""
    SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value,
           CASE WHEN user_id > 40 THEN user_id END AS user_id
    FROM events WHERE event_type <> 'view' AND (event_type <> 'error' OR user_id > 40)""")
def rows_with_key_and_measure(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") != "view", F.col("event_id")).alias("event_id"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.when(F.col("user_id") > 40, F.col("user_id")).alias("user_id"))
    return drop_empty(events, "event_id", ["value", "user_id"])


@query("""
    WITH days AS (SELECT user_id, CAST(ts AS DATE) AS date, event_type, count(*) AS n
                  FROM events WHERE ts >= TIMESTAMP '2024-01-25' GROUP BY ALL)
    SELECT user_id, date, n FROM days WHERE event_type = 'view'
      AND user_id IN (SELECT user_id FROM days WHERE event_type = 'error')
      AND user_id IN (SELECT user_id FROM days WHERE event_type = 'purchase')""")
def complete_sources_per_user(spark, sf_dir):
    days = scan_between(event_days(spark, sf_dir, "user_id", "event_type"), "date", "2024-01-25")
    parts = [days.filter(F.col("event_type") == t) for t in ("error", "purchase")]
    views = days.filter("event_type = 'view'").select("user_id", "date", "n")
    return gate_complete(views, parts, ["user_id"])


@query("SELECT o_orderkey FROM orders WHERE false")
def gate_closed_by_empty_source(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    empty = orders.filter("o_orderdate > TIMESTAMP '2100-01-01'")
    return gate_complete(orders.select("o_orderkey"),
                         [table(spark, sf_dir, "lineitem"), empty])


@query("""
    SELECT o_orderkey, round(sqrt(o_totalprice), 6) AS root, round(o_totalprice, 2) AS back
    FROM orders""")
def root_and_back(spark, sf_dir):
    out = transform(table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("root")), "root", "sqrt")
    return out.select("o_orderkey", F.round("root", 6).alias("root"),
                      F.round(back_transform("root", "sqrt"), 2).alias("back"))


@query("""
    SELECT s_suppkey, CAST(count(d) AS INTEGER) AS n_days FROM supplier
    LEFT JOIN (SELECT s_suppkey AS k, unnest(generate_series(DATE '2020-01-01',
               DATE '2020-01-01' + CAST(floor(s_acctbal / 500) AS INTEGER), INTERVAL 1 DAY)) AS d
               FROM supplier) ON k = s_suppkey GROUP BY s_suppkey""")
def day_ranges(spark, sf_dir):
    first = F.lit("2020-01-01").cast("date")
    last = F.date_add(first, F.floor(F.col("s_acctbal") / 500).cast("int"))
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.size(days_between(first, last)).alias("n_days"))


@query("""
    SELECT date, n FROM (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1)
    WHERE n BETWEEN 3 AND 8""")
def threshold_conjunction(spark, sf_dir):
    return order_days(spark, sf_dir).filter((F.col("n") < 9) & (F.col("n") > 2)).select("date", "n")
