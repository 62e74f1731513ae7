"""Daily series: filling, totals, changes, folds, lags; and increments."""

from pyspark.sql import functions as F

from dayline.operators.incremental import new_rows, rewind
from dayline.operators.joins import via_links
from dayline.operators.windows import (daily_change, densify, difference, ffill, fold_table, lags,
                                       last_n, latest_row, moving_trend, running_total, share_of,
                                       walk_forward)
from dayline.queries import query
from dayline.queries.tables import (event_days, event_days_sql, order_days, order_days_sql, table)


@query(f"""
    WITH d AS ({order_days_sql("o_orderpriority")})
    SELECT o_orderpriority, date, n, CAST(sum(n) OVER w AS BIGINT) AS total_n,
           round(sum(price) OVER w, 2) AS total_price
    FROM d WINDOW w AS (PARTITION BY o_orderpriority ORDER BY date)""")
def running_totals(spark, sf_dir):
    out = running_total(order_days(spark, sf_dir, "o_orderpriority"), ["o_orderpriority"], "date",
                        {"n": "total_n", "price": "total_price"})
    return out.select("o_orderpriority", "date", "n", "total_n",
                      F.round("total_price", 2).alias("total_price"))


@query(f"""
    WITH d AS ({order_days_sql("o_orderstatus")})
    SELECT o_orderstatus, date, n, CAST(sum(n) OVER w AS BIGINT) AS total,
           max(CASE WHEN n > 3 THEN date END) OVER w AS last_busy
    FROM d WINDOW w AS (PARTITION BY o_orderstatus ORDER BY date)""")
def long_series_in_buckets(spark, sf_dir):
    days = order_days(spark, sf_dir, "o_orderstatus").drop("price").withColumn(
        "last_busy", F.when(F.col("n") > 3, F.col("date")))
    totals = running_total(days, ["o_orderstatus"], "date", {"n": "total"}, bucket_days=31)
    return ffill(totals, ["o_orderstatus"], "date", ["last_busy"], bucket_days=31)


@query(f"""
    WITH d AS ({event_days_sql("user_id")}),
    t AS (SELECT user_id, date, n, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY date) AS BIGINT) AS total
          FROM d)
    SELECT * FROM t WHERE date > DATE '2024-01-15'""")
def seeded_totals_equal_full_totals(spark, sf_dir):
    days = event_days(spark, sf_dir, "user_id").select("user_id", "date", "n")
    before = running_total(days.filter("date <= DATE '2024-01-15'"), ["user_id"], "date", {"n": "total"})
    return running_total(days.filter("date > DATE '2024-01-15'"), ["user_id"], "date", {"n": "total"},
                         seed=latest_row(before, ["user_id"], "date"))


@query(f"""
    WITH d AS ({event_days_sql("user_id")})
    SELECT user_id, date, n, n - coalesce(lag(n) OVER (PARTITION BY user_id ORDER BY date), 0) AS new_n
    FROM d QUALIFY date > DATE '2024-01-15'""")
def seeded_changes_equal_full_changes(spark, sf_dir):
    days = event_days(spark, sf_dir, "user_id").select("user_id", "date", "n")
    seed = latest_row(days.filter("date <= DATE '2024-01-15'"), ["user_id"], "date")
    return daily_change(days.filter("date > DATE '2024-01-15'"), ["user_id"], "date", {"n": "new_n"}, seed)


@query(f"""
    SELECT o_orderpriority, date, round(price / 1000000, 8) AS share
    FROM ({order_days_sql("o_orderpriority")})""")
def share_of_population(spark, sf_dir):
    out = share_of(order_days(spark, sf_dir, "o_orderpriority"), {"price": "share"}, F.lit(1000000))
    return out.select("o_orderpriority", "date", F.round("share", 8).alias("share"))


_DENSE = """
    b AS (SELECT user_id, min(date) AS lo, max(date) AS hi FROM d GROUP BY 1),
    c AS (SELECT user_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
    dense AS (SELECT c.user_id, c.date, n, value FROM c LEFT JOIN d USING (user_id, date))"""


@query(f"WITH d AS ({event_days_sql('user_id')}), {_DENSE} SELECT user_id, date, n, value FROM dense")
def dense_days(spark, sf_dir):
    return densify(event_days(spark, sf_dir, "user_id"), ["user_id"], "date")


@query(f"""
    WITH d AS ({event_days_sql('user_id')}), {_DENSE}
    SELECT user_id, date, last_value(n IGNORE NULLS) OVER w AS n,
           last_value(value IGNORE NULLS) OVER w AS value, n IS NULL AS filled
    FROM dense WINDOW w AS (PARTITION BY user_id ORDER BY date
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def filled_days(spark, sf_dir):
    return ffill(densify(event_days(spark, sf_dir, "user_id"), ["user_id"], "date"), ["user_id"], "date",
                 flag="filled")


@query("""
    SELECT o_custkey, o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS date FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_order_per_customer(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("date"),
        F.struct("o_orderdate", "o_orderkey").alias("at"))
    return latest_row(orders, ["o_custkey"], "at").drop("at")


@query(f"""
    WITH d AS ({order_days_sql("o_orderpriority")}),
    a AS (SELECT o_orderpriority, date, n - lag(n) OVER w AS x, row_number() OVER w AS i FROM d
          WINDOW w AS (PARTITION BY o_orderpriority ORDER BY date)),
    b AS (SELECT o_orderpriority, date, i, x - lag(x, 7) OVER (PARTITION BY o_orderpriority ORDER BY date) AS x
          FROM a)
    SELECT o_orderpriority, date, CAST(x AS DOUBLE) AS x FROM b WHERE i > 8""")
def seasonal_and_ordinary_differences(spark, sf_dir):
    return difference(order_days(spark, sf_dir, "o_orderpriority"), ["o_orderpriority"], "date", "n",
                      d=1, D=1, m=7, name="x").select("o_orderpriority", "date", "x")


@query(f"""
    WITH d AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY date) - 1 AS i,
                      count(*) OVER (PARTITION BY o_orderpriority) AS total
               FROM ({order_days_sql("o_orderpriority")})),
    f AS (SELECT d.*, CAST(k AS INTEGER) AS fold, total - (10 - k) * (total // 11) AS start,
                 least(total // 11, 7) AS size FROM d, range(10) AS r(k))
    SELECT o_orderpriority, date, fold, CASE WHEN i < start THEN 'train' ELSE 'test' END AS role
    FROM f WHERE i < start + size""")
def walk_forward_rows(spark, sf_dir):
    return walk_forward(order_days(spark, sf_dir, "o_orderpriority"), ["o_orderpriority"], "date", 10, 7) \
        .select("o_orderpriority", "date", "fold", "role")


@query(f"""
    WITH s AS (SELECT event_type, count(*) AS n, count(*) // 6 AS s FROM ({event_days_sql("event_type")})
               GROUP BY 1)
    SELECT event_type, CAST(k AS INTEGER) AS fold, CAST(n - (5 - k) * s AS INTEGER) AS train_size,
           CAST(s AS INTEGER) AS test_size FROM s, range(5) AS r(k)""")
def folds_per_series(spark, sf_dir):
    return fold_table(event_days(spark, sf_dir, "event_type"), ["event_type"], 5)


@query(f"""
    SELECT event_type, date, CASE WHEN row_number() OVER (PARTITION BY event_type ORDER BY date DESC) <= 7
                                  THEN 'test' ELSE 'train' END AS role
    FROM ({event_days_sql("event_type")})""")
def last_week_split(spark, sf_dir):
    return last_n(event_days(spark, sf_dir, "event_type"), ["event_type"], "date", 7) \
        .select("event_type", "date", "role")


@query(f"""
    SELECT o_orderpriority, date, lag(n, 1) OVER w AS n_lag1, lag(n, 2) OVER w AS n_lag2,
           lag(n, 7) OVER w AS n_lag7, lag(n, 14) OVER w AS n_lag14
    FROM ({order_days_sql("o_orderpriority")}) WINDOW w AS (PARTITION BY o_orderpriority ORDER BY date)""")
def lag_columns(spark, sf_dir):
    return lags(order_days(spark, sf_dir, "o_orderpriority"), ["o_orderpriority"], "date", "n",
                [1, 2, 7, 14]).drop("n", "price")


@query(f"""
    SELECT o_orderpriority, date, CASE WHEN count(*) OVER w = 7 THEN round(avg(n) OVER w, 6) END AS trend
    FROM ({order_days_sql("o_orderpriority")})
    WINDOW w AS (PARTITION BY o_orderpriority ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""")
def weekly_trend(spark, sf_dir):
    return moving_trend(order_days(spark, sf_dir, "o_orderpriority"), ["o_orderpriority"], "date", "n") \
        .select("o_orderpriority", "date", F.round("trend", 6).alias("trend"))


@query("""
    WITH e AS (SELECT event_type, user_id, CAST(ts AS DATE) AS date, event_id FROM events),
    marks AS (SELECT user_id, max(date) AS latest FROM e WHERE date <= DATE '2024-01-05' GROUP BY 1)
    SELECT event_type, user_id, date, event_id FROM e LEFT JOIN marks USING (user_id)
    WHERE date > coalesce(latest, DATE '2020-02-22')""")
def rows_after_high_water_mark(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", "user_id", F.to_date("ts").alias("date"),
                                                   "event_id")
    return new_rows(events, events.filter("date <= DATE '2024-01-05'"), ["user_id"], "date")


@query("""
    WITH e AS (SELECT user_id, CAST(ts AS DATE) AS date, event_id FROM events
               WHERE user_id IN (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup'
                                 AND value > 50)),
    marks AS (SELECT user_id, max(date) AS latest FROM e WHERE date <= DATE '2024-01-20' GROUP BY 1)
    SELECT user_id, date, event_id FROM e LEFT JOIN marks USING (user_id)
    WHERE date > coalesce(latest, DATE '2020-02-22')""")
def new_rows_of_linked_stations(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    links = events.filter("event_type = 'signup' AND value > 50").select("user_id")
    rows = events.select("user_id", F.to_date("ts").alias("date"), "event_id")
    return new_rows(via_links(rows, links, "user_id", "left_semi"),
                    rows.filter("date <= DATE '2024-01-20'"), ["user_id"], "date")


@query("""
    WITH d AS (SELECT user_id, CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1, 2),
    f AS (SELECT user_id, CAST(min(ts) AS DATE) AS first FROM events
          WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-20' GROUP BY 1)
    SELECT user_id, date, n FROM d LEFT JOIN f USING (user_id) WHERE first IS NULL OR date < first""")
def rewound_before_late_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))
    late = events.filter("event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-20'")
    return rewind(event_days(spark, sf_dir, "user_id").drop("value"), late, ["user_id"], "date")
