"""Autocorrelation, decomposition, regression and tests on daily series."""

from pyspark.sql import functions as F

from dayline.functions.columns import transform_column
from dayline.models.series import training_error
from dayline.operators.diagnostics import (acf, adf, choose_d, decompose, ocsb, pacf, quantile_pairs,
                                           residual_tests, standardised)
from dayline.operators.regression import ols, ols_residuals
from dayline.operators.windows import densify, ffill
from dayline.queries import query
from dayline.queries.tables import order_days, order_days_sql, table

KEY = "o_orderpriority"


def _rounded(df, *cols, places=6):
    return df.withColumns({c: F.round(c, places) for c in cols})


@query(f"""
    WITH d AS ({order_days_sql(KEY)}),
    x AS (SELECT {KEY}, date, n - avg(n) OVER (PARTITION BY {KEY}) AS x,
                 row_number() OVER (PARTITION BY {KEY} ORDER BY date) AS i FROM d),
    v AS (SELECT {KEY}, sum(x * x) AS c0, count(*) AS n FROM x GROUP BY 1),
    c AS (SELECT a.{KEY}, CAST(k AS INTEGER) AS lag, sum(a.x * b.x) AS c
          FROM x a, range(15) AS r(k), x b WHERE a.{KEY} = b.{KEY} AND b.i = a.i - k GROUP BY 1, 2)
    SELECT {KEY}, n, lag, round(c / c0, 6) + 0 AS r FROM c JOIN v USING ({KEY})""")
def autocorrelations(spark, sf_dir):
    return _rounded(acf(order_days(spark, sf_dir, KEY), [KEY], "date", "n", 14), "r")


@query(f"""
    WITH d AS ({order_days_sql(KEY)}),
    x AS (SELECT {KEY}, date, n - avg(n) OVER (PARTITION BY {KEY}) AS x FROM d),
    l AS (SELECT {KEY}, x, lag(x) OVER w AS x1, lag(x, 2) OVER w AS x2, lag(x, 3) OVER w AS x3 FROM x
          WINDOW w AS (PARTITION BY {KEY} ORDER BY date)),
    r AS (SELECT {KEY}, sum(x * x1) / sum(x * x) AS r1, sum(x * x2) / sum(x * x) AS r2,
                 sum(x * x3) / sum(x * x) AS r3 FROM l GROUP BY 1)
    SELECT {KEY}, CAST(0 AS INTEGER) AS lag, 1.0 AS r FROM r
    UNION ALL SELECT {KEY}, 1, round(r1, 6) FROM r
    UNION ALL SELECT {KEY}, 2, round((r2 - r1 * r1) / (1 - r1 * r1), 6) FROM r
    UNION ALL SELECT {KEY}, 3, round((r3 - 2 * r1 * r2 + r1 ** 3 + r1 * r2 * r2 - r1 * r1 * r3)
                                     / (1 + 2 * r1 * r1 * r2 - r2 * r2 - 2 * r1 * r1), 6) FROM r""")
def partial_autocorrelations(spark, sf_dir):
    return _rounded(pacf(order_days(spark, sf_dir, KEY), [KEY], "date", "n", 3), "r")


_DENSE = f"""
    d AS ({order_days_sql(KEY)}),
    b AS (SELECT {KEY}, min(date) AS lo, max(date) AS hi FROM d GROUP BY 1),
    c AS (SELECT {KEY}, lo, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
    f AS (SELECT {KEY}, date, lo, last_value(n IGNORE NULLS) OVER (
              PARTITION BY {KEY} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n
          FROM c LEFT JOIN d USING ({KEY}, date))"""


def dense_orders(spark, sf_dir):
    days = order_days(spark, sf_dir, KEY)
    return ffill(densify(days, [KEY], "date"), [KEY], "date")


@query(f"""
    WITH {_DENSE},
    t AS (SELECT *, (date - lo) % 7 AS phase, CASE WHEN count(*) OVER w = 7 THEN avg(n) OVER w END AS trend
          FROM f WINDOW w AS (PARTITION BY {KEY} ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
    s AS (SELECT {KEY}, phase, avg(n - trend) AS effect FROM t GROUP BY 1, 2),
    z AS (SELECT {KEY}, phase, effect - avg(effect) OVER (PARTITION BY {KEY}) AS seasonal FROM s)
    SELECT {KEY}, date, round(trend, 5) AS trend, round(seasonal, 5) AS seasonal,
           round(n - trend - seasonal, 5) AS resid FROM t JOIN z USING ({KEY}, phase)""")
def weekly_decomposition(spark, sf_dir):
    parts = decompose(dense_orders(spark, sf_dir), [KEY], "date", "n", 7)
    return _rounded(parts.select(KEY, "date", "trend", "seasonal", "resid"), "trend", "seasonal",
                    "resid", places=5)


@query("""
    SELECT l_returnflag, 'intercept' AS term, round(regr_intercept(l_extendedprice, l_quantity), 3) AS coef,
           count(*) AS n FROM lineitem GROUP BY 1
    UNION ALL
    SELECT l_returnflag, 'l_quantity', round(regr_slope(l_extendedprice, l_quantity), 3), count(*)
    FROM lineitem GROUP BY 1""")
def regression_on_one_column(spark, sf_dir):
    out = ols(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", ["l_quantity"])
    return _rounded(out.select("l_returnflag", "term", "coef", "n"), "coef", places=3)


@query("""
    WITH c AS (SELECT l_returnflag, covar_pop(l_quantity, l_extendedprice) AS s1y,
                      covar_pop(l_discount, l_extendedprice) AS s2y, var_pop(l_quantity) AS s11,
                      var_pop(l_discount) AS s22, covar_pop(l_quantity, l_discount) AS s12,
                      avg(l_extendedprice) AS my, avg(l_quantity) AS m1, avg(l_discount) AS m2
               FROM lineitem GROUP BY 1),
    b AS (SELECT l_returnflag, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
                 (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2, my, m1, m2 FROM c)
    SELECT l_returnflag, 'l_quantity' AS term, round(b1, 3) AS coef FROM b
    UNION ALL SELECT l_returnflag, 'l_discount', round(b2, 3) FROM b
    UNION ALL SELECT l_returnflag, 'intercept', round(my - b1 * m1 - b2 * m2, 3) FROM b""")
def regression_on_two_columns(spark, sf_dir):
    out = ols(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice",
              ["l_quantity", "l_discount"])
    return _rounded(out.select("l_returnflag", "term", "coef"), "coef", places=3)


@query(f"""
    WITH d AS ({order_days_sql(KEY)}),
    b AS (SELECT {KEY}, regr_slope(price, n) AS s, regr_intercept(price, n) AS i FROM d GROUP BY 1)
    SELECT {KEY}, date, round(price - i - s * n, 3) AS resid FROM d JOIN b USING ({KEY})""")
def regression_residuals(spark, sf_dir):
    out = ols_residuals(order_days(spark, sf_dir, KEY), [KEY], "price", ["n"])
    return _rounded(out.select(KEY, "date", "resid"), "resid", places=3)


@query(f"""
    WITH d AS ({order_days_sql(KEY)}),
    r AS (SELECT {KEY}, date, n - avg(n) OVER (PARTITION BY {KEY}) AS e,
                 row_number() OVER (PARTITION BY {KEY} ORDER BY date) AS i,
                 count(*) OVER (PARTITION BY {KEY}) AS total FROM d),
    l AS (SELECT *, lag(e) OVER w AS e1, lag(e, 2) OVER w AS e2, lag(e, 3) OVER w AS e3 FROM r
          WINDOW w AS (PARTITION BY {KEY} ORDER BY date)),
    s AS (SELECT {KEY}, count(*) AS n, sum(e * e) AS c0, sum(e * e1) AS c1, sum(e * e2) AS c2,
                 sum(e * e3) AS c3, avg(e ** 3) / avg(e * e) ** 1.5 AS skew,
                 avg(e ** 4) / avg(e * e) ** 2 AS kurtosis,
                 sum(e * e) FILTER (WHERE i > total - round(total / 3))
                 / sum(e * e) FILTER (WHERE i <= round(total / 3)) AS h FROM l GROUP BY 1)
    SELECT {KEY}, n, round(h, 5) AS heteroskedasticity, round(skew, 5) AS skew,
           round(kurtosis, 5) AS kurtosis,
           round(n / 6 * (skew * skew + (kurtosis - 3) ** 2 / 4), 4) AS jarque_bera,
           round(n * (n + 2) * ((c1 / c0) ** 2 / (n - 1) + (c2 / c0) ** 2 / (n - 2)
                                + (c3 / c0) ** 2 / (n - 3)), 5) AS ljung_box
    FROM s""")
def residual_diagnostics(spark, sf_dir):
    days = order_days(spark, sf_dir, KEY)
    means = days.groupBy(KEY).agg(F.avg("n").alias("m"))
    resid = days.join(means, KEY).withColumn("e", F.col("n") - F.col("m"))
    out = residual_tests(resid, [KEY], "date", "e", 3)
    return out.select(KEY, "n", *[F.round(c, 5).alias(c) for c in (
        "heteroskedasticity", "skew", "kurtosis", "ljung_box")],
        F.round("jarque_bera", 4).alias("jarque_bera"))


@query(f"""
    WITH d AS ({order_days_sql(KEY)}),
    z AS (SELECT {KEY}, (price - avg(price) OVER w) / stddev_pop(price) OVER w AS z FROM d
          WINDOW w AS (PARTITION BY {KEY}))
    SELECT {KEY}, CAST(row_number() OVER (PARTITION BY {KEY} ORDER BY z) AS INTEGER) AS position,
           round(z, 6) AS sample FROM z""")
def quantile_quantile_pairs(spark, sf_dir):
    z = standardised(order_days(spark, sf_dir, KEY), [KEY], "price")
    out = quantile_pairs(z, [KEY], "z").select(KEY, "position", "sample")
    return _rounded(out, "sample")


@query(f"""
    WITH d AS ({order_days_sql(KEY)}),
    r AS (SELECT {KEY}, sqrt(n) - avg(sqrt(n)) OVER (PARTITION BY {KEY}) AS e FROM d)
    SELECT {KEY}, round(avg(e * e), 6) AS mse, round(sqrt(avg(e * e)), 6) AS rmse FROM r GROUP BY 1""")
def mean_model_training_error(spark, sf_dir):
    days = order_days(spark, sf_dir, KEY).withColumn("y", transform_column("n", "sqrt"))
    means = days.groupBy(KEY).agg(F.avg("y").alias("m"))
    return _rounded(training_error(days.join(means, KEY).withColumn("resid", F.col("y") - F.col("m")), [KEY]),
                    "mse", "rmse")


@query(f"""
    WITH {_DENSE},
    v AS (SELECT {KEY}, date, CAST(n AS DOUBLE) AS n FROM f),
    l AS (SELECT {KEY}, n - lag(n) OVER (PARTITION BY {KEY} ORDER BY date) AS dy,
                 lag(n) OVER (PARTITION BY {KEY} ORDER BY date) AS y1 FROM v),
    s AS (SELECT {KEY}, regr_slope(dy, y1) AS b, regr_sxx(dy, y1) AS sxx,
                 regr_syy(dy, y1) * (1 - regr_r2(dy, y1)) AS rss, regr_count(dy, y1) AS n FROM l GROUP BY 1),
    t AS (SELECT {KEY}, n, b / sqrt(rss / (n - 2) / sxx) AS t FROM s),
    u AS (SELECT *, -2.86154 - 2.8903 / n - 4.234 / n ** 2 - 40.04 / n ** 3 AS crit_5 FROM t)
    SELECT {KEY}, CAST(0 AS INTEGER) AS d, round(t, 5) AS stat, CAST(n AS INTEGER) AS nobs,
           round(crit_5, 6) AS crit_5, t < crit_5 AND (t < -18.83
               OR (t <= -1.61 AND 2.1659 + 1.4412 * t + 0.038269 * t * t < -3.090232306)) AS stationary
    FROM u""")
def unit_root_statistics(spark, sf_dir):
    out = adf(dense_orders(spark, sf_dir), [KEY], "date", "n", max_lag=0)
    return out.select(KEY, "d", F.round("stat", 5).alias("stat"), "nobs",
                      F.round("crit_5", 6).alias("crit_5"), "stationary")


@query(f"""
    WITH {_DENSE},
    v AS (SELECT {KEY}, date, CAST(n AS DOUBLE) AS n FROM f),
    a AS (SELECT {KEY}, date, n - lag(n) OVER w AS once, n - lag(n, 7) OVER w AS season FROM v
          WINDOW w AS (PARTITION BY {KEY} ORDER BY date)),
    z AS (SELECT {KEY}, season - lag(season) OVER w AS y, lag(season) OVER w AS z4, lag(once, 7) OVER w AS z5
          FROM a WINDOW w AS (PARTITION BY {KEY} ORDER BY date)),
    s AS (SELECT {KEY}, count(*) AS n, sum(z4 * z4) AS a11, sum(z4 * z5) AS a12, sum(z5 * z5) AS a22,
                 sum(z4 * y) AS b1, sum(z5 * y) AS b2, sum(y * y) AS yy
          FROM z WHERE y IS NOT NULL AND z4 IS NOT NULL AND z5 IS NOT NULL GROUP BY 1),
    q AS (SELECT *, (b1 * a22 - b2 * a12) / (a11 * a22 - a12 * a12) AS c1,
                 (b2 * a11 - b1 * a12) / (a11 * a22 - a12 * a12) AS c2 FROM s),
    t AS (SELECT {KEY}, c2 / sqrt((yy - c1 * b1 - c2 * b2) / (n - 2) * a11 / (a11 * a22 - a12 * a12)) AS stat
          FROM q)
    SELECT {KEY}, round(stat, 5) AS stat, CAST(stat > -0.2937411 * exp(-0.2850853 * (ln(7) - 0.7656451)
           - 0.05983644 * (ln(7) - 0.7656451) ** 2) - 1.652202 AS INTEGER) AS D FROM t""")
def seasonal_root_statistics(spark, sf_dir):
    out = ocsb(dense_orders(spark, sf_dir), [KEY], "date", "n", 7, max_lag=0)
    return out.select(KEY, F.round("stat", 5).alias("stat"), "D")


@query()
def stationarity_tests(spark, sf_dir):
    return adf(dense_orders(spark, sf_dir), [KEY], "date", "n", orders=(0, 1, 2))


@query()
def chosen_differences(spark, sf_dir):
    return choose_d(dense_orders(spark, sf_dir), [KEY], "date", "n")


@query()
def seasonal_difference_tests(spark, sf_dir):
    return ocsb(dense_orders(spark, sf_dir), [KEY], "date", "n", 7)
