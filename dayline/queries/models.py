"""Configurations, fits, scores and forecasts over keyed daily series."""

from pyspark.sql import functions as F

from dayline.models.grid import Config, config_grid, configurations, cross, valid_configs
from dayline.models.series import (best_config, compare, cross_validate, fit, fitted_values, forecast,
                                   grid_search, training_error)
from dayline.operators.joins import fit_and_forecast_frame
from dayline.operators.windows import densify, ffill, hold_last
from dayline.plans.modelling import forecast_run, read_forecasts, store_forecasts, tune
from dayline.queries import query
from dayline.queries.analysis import KEY, _DENSE, dense_orders
from dayline.queries.tables import order_days, table
from dayline.session import scratch_path

# Models without coefficients: tomorrow is as today, or as the same weekday last week.
_NAIVE = [Config(p=0, d=1), Config(p=0, sd=1, m=7)]
# The shipped search space.
SPACE = dict(p=range(6), d=[1], q=range(6), sp=range(3), sd=[0], sq=range(3), m=[7], trend=["n"])


@query("""
    SELECT c_nationkey, count(*) AS n_configs FROM customer, range(6) p(p), range(2) d(d), range(3) sd(sd)
    WHERE d + sd <= 2 GROUP BY 1""")
def configurations_per_nation(spark, sf_dir):
    configs = configurations(range(6), range(2), [0], [0], range(3), [0], [7])
    rows = cross(table(spark, sf_dir, "customer").select("c_nationkey"), configs)
    return valid_configs(rows).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_configs"))


@query(f"""
    WITH {_DENSE},
    w AS (SELECT {KEY}, date, n - lag(n) OVER (PARTITION BY {KEY} ORDER BY date) AS w FROM f),
    l AS (SELECT {KEY}, w, lag(w) OVER (PARTITION BY {KEY} ORDER BY date) AS w1 FROM w)
    SELECT {KEY}, round(regr_intercept(w, w1), 5) AS intercept, round(regr_slope(w, w1), 5) AS ar1,
           CAST(regr_count(w, w1) AS INTEGER) AS n FROM l GROUP BY 1""")
def autoregression_of_differences(spark, sf_dir):
    out = fit(dense_orders(spark, sf_dir), [KEY], "date", "n", [], Config(p=1, d=1, trend="c"))
    return out.select(KEY, F.round(F.col("coef")[0], 5).alias("intercept"),
                      F.round(F.col("coef")[1], 5).alias("ar1"), "n")


@query(f"""
    WITH {_DENSE},
    l AS (SELECT {KEY}, date, n, lag(n, 7) OVER (PARTITION BY {KEY} ORDER BY date) AS x FROM f),
    line AS (SELECT {KEY}, regr_slope(n, x) AS s, regr_intercept(n, x) AS i FROM l GROUP BY 1)
    SELECT {KEY}, date, CAST(n AS DOUBLE) AS data, round(i + s * x, 5) AS fitted
    FROM l JOIN line USING ({KEY})""")
def seasonal_autoregression_fit(spark, sf_dir):
    cfg = Config(p=0, sp=1, m=7, trend="c")
    out = fitted_values(dense_orders(spark, sf_dir), [KEY], "date", "n", [], cfg)
    return out.select(KEY, "date", "data", F.round("fitted", 5).alias("fitted"))


@query(f"""
    WITH {_DENSE},
    l AS (SELECT {KEY}, date, n, lag(n) OVER (PARTITION BY {KEY} ORDER BY date) AS x FROM f),
    line AS (SELECT {KEY}, regr_slope(n, x) AS s, regr_intercept(n, x) AS i,
                 regr_syy(n, x) * (1 - regr_r2(n, x)) / regr_count(n, x) AS v,
                 arg_max(n, date) AS y0, max(date) AS last FROM l GROUP BY 1),
    h AS (SELECT {KEY}, last + 1 AS date, i + s * y0 AS forecast, sqrt(v) AS se FROM line
          UNION ALL SELECT {KEY}, last + 2, i + s * (i + s * y0), sqrt(v * (1 + s * s)) FROM line
          UNION ALL SELECT {KEY}, last + 3, i + s * (i + s * (i + s * y0)),
                           sqrt(v * (1 + s * s + s ** 4)) FROM line)
    SELECT {KEY}, date, round(forecast, 5) AS forecast, round(se, 5) AS se,
           round(forecast - 1.959964 * se, 5) AS lower_ci, round(forecast + 1.959964 * se, 5) AS upper_ci
    FROM h""")
def three_day_forecast(spark, sf_dir):
    out = forecast(dense_orders(spark, sf_dir), [KEY], "date", "n", [], Config(p=1, trend="c"), 3)
    return out.select(KEY, "date", *[F.round(c, 5).alias(c)
                                     for c in ("forecast", "se", "lower_ci", "upper_ci")])


@query(f"""
    WITH {_DENSE},
    p AS (SELECT {KEY}, n, row_number() OVER (PARTITION BY {KEY} ORDER BY date) - 1 AS i,
                 count(*) OVER (PARTITION BY {KEY}) AS total,
                 lag(n) OVER (PARTITION BY {KEY} ORDER BY date) AS before FROM f),
    k AS (SELECT {KEY}, n, i, k, total - (30 - k) * (total // 31) AS start FROM p, range(30) AS r(k)),
    y0 AS (SELECT {KEY}, k, n AS y0 FROM k WHERE i = start - 1),
    s AS (SELECT {KEY}, k, sqrt(avg((n - y0) ** 2)) AS score FROM k JOIN y0 USING ({KEY}, k)
          WHERE i >= start AND i < start + least(7, (SELECT min(total) FROM p) // 31) GROUP BY 1, 2)
    SELECT {KEY}, CAST(0 AS INTEGER) AS cfg_id, round(avg(score), 5) AS score_mean,
           round(stddev_samp(score) / sqrt(count(*)), 5) AS score_se FROM s GROUP BY 1""")
def random_walk_scores(spark, sf_dir):
    out = cross_validate(dense_orders(spark, sf_dir), [KEY], "date", "n", [], [Config(p=0, d=1)], 30, 7)
    return out.select(KEY, "cfg_id", F.round("score_mean", 5).alias("score_mean"),
                      F.round("score_se", 5).alias("score_se"))


@query(f"""
    WITH {_DENSE},
    l AS (SELECT {KEY}, date, n, lag(n) OVER w AS x1, lag(n, 7) OVER w AS x7 FROM f
          WINDOW w AS (PARTITION BY {KEY} ORDER BY date)),
    r AS (SELECT {KEY}, 0 AS cfg_id, regr_count(n, x1) AS n, regr_syy(n, x1) * (1 - regr_r2(n, x1)) AS rss
          FROM l GROUP BY 1
          UNION ALL SELECT {KEY}, 1, regr_count(n, x7), regr_syy(n, x7) * (1 - regr_r2(n, x7)) FROM l GROUP BY 1),
    a AS (SELECT {KEY}, cfg_id, n * ln(rss / n) + 6 AS aic FROM r)
    SELECT {KEY}, CAST(cfg_id AS INTEGER) AS cfg_id, round(aic, 4) AS score_mean,
           CAST(row_number() OVER (PARTITION BY {KEY} ORDER BY aic, cfg_id) AS INTEGER) AS "rank" FROM a""")
def leaderboard_by_information(spark, sf_dir):
    configs = [Config(p=1, trend="c"), Config(p=0, sp=1, m=7, trend="c")]
    out = grid_search(dense_orders(spark, sf_dir), [KEY], "date", "n", [], configs, "aic", common=False)
    return out.select(KEY, "cfg_id", F.round("score_mean", 4).alias("score_mean"), "rank")


@query(f"""
    WITH {_DENSE},
    l AS (SELECT {KEY}, date, n, lag(n) OVER w AS x1, lag(n, 7) OVER w AS x7 FROM f
          WINDOW w AS (PARTITION BY {KEY} ORDER BY date) QUALIFY lag(n, 7) OVER w IS NOT NULL),
    r AS (SELECT {KEY}, 0 AS cfg_id, count(*) AS n, regr_syy(n, x1) * (1 - regr_r2(n, x1)) AS rss, 6 AS cost FROM l GROUP BY 1
          UNION ALL SELECT {KEY}, 1, count(*), regr_syy(n, x7) * (1 - regr_r2(n, x7)), 6 FROM l GROUP BY 1
          UNION ALL SELECT {KEY}, 2, count(*), sum((n - x1) ** 2), 2 FROM l GROUP BY 1
          UNION ALL SELECT {KEY}, 3, count(*), sum((n - x7) ** 2), 2 FROM l GROUP BY 1),
    a AS (SELECT {KEY}, cfg_id, n * ln(rss / n) + cost AS aic FROM r)
    SELECT {KEY}, CAST(cfg_id AS INTEGER) AS cfg_id, round(aic, 4) AS score_mean,
           CAST(row_number() OVER (PARTITION BY {KEY} ORDER BY aic, cfg_id) AS INTEGER) AS "rank" FROM a""")
def leaderboard_on_the_same_days(spark, sf_dir):
    """Two lags and two differences, all judged on the days that the longest can use."""
    configs = [Config(p=1, trend="c"), Config(p=0, sp=1, m=7, trend="c"), *_NAIVE]
    out = grid_search(dense_orders(spark, sf_dir), [KEY], "date", "n", [], configs, "aic")
    return out.select(KEY, "cfg_id", F.round("score_mean", 4).alias("score_mean"), "rank")


_NAIVE_SQL = f"""
    {_DENSE},
    p AS (SELECT {KEY}, n, row_number() OVER (PARTITION BY {KEY} ORDER BY date) - 1 AS i,
                 count(*) OVER (PARTITION BY {KEY}) AS total FROM f),
    k AS (SELECT {KEY}, n, i, k, total - (10 - k) * (total // 11) AS start,
                 least(7, total // 11) AS size FROM p, range(10) AS r(k)),
    past AS (SELECT {KEY}, k, start - i AS back, n AS before FROM k WHERE i < start AND i >= start - 7),
    test AS (SELECT {KEY}, k, i - start AS h, n FROM k WHERE i >= start AND i < start + size),
    s AS (SELECT test.{KEY}, test.k, 0 AS cfg_id, sqrt(avg((n - before) ** 2)) AS score FROM test
          JOIN past ON test.{KEY} = past.{KEY} AND test.k = past.k AND back = 1 GROUP BY 1, 2
          UNION ALL
          SELECT test.{KEY}, test.k, 1, sqrt(avg((n - before) ** 2)) FROM test
          JOIN past ON test.{KEY} = past.{KEY} AND test.k = past.k AND back = 7 - h GROUP BY 1, 2),
    board AS (SELECT {KEY}, CAST(cfg_id AS INTEGER) AS cfg_id, avg(score) AS score_mean,
                     stddev_samp(score) / sqrt(count(*)) AS score_se FROM s GROUP BY 1, 2)"""


@query(f"""
    WITH {_NAIVE_SQL}
    SELECT 'day' AS model, {KEY}, round(score_mean, 5) AS score_mean FROM board WHERE cfg_id = 0
    UNION ALL SELECT 'week', {KEY}, round(score_mean, 5) FROM board WHERE cfg_id = 1
    UNION ALL SELECT 'either', {KEY}, round(min(score_mean), 5) FROM board GROUP BY {KEY}""")
def naive_models_side_by_side(spark, sf_dir):
    series = dense_orders(spark, sf_dir)
    boards = {name: grid_search(series, [KEY], "date", "n", [], configs, "rmse", 10, 7)
              for name, configs in (("day", _NAIVE[:1]), ("week", _NAIVE[1:]), ("either", _NAIVE))}
    out = compare(boards, [KEY])
    return out.select("model", KEY, F.round("score_mean", 5).alias("score_mean"))


@query(f"""
    WITH {_NAIVE_SQL},
    n AS (SELECT {KEY}, count(*) AS rows, min(date) AS first, max(date) AS last FROM f GROUP BY 1)
    SELECT {KEY}, true AS best_first, CAST(1 - cfg_id AS INTEGER) AS d,
           CAST(cfg_id AS INTEGER) AS sd, round(score_mean, 5) AS score_mean, round(score_se, 5) AS score_se,
           first AS first_date, last AS last_date, CAST(rows - 10 * (rows // 11) AS INTEGER) AS train_min
    FROM board JOIN n USING ({KEY})""")
def tuning_results_of_naive_models(spark, sf_dir):
    conf = {"outputs": ["n"], "date_from": "", "p_values": [0], "d_values": [0, 1], "q_values": [0],
            "P_values": [0], "D_values": [0, 1], "Q_values": [0], "cv_n_splits": 10}
    runs = tune(order_days(spark, sf_dir, KEY), conf, [KEY], kind=None)
    scores = F.col("results.score_mean")
    each = runs.select(KEY, "log", (scores == F.array_sort(scores)).alias("best_first"),
                       F.explode("results").alias("r"))
    d, sd = F.col("r.cfg.arima_order")[1], F.col("r.cfg.seasonal_order")[1]
    # the grid also holds neither and both differences; SQL has the two single ones
    return each.filter(d + sd == 1).select(
        KEY, "best_first", d.alias("d"), sd.alias("sd"),
        F.round("r.score_mean", 5).alias("score_mean"),
        F.round("r.score_se", 5).alias("score_se"),
        F.col("log.date_range")[0].cast("date").alias("first_date"),
        F.col("log.date_range")[1].cast("date").alias("last_date"),
        F.col("log.splits_train_size_min").alias("train_min"))


@query(f"""
    WITH {_DENSE},
    v AS (SELECT {KEY}, date, n, last_value(price IGNORE NULLS) OVER (
              PARTITION BY {KEY} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS x
          FROM f LEFT JOIN (SELECT {KEY}, date, price FROM d) USING ({KEY}, date)),
    line AS (SELECT {KEY}, regr_slope(n, x) AS s, regr_intercept(n, x) AS i, arg_max(x, date) AS x,
                    max(date) AS last FROM v GROUP BY 1)
    SELECT {KEY}, CAST(last + CAST(h AS INTEGER) AS DATE) AS date, round(i + s * x, 5) AS forecast
    FROM line, range(1, 8) AS r(h)""")
def regression_forecast_with_held_regressor(spark, sf_dir):
    out = forecast(dense_orders(spark, sf_dir), [KEY], "date", "n", ["price"],
                   Config(p=0, trend="c"), 7)
    return out.select(KEY, "date", F.round("forecast", 5).alias("forecast"))


@query(f"""
    WITH {_DENSE},
    v AS (SELECT {KEY}, date, n, last_value(price IGNORE NULLS) OVER (
              PARTITION BY {KEY} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS x
          FROM f LEFT JOIN (SELECT {KEY}, date, price FROM d) USING ({KEY}, date)),
    last AS (SELECT {KEY}, max(date) AS last, arg_max(x, date) AS x FROM v GROUP BY 1)
    SELECT 'n' AS output_variable, {KEY}, date + 7 AS date, CAST(n AS DOUBLE) AS forecast
    FROM v JOIN last USING ({KEY}) WHERE date > last - 7
    UNION ALL SELECT 'price', {KEY}, CAST(last + CAST(h AS INTEGER) AS DATE), round(last.x, 2)
    FROM last, range(1, 8) AS r(h) WHERE last + CAST(h AS INTEGER) <= DATE '2001-08-05'""")
def stored_forecasts_after_a_second_run(spark, sf_dir):
    series, path = dense_orders(spark, sf_dir), scratch_path(spark, "forecasts")

    def store(*outputs):
        for y, cfg in outputs:
            made = forecast(series, [KEY], "date", y, [], cfg, 7).withColumn("output_variable", F.lit(y))
            store_forecasts(made, path, [KEY])

    store(("n", _NAIVE[0]), ("price", _NAIVE[0]))
    store(("n", _NAIVE[1]))
    both = read_forecasts(spark, path, "n").unionByName(
        read_forecasts(spark, path, "price", hi="2001-08-05"))
    return both.select("output_variable", KEY, "date", F.round("forecast", 2).alias("forecast"))


@query()
def shipped_grid_leaderboard(spark, sf_dir):
    series = ffill(densify(order_days(spark, sf_dir), [], "date"), [], "date")
    return grid_search(series, [], "date", "n", [], configurations(**SPACE), "rmse", 30, 7, "sqrt", 8)


@query()
def moving_average_forecast(spark, sf_dir):
    cfg = Config(4, 1, 5, 1, 0, 1, 7)
    series = dense_orders(spark, sf_dir)
    made = forecast(series, [KEY], "date", "n", [], cfg, 7, "sqrt")
    past = fitted_values(series, [KEY], "date", "n", [], cfg, "sqrt")
    return fit_and_forecast_frame(past.drop("resid"), made.drop("se"), [KEY])


@query()
def regressor_forecast(spark, sf_dir):
    series = dense_orders(spark, sf_dir)
    plan = hold_last(series, [KEY], "date", ["price"], 7)
    return forecast(series, [KEY], "date", "n", ["price"], Config(2, 1, 1), 7, "sqrt", plan)


@query()
def residuals_of_best_orders(spark, sf_dir):
    past = fitted_values(dense_orders(spark, sf_dir), [KEY], "date", "n", [], Config(4, 1, 5, 1, 0, 1, 7), "sqrt")
    return training_error(past, [KEY])


@query()
def models_side_by_side(spark, sf_dir):
    series = dense_orders(spark, sf_dir)
    configs = [Config(1, 1, 0), Config(2, 1, 1)]
    boards = {name: grid_search(series, [KEY], "date", "n", x, configs, "rmse", 10, 7, "sqrt")
              for name, x in (("alone", []), ("with price", ["price"]))}
    return compare(boards, [KEY])


_CONF = {"outputs": ["n"], "regressors": [], "date_from": "1996", "p_values": [0, 1, 2],
         "q_values": [0, 1], "P_values": [0, 1], "Q_values": [0], "cv_n_splits": 10}


@query()
def tuning_documents(spark, sf_dir):
    days = order_days(spark, sf_dir, KEY)
    runs = tune(days, _CONF, [KEY])
    return runs.select(KEY, "configuration", "results", F.col("log.date_range").alias("date_range"),
                       "log.splits_train_size_min", "log.splits_train_size_max")


@query(f"""
    WITH d AS (SELECT DISTINCT {KEY} FROM orders), last AS (
        SELECT {KEY}, CAST(max(o_orderdate) AS DATE) AS last FROM orders GROUP BY 1)
    SELECT {KEY}, 'n' AS output_variable, CAST(last + CAST(s AS INTEGER) AS DATE) AS date,
           true AS ordered FROM last, range(1, 8) AS r(s)""")
def forecast_run_days(spark, sf_dir):
    days = order_days(spark, sf_dir, KEY)
    made = forecast_run(days, tune(days, _CONF, [KEY]), [{"output": "n", "regressors": []}], 7, [KEY])
    return made.select(KEY, "output_variable", "date", (
        (F.col("lower_ci") <= F.col("forecast")) & (F.col("forecast") <= F.col("upper_ci"))).alias("ordered"))


@query(f"""
    WITH r AS (SELECT {KEY}, o_orderstatus, o_orderdate AS stamp, o_orderkey FROM orders)
    SELECT {KEY}, CAST(length(o_orderstatus) AS INTEGER) AS p, CAST(1 AS INTEGER) AS d, 'n' AS trend,
           CAST(o_orderkey % 7 AS INTEGER) AS q FROM r WHERE o_orderstatus = 'F'
    QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY stamp DESC, o_orderkey DESC) = 1""")
def newest_matching_run(spark, sf_dir):
    number = (F.col("o_orderkey") % 7).cast("int")
    cfg = F.struct(F.array(F.length("o_orderstatus"), F.lit(1), number).alias("arima_order"),
                   F.array(F.lit(0), F.lit(0), F.lit(0), F.lit(7)).alias("seasonal_order"),
                   F.lit("n").alias("trend"))
    regressors = F.when(F.col("o_orderstatus") == "F", F.array(F.lit("b"), F.lit("a"), F.lit("b"))) \
        .otherwise(F.array(F.lit("a")))
    # the key breaks ties between runs of the same instant
    at = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.col("o_orderkey").cast("decimal(18,6)") / 1000000)
    runs = table(spark, sf_dir, "orders").select(
        KEY, F.struct(at.alias("timestamp")).alias("log"),
        F.struct(F.array(F.lit("y")).alias("outputs"), regressors.alias("regressors")).alias("configuration"),
        F.array(F.struct(cfg.alias("cfg"))).alias("results"))
    return best_config(runs, "y", ["a", "b"], [KEY]).select(KEY, "p", "d", "trend", "q")
