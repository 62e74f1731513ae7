import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayline.models.grid import Config, config_grid, configurations, cross, valid_configs
from dayline.models.least_squares import first_day, difference as np_difference
from dayline.models.least_squares import fit_series, forecast_series, shifted
from dayline.models.series import (best_config, compare, cross_validate, fit, fitted_values, fold_bounds,
                                   forecast, grid_search, interval, nest_leaderboard, training_error)
from dayline.operators.diagnostics import (acf, adf, choose_d, decompose, ocsb, pacf, residual_tables,
                                           residual_tests, seasonal_critical_value, unit_root_p)
from dayline.operators.regression import ols, ols_residuals

FIRST = dt.date(2020, 1, 1)
RNG = np.random.default_rng(11)


def frame(spark, *arrays, names=("y",), key="a"):
    data = [(key, FIRST + dt.timedelta(i), *map(float, v)) for i, v in enumerate(zip(*arrays))]
    return spark.createDataFrame(data, "k string, date date, " + ", ".join(f"{n} double" for n in names))


def arma(n, ar=0.6, ma=0.0, seed=1):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 50)
    y = np.zeros(n + 50)
    for t in range(1, n + 50):
        y[t] = ar * y[t - 1] + e[t] + ma * e[t - 1]
    return y[50:]


def test_grid_order_size_and_validity(spark):
    space = dict(p=range(6), d=[1], q=range(6), sp=range(3), sd=[0], sq=range(3), m=[7], trend=["n"])
    configs = configurations(**space)
    assert len(configs) == 324
    assert configs[1] == Config(0, 1, 0, 0, 0, 1, 7) and configs[-1] == Config(5, 1, 5, 2, 0, 2, 7)
    assert config_grid(spark, **space).filter("cfg_id = 1").first()["sq"] == 1
    odd = [Config(1, 2, 0, 0, 1, 0, 7), Config(1, 1, 0, 1, 0, 0, 0), Config(1, 1, 0)]
    assert [c.valid for c in odd] == [False, False, True]
    assert valid_configs(cross(spark.range(1), odd)).first()["cfg_id"] == 2


def test_fit_equals_plain_least_squares(spark):
    y, x = arma(200), RNG.normal(size=200)
    df = frame(spark, y, x, names=("y", "x"))
    row = fit(df, ["k"], "date", "y", ["x"], Config(2, 1, 0, 1, 0, 0, 7, "ct")).first()
    w, dx = np.diff(y), np.diff(x)
    design = np.column_stack([np.ones(199), np.arange(1, 200), shifted(w, [1, 2, 7]), dx])[7:]
    want = np.linalg.lstsq(design, w[7:], rcond=None)[0]
    assert row["terms"] == ["intercept", "drift", "ar.L1", "ar.L2", "ar.L7", "x0"]
    assert row["coef"] == pytest.approx(want, rel=1e-6, abs=1e-9)
    assert row["n"] == 192
    rss = float(np.sum((w[7:] - design @ want) ** 2))
    assert row["rss"] == pytest.approx(rss) and row["aic"] == pytest.approx(192 * math.log(rss / 192) + 14)


def test_moving_average_terms_are_found():
    y = arma(6000, ar=0.5, ma=0.4, seed=3)
    done = fit_series(Config(1, 0, 1), y, np.zeros((6000, 0)))
    assert dict(zip(done.names, done.coef)) == pytest.approx({"ar.L1": 0.5, "ma.L1": 0.4}, abs=0.06)


def test_forecast_against_a_hand_recursion():
    y = np.cumsum(arma(150, seed=5))
    cfg = Config(1, 1, 0, 0, 1, 0, 7)
    done = fit_series(cfg, y, np.zeros((150, 0)))
    mean, se = forecast_series(cfg, done, y, np.zeros((150, 0)), np.zeros((4, 0)))
    phi, path = done.coef[0], list(y)
    w = list(np_difference(y, 1, 1, 7))
    for _ in range(4):
        w.append(phi * w[-1])
        path.append(w[-1] + path[-1] + path[-7] - path[-8])
    assert mean == pytest.approx(path[150:])
    assert se[0] == pytest.approx(math.sqrt(done.sigma2))
    assert se[1] == pytest.approx(math.sqrt(done.sigma2 * (1 + (1 + phi) ** 2)))


def test_forecast_with_regressor_and_moving_average():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 1))
    y = 3 + 2 * x[:, 0] + rng.normal(scale=0.1, size=120)
    cfg = Config(0, 0, 1, trend="c")
    done = fit_series(cfg, y, x)
    mean, _ = forecast_series(cfg, done, y, x, np.array([[0.5], [1.0]]))
    c, theta, beta = done.coef
    assert mean == pytest.approx([c + theta * done.resid[-1] + beta * 0.5, c + beta])


def test_regressor_default_scenario_holds_the_last_value(spark):
    x = np.r_[RNG.normal(size=59), 4.0]
    df = frame(spark, 1.0 + x, x, names=("y", "x"))
    out = forecast(df, ["k"], "date", "y", ["x"], Config(0, 0, 0, trend="c"), 5).orderBy("date").collect()
    assert [r["forecast"] for r in out] == pytest.approx([5.0] * 5)
    assert out[0]["date"] == FIRST + dt.timedelta(60)


def test_a_scenario_is_met_by_date(spark):
    """Days before and after the forecast, in any order, change nothing; a day that is not there fails."""
    x = np.r_[RNG.normal(size=59), 4.0]
    df = frame(spark, 1.0 + x, x, names=("y", "x"))
    key = df.first()["k"]
    days = [(key, FIRST + dt.timedelta(60 + n), float(10 * n)) for n in range(-3, 9)]
    plan = spark.createDataFrame(days[::-1], df.select("k", "date", "x").schema)
    cfg = Config(0, 0, 0, trend="c")
    out = forecast(df, ["k"], "date", "y", ["x"], cfg, 4, scenario=plan).orderBy("date").collect()
    assert [r["forecast"] for r in out] == pytest.approx([1.0, 11.0, 21.0, 31.0])
    hole = plan.filter(F.col("date") != FIRST + dt.timedelta(62))
    with pytest.raises(Exception, match="no values for 2"):
        forecast(df, ["k"], "date", "y", ["x"], cfg, 4, scenario=hole).collect()


def test_information_is_compared_on_the_same_days():
    y = np.cumsum(RNG.normal(size=200))
    configs = [Config(1, 0, 0, trend="c"), Config(3, 1, 0), Config(0, 1, 2), Config(0, 1, 0, 1, 0, 0, 7), Config(0, 0, 0, 0, 1, 0, 7)]
    first = max(first_day(c, len(y)) for c in configs)
    assert {fit_series(c, y, np.zeros((200, 0)), None, first).n for c in configs} == {200 - first}
    for c in configs:  # the first day is the first that the fit uses by itself
        assert fit_series(c, y, np.zeros((200, 0))).n == 200 - first_day(c, 200)


def test_intervals_after_squaring(spark):
    df = spark.createDataFrame([(3.0, 1.0), (1.0, 1.0)], "forecast double, se double")
    ours, squared = interval(df, "sqrt").collect(), interval(df, "sqrt", compat=True).collect()
    assert (ours[0]["forecast"], ours[0]["se"]) == (9.0, 6.0)
    assert ours[1]["lower_ci"] == 0.0 and squared[1]["lower_ci"] > 0.9
    assert squared[0]["se"] == 1.0
    assert ours[0]["upper_ci"] == pytest.approx(4.959964 ** 2)


def test_too_short_series_gives_no_forecast(spark):
    df = frame(spark, [1.0, 2.0, 3.0])
    assert fit(df, ["k"], "date", "y", [], Config(2, 1, 0)).first()["n"] == 0
    out = forecast(df, ["k"], "date", "y", [], Config(2, 1, 0), 2).collect()
    assert [r["forecast"] for r in out] == [None, None]


def test_scores_against_a_loop(spark):
    y = np.abs(arma(120, seed=9)) + 2
    configs = [Config(1, 0, 0, trend="c"), Config(2, 1, 1), Config(1, 2, 0, 0, 1, 0, 7)]
    scores = cross_validate(frame(spark, y), ["k"], "date", "y", [], configs, 5, 7, "sqrt", block=2)
    got = {r["cfg_id"]: (r["score_mean"], r["score_se"]) for r in scores.collect()}
    assert set(got) == {0, 1}  # differencing three times is not scored
    root = np.sqrt(y)
    for i in (0, 1):
        each = []
        for train, test in fold_bounds(120, 5, 7):
            none = np.zeros((train, 0))
            done = fit_series(configs[i], root[:train], none)
            mean, _ = forecast_series(configs[i], done, root[:train], none, np.zeros((test, 0)))
            each.append(math.sqrt(np.mean((y[train:train + test] - mean ** 2) ** 2)))
        assert got[i] == pytest.approx((np.mean(each), np.std(each, ddof=1) / math.sqrt(5)))


def test_block_size_does_not_change_scores(spark, rows):
    df = frame(spark, arma(90))
    configs = configurations([0, 1, 2], [0, 1], [0, 1], [0], [0], [0], [0])
    boards = [rows(grid_search(df, ["k"], "date", "y", [], configs, "rmse", 4, 3, block=b), "cfg_id", "rank")
              for b in (1, 5, 100)]
    assert boards[0] == boards[1] == boards[2] and len(boards[0]) == 12


def test_information_ranks_smallest_first(spark):
    df = frame(spark, arma(150))
    board = grid_search(df, ["k"], "date", "y", [], [Config(0, 0, 0, trend="c"), Config(1, 0, 0, trend="c")], "aic")
    assert [r["cfg_id"] for r in board.orderBy("rank").collect()] == [1, 0]
    with pytest.raises(ValueError):
        grid_search(df, ["k"], "date", "y", [], [Config()], "r2")


def test_best_config_takes_newest_run_of_the_same_set(spark):
    df = frame(spark, arma(100))
    board = grid_search(df, ["k"], "date", "y", [], [Config(1), Config(2)], "aic")
    nested = nest_leaderboard(board, ["k"])
    runs = None
    for day, regs, keep in ((1, ["a", "b"], 0), (2, ["b", "a"], 1), (3, ["a"], 0)):
        regs_col = F.array(*[F.lit(r) for r in regs])
        part = nested.select(
            "k", F.struct(F.lit(dt.datetime(2021, 1, day)).alias("timestamp")).alias("log"),
            F.struct(F.array(F.lit("y")).alias("outputs"), regs_col.alias("regressors")).alias("configuration"),
            F.slice("results", keep + 1, 2).alias("results"))
        runs = part if runs is None else runs.unionByName(part)
    second = board.filter("rank = 2").first()["p"]
    assert best_config(runs, "y", ["a", "b"], ["k"]).first()["p"] == second
    assert best_config(runs, "z", ["a"], ["k"]).count() == 0
    assert best_config(runs, "y", [], []).count() == 0


def test_fitted_values_and_errors(spark):
    df = frame(spark, arma(80))
    out = fitted_values(df, ["k"], "date", "y", [], Config(2, 1, 0))
    assert out.filter("fitted IS NULL").count() == 3
    assert out.filter("abs(data - fitted - resid) > 1e-9").count() == 0
    err = training_error(out, ["k"]).first()
    assert err["rmse"] == pytest.approx(math.sqrt(err["mse"]))


def test_models_side_by_side(spark, rows):
    df = frame(spark, arma(90))
    board = grid_search(df, ["k"], "date", "y", [], [Config(1)], "rmse", 4, 3)
    assert rows(compare({"one": board, "two": board}, ["k"]), "model", "cfg_id") == [("one", 0), ("two", 0)]


def direct_acf(y, k):
    c = y - y.mean()
    return float(np.sum(c[k:] * c[:len(c) - k]) / np.sum(c * c))


def test_acf_and_pacf(spark):
    y = arma(300)
    df = frame(spark, y)
    r = {x["lag"]: x["r"] for x in acf(df, ["k"], "date", "y", 12).collect()}
    assert r == pytest.approx({k: direct_acf(y, k) for k in range(13)})
    partial = {x["lag"]: x["r"] for x in pacf(df, ["k"], "date", "y", 6).collect()}
    for k in range(1, 7):
        toeplitz = np.array([[direct_acf(y, abs(i - j)) for j in range(k)] for i in range(k)])
        want = np.linalg.solve(toeplitz, [direct_acf(y, i + 1) for i in range(k)])[-1]
        assert partial[k] == pytest.approx(want)
    unkeyed = acf(df.drop("k"), [], "date", "y", 2).collect()
    assert len(unkeyed) == 3


def test_decomposition(spark):
    season = np.tile([3.0, 1, 0, 0, -1, -1, -2], 12)
    df = frame(spark, 0.5 * np.arange(84) + season)
    parts = decompose(df, ["k"], "date", "y", 7).orderBy("date").collect()
    assert parts[0]["trend"] is None and parts[-3]["trend"] is None
    assert [p["seasonal"] for p in parts[:7]] == pytest.approx([3, 1, 0, 0, -1, -1, -2])
    assert all(abs(p["resid"]) < 1e-9 for p in parts if p["resid"] is not None)


def test_ols_against_numpy(spark):
    n = 400
    x = RNG.normal(size=(n, 3)) + 1e6
    y = x @ [1.0, -2.0, 0.5] + 7 + RNG.normal(size=n)
    df = frame(spark, y, *x.T, names=("y", "a", "b", "c"))
    got = {r["term"]: r for r in ols(df, ["k"], "y", ["a", "b", "c"]).collect()}
    centred = x - x.mean(axis=0)
    beta = np.linalg.lstsq(centred, y - y.mean(), rcond=None)[0]
    assert [got[t]["coef"] for t in "abc"] == pytest.approx(beta, rel=1e-6)
    resid = y - y.mean() - centred @ beta
    sigma2 = resid @ resid / (n - 4)
    assert [got[t]["se"] for t in "abc"] == pytest.approx(
        np.sqrt(sigma2 * np.diag(np.linalg.inv(centred.T @ centred))), rel=1e-5)
    assert got["a"]["t"] == pytest.approx(got["a"]["coef"] / got["a"]["se"])
    left = ols_residuals(df, ["k"], "y", ["a", "b", "c"]).agg(F.sum("resid"), F.sum(F.col("resid") ** 2)).first()
    assert left[0] == pytest.approx(0, abs=1e-2) and left[1] == pytest.approx(resid @ resid, rel=1e-4)


def test_ols_without_intercept(spark):
    x = RNG.normal(size=50) + 3
    got = ols(frame(spark, 2 * x + 1, x, names=("y", "x")), ["k"], "y", ["x"], intercept=False).collect()
    assert len(got) == 1 and got[0]["coef"] == pytest.approx((2 * x + 1) @ x / (x @ x))


def test_residual_tests(spark):
    e = RNG.normal(size=90)
    row = residual_tests(frame(spark, e), ["k"], "date", "y", 4).first()
    r = [direct_acf(e, k) for k in range(1, 5)]
    assert row["ljung_box"] == pytest.approx(90 * 92 * sum(v * v / (90 - k) for k, v in enumerate(r, 1)))
    assert row["heteroskedasticity"] == pytest.approx(np.sum(e[60:] ** 2) / np.sum(e[:30] ** 2))
    z = (e - e.mean()) / e.std()
    assert row["jarque_bera"] == pytest.approx(90 / 6 * (np.mean(z ** 3) ** 2 + (np.mean(z ** 4) - 3) ** 2 / 4))
    tables = residual_tables(frame(spark, e), ["k"], "date", "y")
    assert set(tables) == {"standardised", "histogram", "quantiles", "correlogram"}
    assert tables["histogram"].agg(F.sum("n")).first()[0] == 90
    assert tables["quantiles"].count() == 90


def test_stationarity(spark):
    walk, noise = np.cumsum(RNG.normal(size=500)), RNG.normal(size=500)
    both = frame(spark, walk, key="walk").unionByName(frame(spark, noise, key="noise"))
    got = {r["k"]: r for r in adf(both, ["k"], "date", "y").collect()}
    assert got["noise"]["stationary"] and not got["walk"]["stationary"]
    assert got["noise"]["crit_5"] == pytest.approx(-2.867, abs=0.003)
    assert {r["k"]: r["d"] for r in choose_d(both, ["k"], "date", "y").collect()} == {"walk": 1, "noise": 0}


def test_adf_statistic_against_a_direct_regression(spark):
    y = arma(200, seed=21)
    row = adf(frame(spark, y), ["k"], "date", "y", max_lag=0).first()
    dy, design = np.diff(y), np.column_stack([y[:-1], np.ones(199)])
    beta = np.linalg.lstsq(design, dy, rcond=None)[0]
    rest = dy - design @ beta
    se = math.sqrt(rest @ rest / 197 * np.linalg.inv(design.T @ design)[0, 0])
    assert row["stat"] == pytest.approx(beta[0] / se) and row["nobs"] == 199 and row["lags"] == 0


def test_p_values_at_the_critical_values():
    assert unit_root_p(-2.86) == pytest.approx(0.05, abs=0.003)
    assert unit_root_p(-3.43) == pytest.approx(0.01, abs=0.001)
    assert unit_root_p(-30) == 0.0 and unit_root_p(5) == 1.0


def test_seasonal_differences(spark):
    rng = np.random.default_rng(4)
    steady = np.tile(rng.normal(size=7) * 3, 60) + rng.normal(size=420)
    roaming = np.zeros(420)
    for t in range(7, 420):
        roaming[t] = roaming[t - 7] + rng.normal()
    both = frame(spark, steady, key="steady").unionByName(frame(spark, roaming, key="roaming"))
    got = {r["k"]: r["D"] for r in ocsb(both, ["k"], "date", "y", 7).collect()}
    assert got == {"steady": 0, "roaming": 1}
    assert seasonal_critical_value(7) == pytest.approx(-1.8430, abs=0.01)
