"""Autocorrelation, decomposition, stationarity and residual tests of daily series."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline.functions.columns import normal_quantile
from dayline.models.least_squares import difference, shifted, solve_normal
from dayline.operators.aggregates import histogram
from dayline.operators.windows import moving_trend, series_window, whole_series


def _lagged_products(df: DataFrame, keys: Sequence[str], date: str, col: str, max_lag: int,
                     **more: Column) -> DataFrame:
    """``(keys, n, c)`` with the sums of lagged products around the mean, lags 0 to ``max_lag``.

    ``more`` adds aggregates over the value ``_raw``, its distance to the mean ``_x``, its
    position ``_pos`` (from 1) and the series' length ``_n``.
    """
    w, every = series_window(keys, date), whole_series(keys)
    raw = F.col(col).cast("double")
    centred = df.filter(raw.isNotNull()).select(
        *keys, date, raw.alias("_raw"), (raw - F.avg(raw).over(every)).alias("_x"))
    lagged = centred.withColumns({
        "_pos": F.row_number().over(w), "_n": F.count(F.lit(1)).over(every),
        **{f"_l{k}": F.lag("_x", k).over(w) for k in range(1, max_lag + 1)}})
    products = [F.sum(F.col("_x") * F.col("_x"))]
    products += [F.coalesce(F.sum(F.col("_x") * F.col(f"_l{k}")), F.lit(0.0))
                 for k in range(1, max_lag + 1)]
    return lagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array(*products).alias("c"),
                                     *[value.alias(name) for name, value in more.items()])


def acf(df: DataFrame, keys: Sequence[str], date: str, col: str, max_lag: int) -> DataFrame:
    """``(keys, n, lag, r)`` around the series' overall mean."""
    sums = _lagged_products(df, keys, date, col, max_lag)
    return (sums.select(*keys, "n", F.col("c")[0].alias("_c0"), F.posexplode("c").alias("lag", "_c"))
            .select(*keys, "n", "lag", F.try_divide("_c", "_c0").alias("r")))


def pacf(df: DataFrame, keys: Sequence[str], date: str, col: str, max_lag: int) -> DataFrame:
    """``(keys, lag, r)``: partial autocorrelations from the autocorrelations (Durbin-Levinson)."""
    sums = _lagged_products(df, keys, date, col, max_lag)
    arrays = sums.filter(F.col("c")[0] > 0).select(
        *keys, F.transform("c", lambda v: v / F.col("c")[0]).alias("rho"))

    def recurse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            partial = []
            for rho in batch["rho"]:
                phi, out = np.zeros(0), [1.0]
                for k in range(1, len(rho)):
                    back = np.asarray(rho)[k - 1:0:-1]
                    num = rho[k] - (phi @ back if k > 1 else 0.0)
                    den = 1.0 - (phi @ np.asarray(rho)[1:k] if k > 1 else 0.0)
                    last = num / den if den else np.nan
                    phi = np.append(phi - last * phi[::-1], last)
                    out.append(last)
                partial.append(out)
            yield batch[list(keys)].assign(rho=partial)

    fields = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keys)
    rows = arrays.mapInPandas(recurse, fields + "rho array<double>")
    return rows.select(*keys, F.posexplode("rho").alias("lag", "r"))


def decompose(df: DataFrame, keys: Sequence[str], date: str, col: str, m: int = 7) -> DataFrame:
    """Additive trend, seasonal and residual columns for a dense series of period ``m``."""
    first = F.min(date).over(whole_series(keys))
    out = moving_trend(df, keys, date, col, m).withColumn(
        "_phase", F.pmod(F.datediff(F.col(date), first), F.lit(m)))
    detrended = F.col(col).cast("double") - F.col("trend")
    phases = F.array(*[F.avg(F.when(F.col("_phase") == i, detrended)).over(whole_series(keys))
                       for i in range(m)])
    out = out.withColumn("_effects", phases)
    level = F.aggregate("_effects", F.lit(0.0), lambda a, v: a + v) / m
    out = out.withColumn("seasonal", F.get("_effects", F.col("_phase")) - level)
    return out.withColumn("resid", F.col(col) - F.col("trend") - F.col("seasonal")) \
        .drop("_phase", "_effects")


# MacKinnon's (2010) response surface for the test with constant, at 1, 5 and 10 %,
# and his (1994) approximation of its p-value below and above the turning point.
_SURFACE = {"1%": (-3.43035, -6.5393, -16.786, -79.433),
            "5%": (-2.86154, -2.8903, -4.234, -40.040),
            "10%": (-2.56677, -1.5384, -2.809, 0.0)}
_P_TURN, _P_MIN, _P_MAX = -1.61, -18.83, 2.74
_P_LOW = (2.1659, 1.4412, 0.038269)
_P_HIGH = (1.7339, 0.93202, -0.12745, -0.010368)


def unit_root_p(stat: float) -> float:
    if stat > _P_MAX:
        return 1.0
    if stat < _P_MIN:
        return 0.0
    terms = _P_LOW if stat <= _P_TURN else _P_HIGH
    z = sum(c * stat ** i for i, c in enumerate(terms))
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def _last_t(target: np.ndarray, design: np.ndarray, at: int) -> tuple[float, float]:
    """t-statistic of column ``at`` and AIC of a regression without missing rows."""
    gram = design.T @ design
    coef = solve_normal(gram, design.T @ target)
    n, k = design.shape
    rss = float(np.sum((target - design @ coef) ** 2))
    se = math.sqrt(max(rss, 1e-300) / max(n - k, 1) * np.linalg.pinv(gram)[at, at])
    score = n * (math.log(2 * math.pi * max(rss, 1e-300) / n) + 1) + 2 * k
    return float(coef[at] / se) if se else math.nan, score


def _unit_root(y: np.ndarray, max_lag: int | None) -> dict:
    dy, n = np.diff(y), len(y)
    if max_lag is None:
        max_lag = math.ceil(12.0 * (n / 100.0) ** 0.25)
    max_lag = max(0, min(max_lag, n // 2 - 2))
    steps = np.column_stack([y[:-1], np.ones(n - 1), shifted(dy, list(range(1, max_lag + 1)))])
    common = slice(max_lag, None)
    by_aic = [_last_t(dy[common], steps[common, :2 + k], 0)[1] for k in range(max_lag + 1)]
    best = int(np.argmin(by_aic))
    stat = _last_t(dy[best:], steps[best:, :2 + best], 0)[0]
    nobs = n - 1 - best
    out = {"stat": stat, "p_value": unit_root_p(stat), "lags": best, "nobs": nobs}
    for level, b in _SURFACE.items():
        out[f"crit_{level[:-1]}"] = sum(c / nobs ** i for i, c in enumerate(b))
    return out


def adf(df: DataFrame, keys: Sequence[str], date: str, col: str, max_lag: int | None = None,
        orders: Sequence[int] = (0,), alpha: float = 1e-3) -> DataFrame:
    """Augmented Dickey-Fuller test with constant of each series, differenced ``d`` times.

    The number of lags is the one with the smallest AIC; stationary means a p-value below
    ``alpha`` and a statistic below the 5 % critical value.
    """
    rows = (df.filter(F.col(col).isNotNull())
            .select(*keys, F.col(date).alias("date"), F.col(col).cast("double").alias("y"))
            .withColumn("d", F.explode(F.array(*[F.lit(int(d)) for d in orders]))))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        d = int(pdf["d"].iloc[0])
        y = difference(pdf.sort_values("date")["y"].to_numpy(float), d, 0, 1)
        out = {k: pdf[k].iloc[0] for k in keys} | {"d": d}
        if len(y) >= 8 and np.ptp(y) > 0:
            out |= _unit_root(y, max_lag)
        return pd.DataFrame([out]).reindex(columns=names)

    names = [*keys, "d", "stat", "p_value", "lags", "nobs", "crit_1", "crit_5", "crit_10"]
    fields = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keys)
    tested = rows.groupBy(*keys, "d").applyInPandas(
        run, fields + "d int, stat double, p_value double, lags double, nobs double, "
                      "crit_1 double, crit_5 double, crit_10 double")
    tested = tested.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in names[len(keys) + 1:]})
    tested = tested.withColumns({c: F.col(c).cast("int") for c in ("lags", "nobs")})
    return tested.withColumn("stationary", F.coalesce(
        (F.col("p_value") < alpha) & (F.col("stat") < F.col("crit_5")), F.lit(False)))


def choose_d(df: DataFrame, keys: Sequence[str], date: str, col: str, max_d: int = 2,
             max_lag: int | None = None) -> DataFrame:
    """Smallest number of differences after which the series is stationary, NULL if none is."""
    tested = adf(df, keys, date, col, max_lag, range(max_d + 1))
    return tested.groupBy(*keys).agg(F.min(F.when(F.col("stationary"), F.col("d"))).alias("d"))


def seasonal_critical_value(m: int) -> float:
    """Critical value of the seasonal differencing test, by the published response curve."""
    # Coefficients of the curve over log(m).
    u = math.log(m) - 0.7656451
    return -0.2937411 * math.exp(-0.2850853 * u - 0.05983644 * u * u) - 1.652202


def _seasonal_test(y: np.ndarray, m: int, lag: int) -> tuple[float, float]:
    once, season = np.diff(y), y[m:] - y[:-m]
    both = np.diff(season)
    own = shifted(both, list(range(1, lag + 1)))
    weights = np.zeros(0)
    if lag:
        weights = solve_normal(own[lag:].T @ own[lag:], own[lag:].T @ both[lag:])

    def filtered(v: np.ndarray) -> np.ndarray:
        return v - (shifted(v, list(range(1, lag + 1))) @ weights if lag else 0.0)

    n = len(both)
    z_ordinary = filtered(season)[-n - 1:-1]     # season[t-1]
    z_seasonal = filtered(once)[:n]              # once[t-m]
    design = np.column_stack([own, z_ordinary, z_seasonal])
    usable = np.isfinite(design).all(axis=1)
    return _last_t(both[usable], design[usable], design.shape[1] - 1)


def ocsb(df: DataFrame, keys: Sequence[str], date: str, col: str, m: int = 7,
         max_lag: int = 3) -> DataFrame:
    """Seasonal unit-root test (Osborn, Chui, Smith, Birchenhall) of each series.

    ``(keys, stat, crit, D)``; one seasonal difference is needed when the statistic lies above
    the critical value. A series too short or constant has no statistic and no D. Lags are chosen
    by AIC.
    """
    rows = df.filter(F.col(col).isNotNull()).select(
        *keys, F.col(date).alias("date"), F.col(col).cast("double").alias("y"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values("date")["y"].to_numpy(float)
        out = {k: pdf[k].iloc[0] for k in keys} | {"stat": np.nan}
        if len(y) > 3 * m + 2 * max_lag and np.ptp(y) > 0:
            tried = [_seasonal_test(y, m, k) for k in range(max_lag + 1)]
            out["stat"] = min(tried, key=lambda r: r[1])[0]
        return pd.DataFrame([out])

    fields = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keys)
    grouped = rows.groupBy(*keys) if keys else rows.groupBy(F.lit(0))
    tested = grouped.applyInPandas(run, fields + "stat double")
    crit = seasonal_critical_value(m)
    return (tested.withColumn("stat", F.when(~F.isnan("stat"), F.col("stat")))
            .withColumn("crit", F.lit(crit))
            .withColumn("D", F.when(F.col("stat").isNotNull(), (F.col("stat") > crit).cast("int"))))


def residual_tests(df: DataFrame, keys: Sequence[str], date: str, resid: str,
                   max_lag: int = 1) -> DataFrame:
    """Ljung-Box Q up to ``max_lag``, heteroskedasticity H, skewness, kurtosis and Jarque-Bera.

    H compares the squares of the last third with those of the first. One shuffle in all.
    """
    third, square = F.round(F.col("_n") / 3), F.col("_raw") * F.col("_raw")
    sums = _lagged_products(
        df, keys, date, resid, max_lag,
        late=F.sum(F.when(F.col("_pos") > F.col("_n") - third, square)),
        early=F.sum(F.when(F.col("_pos") <= third, square)),
        skew=F.skewness("_x"), kurtosis=F.kurtosis("_x") + 3.0)
    n, c = F.col("n"), F.col("c")
    q = F.lit(0.0)
    for k in range(1, max_lag + 1):
        q = q + F.try_divide(F.pow(F.try_divide(c[k], c[0]), F.lit(2.0)), n - k)
    jb = n / 6.0 * (F.pow("skew", F.lit(2.0)) + F.pow(F.col("kurtosis") - 3.0, F.lit(2.0)) / 4.0)
    return sums.select(*keys, "n", F.try_divide("late", "early").alias("heteroskedasticity"),
                       "skew", "kurtosis", jb.alias("jarque_bera"),
                       F.exp(-jb / 2.0).alias("jarque_bera_p"),
                       (n * (n + 2) * q).alias("ljung_box"))


def standardised(df: DataFrame, keys: Sequence[str], resid: str, name: str = "z") -> DataFrame:
    """Residuals in units of their standard deviation, around their mean."""
    every = whole_series(keys)
    return df.filter(F.col(resid).isNotNull()).withColumn(
        name, (F.col(resid) - F.avg(resid).over(every)) / F.stddev_pop(resid).over(every))


def quantile_pairs(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """``(keys, position, sample, theoretical)``: ordered values against normal quantiles."""
    w = series_window(keys, col)
    placed = df.filter(F.col(col).isNotNull()).select(
        *keys, F.row_number().over(w).alias("position"), F.col(col).alias("sample"),
        F.count(F.lit(1)).over(whole_series(keys)).alias("_n"))
    return placed.withColumn("theoretical", normal_quantile(F.col("position") / (F.col("_n") + 1))) \
        .drop("_n")


def residual_tables(df: DataFrame, keys: Sequence[str], date: str, resid: str, bins: int = 10,
                    max_lag: int = 10) -> dict[str, DataFrame]:
    """The four tables behind a residual plot."""
    z = standardised(df, keys, resid)
    return {"standardised": z.select(*keys, date, "z"), "histogram": histogram(z, "z", bins, keys),
            "quantiles": quantile_pairs(z, keys, "z"), "correlogram": acf(z, keys, date, "z", max_lag)}
