"""Fitting, forecasting and scoring as Spark jobs over keyed series.

Inputs are dense daily series (``densify`` then ``ffill``), so a group is one series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from dayline.functions.columns import (Z95, aic, back_transform, rmse, same_set, standard_error,
                                       transform_column)
from dayline.models.grid import Config, config_array, config_columns, config_struct
from dayline.models.least_squares import Solution, first_day, fit_series, forecast_path, forecast_series
from dayline.operators.joins import attach_lookup
from dayline.operators.windows import hold_last


def _key_fields(df: DataFrame, keys: Sequence[str]) -> str:
    return "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)


def _prepared(df: DataFrame, keys: Sequence[str], date: str, y: str, x: Sequence[str],
              kind: str | None) -> DataFrame:
    """Key, date, output and regressors as doubles; rows before all of them are known go."""
    out = df.select(*keys, F.col(date).alias("date"),
                    transform_column(F.col(y).cast("double"), kind).alias("y"),
                    *[F.col(c).cast("double").alias(f"x{j}") for j, c in enumerate(x)])
    return out.dropna(subset=["y", *[f"x{j}" for j in range(len(x))]])


def _group(df: DataFrame, by: Sequence[str]):
    return df.groupBy(*by) if by else df.groupBy(F.lit(0))


def _blocks(df: DataFrame, keys: Sequence[str], n_blocks: int) -> DataFrame:
    """Every series once per block of configurations, spread by series and block.

    The rows are few and the work on them is not, so the number of tasks is asked for (several
    per slot, to even out): adaptive execution would merge such small partitions into one.
    """
    session = df.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")),
                4 * session.sparkContext.defaultParallelism)
    blocks = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    return df.withColumn("block", blocks).repartition(tasks, *keys, "block")


def _arrays(pdf: pd.DataFrame, n_x: int) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    pdf = pdf.sort_values("date")
    return pdf, pdf["y"].to_numpy(float), pdf[[f"x{j}" for j in range(n_x)]].to_numpy(float)


def _config(row) -> Config:
    return Config(*[row[n] if n == "trend" else int(row[n]) for n in Config._fields])


def _with_configs(df: DataFrame, keys: Sequence[str], cfg: Config | DataFrame) -> DataFrame:
    """One configuration for all series, or a table with the configuration of each."""
    if isinstance(cfg, Config):
        return df.withColumns({n: F.lit(v) for n, v in cfg._asdict().items()})
    if not keys:
        return attach_lookup(df, cfg, [], Config._fields).filter(F.col("p").isNotNull())
    return df.join(cfg.select(*keys, *Config._fields), list(keys), "inner")


def fit(df: DataFrame, keys: Sequence[str], date: str, y: str, x: Sequence[str],
        cfg: Config | DataFrame, kind: str | None = None) -> DataFrame:
    """One row per series: configuration, terms, coefficients, sigma2, n, rss, aic."""
    n_x = len(x)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, yy, xx = _arrays(pdf, n_x)
        first = pdf.iloc[0]
        done = fit_series(_config(first), yy, xx)
        out = {k: [first[k]] for k in [*keys, *Config._fields]}
        if done is None:
            return pd.DataFrame({**out, "terms": [[]], "coef": [[]], "n": [0],
                                 "rss": [None], "sigma2": [None]})
        return pd.DataFrame({**out, "terms": [done.names], "coef": [done.coef.tolist()],
                             "n": [done.n], "rss": [done.rss], "sigma2": [done.sigma2]})

    rows = _with_configs(_prepared(df, keys, date, y, x, kind), keys, cfg)
    schema = (_key_fields(df, keys) + "p int, d int, q int, sp int, sd int, sq int, m int, "
              "trend string, terms array<string>, coef array<double>, n int, rss double, "
              "sigma2 double")
    fitted = _group(rows, keys).applyInPandas(run, schema)
    return fitted.withColumn("aic", aic("n", "rss", F.size("coef") + 1))


def fitted_values(df: DataFrame, keys: Sequence[str], date: str, y: str, x: Sequence[str],
                  cfg: Config | DataFrame, kind: str | None = None) -> DataFrame:
    """``(keys, date, data, fitted, resid)`` on the scale of the model; NULL while lags build up."""
    n_x = len(x)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, yy, xx = _arrays(pdf, n_x)
        done = fit_series(_config(pdf.iloc[0]), yy, xx)
        resid = np.full(len(yy), np.nan)
        if done is not None:
            resid[len(yy) - len(done.resid):] = done.resid
        out = pdf[[*keys, "date"]].copy()
        return out.assign(data=yy, fitted=yy - resid, resid=resid)

    rows = _with_configs(_prepared(df, keys, date, y, x, kind), keys, cfg)
    schema = _key_fields(df, keys) + "date date, data double, fitted double, resid double"
    out = _group(rows, keys).applyInPandas(run, schema)
    return out.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("fitted", "resid")})


def training_error(fitted: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """MSE and RMSE of the residuals, in units of the (transformed) output."""
    mse = F.avg(F.col("resid") * F.col("resid"))
    return fitted.groupBy(*keys).agg(mse.alias("mse"), F.sqrt(mse).alias("rmse"))


def interval(df: DataFrame, kind: str | None = None, compat: bool = False) -> DataFrame:
    """95 % bounds on the model scale, then everything back on the scale of the data.

    Bounds below zero are cut at zero before squaring and the error is carried by the slope
    (``2·√f·se``); ``compat`` squares all four columns instead.
    """
    lower, upper = F.col("forecast") - Z95 * F.col("se"), F.col("forecast") + Z95 * F.col("se")
    out = df.withColumns({"lower_ci": lower, "upper_ci": upper})
    if kind is None:
        return out
    if not compat:
        out = out.withColumns({"se": 2.0 * F.abs("forecast") * F.col("se"),
                               "lower_ci": F.greatest(F.col("lower_ci"), F.lit(0.0)),
                               "upper_ci": F.greatest(F.col("upper_ci"), F.lit(0.0))})
    squared = ["forecast", "lower_ci", "upper_ci"] + (["se"] if compat else [])
    return out.withColumns({c: back_transform(c, kind) for c in squared})


def forecast(df: DataFrame, keys: Sequence[str], date: str, y: str, x: Sequence[str],
             cfg: Config | DataFrame, steps: int = 7, kind: str | None = None,
             scenario: DataFrame | None = None, compat: bool = False) -> DataFrame:
    """``(keys, date, forecast, se, lower_ci, upper_ci)`` for the days after each series.

    Regressors follow ``scenario`` (keys, date and the regressors), or stay at their last value. A
    scenario is met by date: other days are not looked at, and a day that it lacks fails.
    """
    n_x = len(x)
    rows = _prepared(df, keys, date, y, x, kind).withColumn("ahead", F.lit(False))
    if n_x:
        plan = scenario if scenario is not None else hold_last(df, keys, date, x, steps)
        rows = rows.unionByName(plan.select(
            *keys, F.col(date).alias("date"), F.lit(None).cast("double").alias("y"),
            *[F.col(c).cast("double").alias(f"x{j}") for j, c in enumerate(x)],
            F.lit(True).alias("ahead")))
    rows = _with_configs(rows, keys, cfg)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        past, yy, xx = _arrays(pdf[~pdf["ahead"]], n_x)
        if past.empty:
            return pd.DataFrame({**{k: [] for k in keys}, "date": [], "forecast": [], "se": []})
        last = pd.Timestamp(past["date"].iloc[-1])
        days = [(last + pd.Timedelta(days=h + 1)).date() for h in range(steps)]
        coming = np.zeros((steps, 0))
        if n_x:
            plan = pdf[pdf["ahead"]]
            by_day = dict(zip(pd.to_datetime(plan["date"]).dt.date, plan[[f"x{j}" for j in range(n_x)]].to_numpy(float)))
            missing = [str(day) for day in days if day not in by_day or not np.isfinite(by_day[day]).all()]
            if missing:
                raise ValueError(f"the scenario of {[past[k].iloc[0] for k in keys]} has no values for {', '.join(missing)}")
            coming = np.array([by_day[day] for day in days])
        config = _config(past.iloc[0])
        done = fit_series(config, yy, xx)
        if done is None:
            mean = se = np.full(len(coming), np.nan)
        else:
            mean, se = forecast_series(config, done, yy, xx, coming)
        out = pd.DataFrame({"date": days, "forecast": mean, "se": se})
        for k in keys:
            out[k] = past[k].iloc[0]
        return out[[*keys, "date", "forecast", "se"]]

    schema = _key_fields(df, keys) + "date date, forecast double, se double"
    out = _group(rows, keys).applyInPandas(run, schema)
    out = out.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("forecast", "se")})
    return interval(out, kind, compat)


def fold_bounds(n: int, n_splits: int, max_test: int | None) -> list[tuple[int, int]]:
    """Training size and test size of each walk-forward fold of ``n`` rows."""
    block = n // (n_splits + 1)
    size = block if max_test is None else min(block, max_test)
    return [(n - (n_splits - k) * block, size) for k in range(n_splits)] if block else []


def fold_forecasts(df: DataFrame, keys: Sequence[str], date: str, y: str, x: Sequence[str],
                   configs: Sequence[Config], n_splits: int = 10, max_test: int | None = None,
                   kind: str | None = None, block: int = 16) -> DataFrame:
    """Test-day forecasts of every series × configuration × fold, on the scale of the data.

    A series travels once per block of configurations, so one long series still spreads over
    many tasks and what is shuffled is the daily series, not its folds.
    """
    n_x, configs = len(x), list(configs)
    n_blocks = (len(configs) + block - 1) // block
    rows = _blocks(_prepared(df, keys, date, y, x, kind), keys, n_blocks)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, yy, xx = _arrays(pdf, n_x)
        at = int(pdf["block"].iloc[0]) * block
        labels, actual, predicted = [], [], []
        for fold, (train, test) in enumerate(fold_bounds(len(yy), n_splits, max_test)):
            noise: dict = {}
            past, past_x, coming = yy[:train], xx[:train], xx[train:train + test]
            for cfg_id in range(at, min(at + block, len(configs))):
                done: Solution | None = fit_series(configs[cfg_id], past, past_x, noise)
                if done is None:
                    continue
                mean = forecast_path(configs[cfg_id], done, past, past_x, coming)
                labels += [(cfg_id, fold, step) for step in range(1, test + 1)]
                actual.append(yy[train:train + test])
                predicted.append(mean)
        out = pd.DataFrame(labels, columns=["cfg_id", "fold", "step"])
        out["actual"] = np.concatenate(actual or [np.zeros(0)])
        out["predicted"] = np.concatenate(predicted or [np.zeros(0)])
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out

    schema = (_key_fields(df, keys)
              + "cfg_id int, fold int, step int, actual double, predicted double")
    out = _group(rows, [*keys, "block"]).applyInPandas(run, schema)
    return out.withColumns({c: back_transform(c, kind) for c in ("actual", "predicted")})


Metric = Callable[[Column | str, Column | str], Column]


def cross_validate(df: DataFrame, keys: Sequence[str], date: str, y: str, x: Sequence[str],
                   configs: Sequence[Config], n_splits: int = 10, max_test: int | None = None,
                   kind: str | None = None, metric: Metric = rmse, block: int = 16) -> DataFrame:
    """``(keys, cfg_id, score_mean, score_se, folds)``.

    A configuration that cannot be fitted on some fold gets no score, hence no row.
    """
    days = fold_forecasts(df, keys, date, y, x, configs, n_splits, max_test, kind, block)
    per_fold = days.groupBy(*keys, "cfg_id", "fold").agg(metric("actual", "predicted").alias("s"))
    return (per_fold.groupBy(*keys, "cfg_id")
            .agg(F.avg("s").alias("score_mean"), standard_error("s").alias("score_se"),
                 F.count(F.lit(1)).cast("int").alias("folds"))
            .filter(F.col("folds") == n_splits))


def aic_scores(df: DataFrame, keys: Sequence[str], date: str, y: str, x: Sequence[str],
               configs: Sequence[Config], kind: str | None = None, block: int = 16,
               common: bool = True) -> DataFrame:
    """``(keys, cfg_id, score_mean, score_se)`` from whole-series fits, without folds.

    All configurations of a series are fitted to the same days, those that the one with the longest
    lags can use, so that their values compare; without ``common`` each uses all days it can.
    """
    n_x, configs = len(x), list(configs)
    n_blocks = (len(configs) + block - 1) // block
    rows = _blocks(_prepared(df, keys, date, y, x, kind), keys, n_blocks)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, yy, xx = _arrays(pdf, n_x)
        at, noise = int(pdf["block"].iloc[0]) * block, {}
        first = max((first_day(c, len(yy)) for c in configs if c.valid), default=0) if common else 0
        fits = {i: fit_series(configs[i], yy, xx, noise, first)
                for i in range(at, min(at + block, len(configs)))}
        out = pd.DataFrame([(i, f.n, f.rss, len(f.coef) + 1) for i, f in fits.items() if f],
                           columns=["cfg_id", "n", "rss", "params"])
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out

    schema = _key_fields(df, keys) + "cfg_id int, n int, rss double, params int"
    fits = _group(rows, [*keys, "block"]).applyInPandas(run, schema)
    return fits.select(*keys, "cfg_id", aic("n", "rss", "params").alias("score_mean"),
                       F.lit(None).cast("double").alias("score_se"))


def grid_search(df: DataFrame, keys: Sequence[str], date: str, y: str, x: Sequence[str],
                configs: Sequence[Config], metric: str | Metric = "rmse", n_splits: int = 10,
                max_test: int | None = None, kind: str | None = None,
                block: int = 16, common: bool = True) -> DataFrame:
    """Scored configurations of each series, best (smallest) first: ``rank`` 1.

    ``common`` is for ``aic``: see :func:`aic_scores`.
    """
    if metric == "aic":
        scores = aic_scores(df, keys, date, y, x, configs, kind, block, common)
    elif metric == "rmse" or callable(metric):
        scores = cross_validate(df, keys, date, y, x, configs, n_splits, max_test, kind,
                                rmse if metric == "rmse" else metric, block).drop("folds")
    else:
        raise ValueError(f"unknown metric {metric!r}")
    named = F.get(config_array(configs), F.col("cfg_id"))
    best_first = W.partitionBy(*(list(keys) or [F.lit(0)])).orderBy("score_mean", "cfg_id")
    return (scores.filter(F.col("score_mean").isNotNull())
            .withColumn("_cfg", named).withColumns({n: F.col("_cfg")[n] for n in Config._fields})
            .drop("_cfg")
            .withColumn("rank", F.row_number().over(best_first)))


def nest_leaderboard(scores: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per series with its results as an array, best first."""
    entry = F.struct("rank", config_struct().alias("cfg"), "score_mean", "score_se")
    nested = scores.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("_r"))
    return nested.select(*keys, F.transform("_r", lambda r: F.struct(
        r["cfg"].alias("cfg"), r["score_mean"].alias("score_mean"),
        r["score_se"].alias("score_se"))).alias("results"))


def best_config(runs: DataFrame, output: str, regressors: Sequence[str],
                keys: Sequence[str] = ()) -> DataFrame:
    """Best configuration of the newest run for an output and a *set* of regressors."""
    wanted = F.array(*[F.lit(r) for r in regressors]).cast("array<string>")
    match = runs.filter((F.col("configuration.outputs")[0] == output)
                        & same_set("configuration.regressors", wanted))
    newest = match.groupBy(*keys).agg(
        F.max_by(F.struct("configuration", "results"), F.col("log.timestamp")).alias("_run"))
    best = newest.filter(F.size("_run.results") > 0)
    return best.select(*keys, F.col("_run.results")[0]["cfg"].alias("_cfg")).select(
        *keys, *config_columns(F.col("_cfg")))


def compare(leaderboards: dict[str, DataFrame], keys: Sequence[str] = ()) -> DataFrame:
    """The best score of each named model side by side."""
    parts = [board.filter("rank = 1").select(F.lit(name).alias("model"), *keys, "cfg_id",
                                             "score_mean", "score_se")
             for name, board in leaderboards.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
