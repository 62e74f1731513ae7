"""Tuning runs and forecast runs over the curated table."""

from __future__ import annotations

import logging
import time
from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayline.models.grid import configurations
from dayline.models.series import best_config, forecast, grid_search, nest_leaderboard
from dayline.operators.aggregates import fold_stats, null_profile, series_profile
from dayline.operators.filters import crop_from, scan_between
from dayline.operators.joins import attach_lookup
from dayline.operators.projections import select_roles
from dayline.operators.windows import densify, ffill, folds_of
from dayline.plans.loading import stored
from dayline.schemas import schema_of
from dayline.session import scratch_path
from dayline.sinks.loads import append_load
from dayline.sinks.tables import append_checked, replace_by_key, replace_partitions

# The shipped search space.
DEFAULT_CONF = {
    "outputs": ["new_cases"], "regressors": [], "date_from": "2020",
    "p_values": [0, 1, 2, 3, 4, 5], "d_values": [1], "q_values": [0, 1, 2, 3, 4, 5],
    "P_values": [0, 1, 2], "D_values": [0], "Q_values": [0, 1, 2],
    "m_values": [7], "t_values": ["n"], "performance_measure": "rmse",
    "cv_n_splits": 30, "cv_max_test_size": 7, "parallel": True, "debug": False,
}


def model_series(curated: DataFrame, keys: Sequence[str], date: str, y: str, x: Sequence[str]
                 ) -> DataFrame:
    """Dense, forward-filled series with only the columns a model reads."""
    return ffill(densify(select_roles(curated, keys, date, y, x), keys, date), keys, date)


def tune(curated: DataFrame, conf: Mapping = DEFAULT_CONF, keys: Sequence[str] = ("region",),
         date: str = "date", kind: str | None = "sqrt", block: int = 16) -> DataFrame:
    """One run document per series: log, configuration and results, best first."""
    conf = {**DEFAULT_CONF, **conf}
    y, x = conf["outputs"][0], list(conf["regressors"])
    series = model_series(crop_from(curated, date, conf["date_from"]), keys, date, y, x)
    configs = configurations(conf["p_values"], conf["d_values"], conf["q_values"],
                             conf["P_values"], conf["D_values"], conf["Q_values"],
                             conf["m_values"], conf["t_values"])
    scores = grid_search(series, keys, date, y, x, configs, conf["performance_measure"].lower(),
                         conf["cv_n_splits"], conf["cv_max_test_size"], kind, block)
    profile = series_profile(series, keys, date)
    about = [*keys, "first_date", "last_date"]
    folds = fold_stats(folds_of(profile, about, "n_rows", conf["cv_n_splits"],
                                conf["cv_max_test_size"]), about)
    run = attach_lookup(nest_leaderboard(scores, keys), folds, keys,
                        ["first_date", "last_date", "train_min", "train_max", "test_size"])

    stored = schema_of("hyperparameters")
    log = F.struct(
        F.current_timestamp().alias("timestamp"),
        F.array(F.col("first_date").cast("timestamp"), F.col("last_date").cast("timestamp"))
        .alias("date_range"),
        F.col("train_min").cast("int").alias("splits_train_size_min"),
        F.col("train_max").cast("int").alias("splits_train_size_max"),
        F.col("test_size").cast("int").alias("splits_test_size"),
        F.lit(None).cast("string").alias("elapsed_time"))
    # names that differ in case only cannot stand side by side in a table
    conf |= {f"s{n}_values": conf[f"{n.upper()}_values"] for n in "pdq"}
    configuration = F.struct(*[
        (F.array(*[F.lit(v) for v in conf[f.name]]) if isinstance(conf[f.name], (list, tuple))
         else F.lit(conf[f.name])).cast(f.dataType).alias(f.name)
        for f in stored["configuration"].dataType.fields])
    return run.select(*keys, log.alias("log"), configuration.alias("configuration"), "results")


def run_tuning(curated: DataFrame, path: str, conf: Mapping = DEFAULT_CONF, keys: Sequence[str] = ("region",),
               date: str = "date", kind: str | None = "sqrt", block: int = 16, name: str | None = None) -> int:
    """Tune, and add the run documents to the stored ones with the time that it took; returns how many.

    Columns with missing values are reported as warnings before they are filled. The documents are
    written aside first, which is where the work is done and timed; :func:`read_loads` of
    :mod:`dayline.sinks.loads` reads the table, and a run of a ``name`` that is there is not repeated.
    """
    spark, began = curated.sparkSession, time.perf_counter()
    asked = {**DEFAULT_CONF, **conf}
    warn_nulls(curated, [asked["outputs"][0], *asked["regressors"]])
    aside = scratch_path(spark, "runs")
    made = tune(curated, conf, keys, date, kind, block)
    made.write.parquet(aside)
    took = str(timedelta(seconds=time.perf_counter() - began))
    done = spark.read.schema(made.schema).parquet(aside)
    return append_load(done.withColumn("log", F.col("log").withField("elapsed_time", F.lit(took))), path, name)


def warn_nulls(df: DataFrame, cols: Sequence[str]) -> None:
    """A warning for each column that has missing values, with their number."""
    for row in null_profile(df, cols).filter("nulls > 0").collect():
        logging.getLogger(__name__).warning("%s has %d missing values, which are filled forward", row["column"], row["nulls"])


def forecast_run(curated: DataFrame, runs: DataFrame, models: Sequence[Mapping], steps: int = 7,
                 keys: Sequence[str] = ("region",), date: str = "date",
                 kind: str | None = "sqrt", compat: bool = False, report_nulls: bool = False) -> DataFrame:
    """Forecasts of every model and series with its best stored configuration.

    ``report_nulls`` warns of missing values, at the price of one more pass over the columns.

    ``models`` is a list of ``{"output": ..., "regressors": [...]}``. The result replaces the
    stored rows of the same output variable (``sinks.tables.replace_by_key``).
    """
    parts = []
    for model in models:
        y, x = model["output"], list(model.get("regressors", []))
        if report_nulls:
            warn_nulls(curated, [y, *x])
        series = model_series(curated, keys, date, y, x)
        cfg = best_config(runs, y, x, keys)
        made = forecast(series, keys, date, y, x, cfg, steps, kind, compat=compat)
        parts.append(made.select(*keys, F.lit(y).alias("output_variable"), "date", "forecast",
                                 "se", "lower_ci", "upper_ci"))
    return reduce(DataFrame.unionByName, parts)


def store_forecasts(made: DataFrame, path: str, keys: Sequence[str] = ("region",)) -> int:
    """Replace the stored forecasts of the output variables and series in ``made``; others stay.

    Returns how many rows ``made`` has. The new partitions are written aside before they take the
    place of the old ones, as these are read for them.
    """
    spark, by = made.sparkSession, ["output_variable", *keys]
    aside = scratch_path(spark, "forecasts")
    n = append_checked(made, aside)
    new = spark.read.schema(made.schema).parquet(aside)
    old = stored(spark, path, new, ["output_variable"]).select(new.columns).join(
        new.select("output_variable").distinct(), "output_variable", "left_semi")
    merged = scratch_path(spark, "forecasts")
    replace_by_key(new, old.select(new.columns), by).write.parquet(merged)
    replace_partitions(spark.read.schema(new.schema).parquet(merged), path, ["output_variable"])
    return n


def read_forecasts(spark: SparkSession, path: str, variable: str, lo=None, hi=None) -> DataFrame:
    """Stored forecasts of one output variable for days in ``[lo, hi]``, open where not given."""
    made = spark.read.parquet(path).filter(F.col("output_variable") == variable)
    return scan_between(made, "date", lo, hi)
