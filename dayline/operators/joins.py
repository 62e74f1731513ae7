"""Joins on keys, links, intervals and one-row tables.

No side is forced to broadcast: Spark does so itself for sides it measures below
``spark.sql.autoBroadcastJoinThreshold``, and splits skewed partitions of the rest.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from dayline.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table written once under ``spark.checkpoint.dir``, so of known size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def left_join_all(base: DataFrame, others: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """``base`` with the columns of every other table, left to right."""
    return reduce(lambda a, b: a.join(b, list(on), "left"), others, base)


def inner_on(df: DataFrame, other: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return df.join(other, [on] if isinstance(on, str) else list(on), "inner")


def via_links(df: DataFrame, links: DataFrame, on: Sequence[str] | str,
              how: str = "inner") -> DataFrame:
    """Rows reached by a link table; ``left_semi`` keeps each at most once."""
    if how not in ("inner", "left_semi"):
        raise ValueError("how must be 'inner' or 'left_semi'")
    return df.join(links, [on] if isinstance(on, str) else list(on), how)


def attach_lookup(df: DataFrame, dim: DataFrame, keys: Sequence[str], cols: Sequence[str],
                  measured: bool = False) -> DataFrame:
    """Columns of the dimension row with the same keys; without keys, of its only row.

    The size of an aggregate is unknown when a plan is made, so ``df`` would be shuffled by key,
    hot keys and all. With ``measured`` the dimension is written first, and Spark broadcasts it if
    its files are below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    if keys:
        side = dim.select(*keys, *cols)
        return df.join(written(side, "lookup") if measured else side, list(keys), "left")
    row = dim.select(F.struct(*cols).alias("_row")).scalar()
    return (df.withColumn("_row", row)
            .withColumns({c: F.col("_row")[c] for c in cols}).drop("_row"))


def newest_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key, the one with the largest ``order``; partial aggregation, no window."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_row"))
    return newest.select(*keys, "_row.*").select(*df.columns)


def cover_flag(days: DataFrame, intervals: DataFrame, start: str = "start", end: str = "end",
               name: str = "holiday", keys: Sequence[str] = (), date: str = "date") -> DataFrame:
    """TRUE on days inside any half-open ``[start, end)`` interval, FALSE elsewhere.

    Intervals become +1/-1 steps, summed per date before anything is shuffled wide, so the cost
    does not depend on how long they are; empty and reversed intervals cover nothing. Every
    interval counts that reaches a day, whenever it started.
    """
    keys = list(keys)
    steps = (intervals.filter(F.col(end) > F.col(start))
             .select(*keys, F.explode(F.array(
                 F.struct(F.col(start).cast("date").alias("_on"), F.lit(1).alias("_step")),
                 F.struct(F.col(end).cast("date").alias("_on"), F.lit(-1).alias("_step")))).alias("_s"))
             .select(*keys, F.col("_s._on").alias("_on"), F.col("_s._step").alias("_step")))
    wanted = days.select(*keys, F.col(date).cast("date").alias("_on"),
                         F.lit(None).cast("int").alias("_step"))
    per_day = (steps.unionByName(wanted).groupBy(*keys, "_on")
               .agg(F.sum("_step").alias("_step"), F.count_if(F.col("_step").isNull()).alias("_asked")))
    depth = F.sum("_step").over(W.partitionBy(*(keys or [F.lit(0)])).orderBy("_on")
                                .rowsBetween(W.unboundedPreceding, 0))
    covered = (per_day.select(*keys, "_on", "_asked",
                              (F.coalesce(depth, F.lit(0)) > 0).alias(name))
               .filter("_asked > 0").select(*keys, F.col("_on").alias(date), name))
    return (days.join(covered, [*keys, date], "left")
            .withColumn(name, F.coalesce(F.col(name), F.lit(False))))


def fit_and_forecast_frame(fit: DataFrame, forecast: DataFrame, keys: Sequence[str] = (),
                           date: str = "date") -> DataFrame:
    """Fitted and forecast values of each series on one date axis."""
    return fit.join(forecast, [*keys, date], "full")


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()
