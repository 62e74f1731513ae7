"""Grouped reductions. All combine on the map side, so a hot key costs one row per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from dayline.functions.columns import standard_error
from dayline.operators.joins import attach_lookup


def daily(df: DataFrame, keys: Sequence[str], stamp: str, measures: Mapping[str, Column],
          date: str = "date") -> DataFrame:
    """Raw rows to one row per key and day."""
    return (df.groupBy(*keys, F.to_date(stamp).alias(date))
            .agg(*[m.alias(name) for name, m in measures.items()]))


def total(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in cols])


def high_water_mark(df: DataFrame, date: str, keys: Sequence[str] = (),
                    name: str = "latest") -> DataFrame:
    return df.groupBy(*keys).agg(F.max(date).alias(name))


def pivot_sum(df: DataFrame, keys: Sequence[str], by: str, values: Sequence,
              cols: Mapping[str, str], totals: bool = True,
              name: str = "{col}_{value}") -> DataFrame:
    """Sums of ``cols`` per pivot value, zero where a value has no rows, with row totals.

    The pivot values are given, so the columns are the same for every input and one shuffle is
    enough. Rows with any other value count nowhere, the totals included.
    """
    known = F.col(by).isin(list(values))
    aggs = []
    for col, label in cols.items():
        for v in values:
            aggs.append(F.coalesce(F.sum(F.when(F.col(by) == F.lit(v), F.col(col))), F.lit(0))
                        .alias(name.format(col=label, value=v)))
        if totals:
            aggs.append(F.coalesce(F.sum(F.when(known, F.col(col))), F.lit(0)).alias(label))
    return df.groupBy(*keys).agg(*aggs)


def unbanded_count(df: DataFrame, by: str, values: Sequence,
                   keys: Sequence[str] = ()) -> DataFrame:
    """How many rows a pivot over ``values`` leaves out."""
    kept = F.coalesce(F.col(by).isin(list(values)), F.lit(False))
    return df.groupBy(*keys).agg(F.count_if(~kept).alias("rejected"))


def order_parts(df: DataFrame, order_by: Mapping[str, str], name: str = "_o") -> dict[str, Column]:
    """Numbers by which rows come first when they are least, named ``name`` and their turn.

    ``order_by`` maps numeric or date columns to ``asc`` or ``desc``.
    """
    def rank_value(c: str, direction: str) -> Column:
        v = F.col(c)
        if dict(df.dtypes)[c] == "date":
            v = F.unix_date(v)
        elif dict(df.dtypes)[c].startswith("timestamp"):
            v = F.unix_micros(v.cast("timestamp"))
        return -v if direction == "desc" else v

    return {f"{name}{i}": rank_value(c, d) for i, (c, d) in enumerate(order_by.items())}


def best_per_key(df: DataFrame, keys: Sequence[str], order_by: Mapping[str, str]) -> DataFrame:
    """Rows that come first in their group, all of them on a tie.

    ``order_by`` maps numeric or date columns to ``asc`` or ``desc``. The best tuple of each
    group is a partial aggregate; joining on the whole tuple spreads a hot group over tasks,
    which a rank window cannot.
    """
    ranked = df.filter(F.lit(True))
    for c in order_by:
        ranked = ranked.filter(F.col(c).isNotNull())
    parts = order_parts(df, order_by)
    ranked = ranked.withColumns(parts)
    best = (ranked.groupBy(*keys).agg(F.min(F.struct(*parts)).alias("_best"))
            .select(*keys, "_best.*"))
    return ranked.join(best, [*keys, *parts], "left_semi").drop(*parts)


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per column with its number of NULLs."""
    cols = list(cols or df.columns)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counted.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in cols])).alias("_p")
    ).select("_p.*")


def daily_mean(df: DataFrame, date: str, cols: Sequence[str],
               keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys, date).agg(*[F.avg(c).alias(c) for c in cols])


def availability(stations: DataFrame, readings: DataFrame, key: str,
                 cols: Mapping[str, str], date: str = "date", lo=None, hi=None) -> DataFrame:
    """Per station: which measures have no gap in the window, and how many do.

    ``cols`` maps a measure to its flag column. A station without readings has none available.
    """
    from dayline.operators.filters import scan_between

    window = scan_between(readings, date, lo, hi)
    seen = window.groupBy(key).agg(*[F.bool_and(F.col(c).isNotNull()).alias(flag)
                                     for c, flag in cols.items()])
    joined = stations.join(seen, [key], "left").fillna(False, subset=list(cols.values()))
    n = F.lit(0)
    for flag in cols.values():
        n = n + F.col(flag).cast("int")
    return joined.withColumn("n_sensors", n)


def mean_se(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(col).alias(f"{col}_mean"),
                                 standard_error(col).alias(f"{col}_se"))


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


def series_profile(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """First and last date, rows and columns of each series."""
    width = len([c for c in df.columns if c not in keys and c != date])
    return df.groupBy(*keys).agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"),
                                 F.count(F.lit(1)).alias("n_rows")) \
        .withColumn("n_columns", F.lit(width))


def fold_stats(folds: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Smallest and largest training set and the test size, from ``fold_table`` rows."""
    return folds.groupBy(*keys).agg(F.min("train_size").alias("train_min"),
                                    F.max("train_size").alias("train_max"),
                                    F.max("test_size").alias("test_size"))


def histogram(df: DataFrame, col: str, bins: int = 10, keys: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between the smallest and largest value; the last bin is closed."""
    keys = list(keys)
    # dividing an all-equal column uses a width of one around the value
    ends = df.groupBy(*keys).agg(F.min(col).cast("double").alias("_lo"),
                                 F.max(col).cast("double").alias("_hi"))
    flat = F.col("_lo") == F.col("_hi")
    ends = ends.select(*keys, F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
                       F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    placed = (attach_lookup(df.select(*keys, col).filter(F.col(col).isNotNull()), ends, keys,
                            ["_lo", "_hi"], measured=True)
              .withColumn("bin", F.least(F.floor((F.col(col) - F.col("_lo")) / width),
                                         F.lit(bins - 1)).cast("int")))
    return (placed.groupBy(*keys, "bin")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.min(F.col("_lo") + F.col("bin") * width).alias("bin_from"),
                 F.min(F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_to")))


def top_k(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of each group, ties broken arbitrarily.

    Spark limits each group to ``k`` rows inside every map task before it shuffles
    (``WindowGroupLimit``, up to ``spark.sql.optimizer.windowGroupLimitThreshold``), so a hot
    group reaches its task as at most ``k`` rows per map task.
    """
    if not keys:
        return df.orderBy(*order_by).limit(k)
    position = F.row_number().over(W.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_r", position).filter(F.col("_r") <= k).drop("_r")
