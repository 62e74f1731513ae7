"""Window operators over daily series.

``densify`` ends with rows still hashed by key, so filling, lags, totals and changes that
follow it reuse that partitioning: one shuffle for the whole chain.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.window import WindowSpec

from dayline.operators.joins import attach_lookup


def series_window(keys: Sequence[str], date: str) -> WindowSpec:
    return W.partitionBy(*(list(keys) or [F.lit(0)])).orderBy(date)


def whole_series(keys: Sequence[str]) -> WindowSpec:
    return W.partitionBy(*(list(keys) or [F.lit(0)]))


def _values(df: DataFrame, keys: Sequence[str], date: str) -> list[str]:
    return [c for c in df.columns if c != date and c not in keys]


def densify(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """One row per day from the first to the last date of each series; new days are NULL.

    Each row fans out over the gap that follows it, so there is no calendar to join.
    """
    w = series_window(keys, date)
    gap_end = F.greatest(F.date_sub(F.lead(date).over(w), 1), F.col(date))
    out = df.filter(F.col(date).isNotNull()).withColumn("_until", gap_end)
    out = out.withColumn("_day", F.explode(F.sequence(F.col(date), F.col("_until"))))
    own = F.col("_day") == F.col(date)
    values = [F.when(own, F.col(c)).alias(c) for c in _values(df, keys, date)]
    return out.select(*keys, F.col("_day").alias(date), *values)


def _carried(df: DataFrame, keys: Sequence[str], date: str, days: int,
             per_bucket: Mapping[str, Column], carry: Callable[[str, WindowSpec], Column]
             ) -> tuple[DataFrame, WindowSpec]:
    """Split series into buckets of ``days`` and attach what earlier buckets hand on.

    Each bucket is reduced to one row, a window over those few rows carries them forward, and
    the result joins back. Windows over rows then need only span one bucket.
    """
    split = df.withColumn("_bucket", F.floor(F.unix_date(F.col(date).cast("date")) / days))
    reduced = split.groupBy(*keys, "_bucket").agg(*[v.alias(n) for n, v in per_bucket.items()])
    before = series_window(keys, "_bucket").rowsBetween(W.unboundedPreceding, -1)
    handed = reduced.select(*keys, "_bucket", *[carry(n, before).alias(n) for n in per_bucket])
    inner = W.partitionBy(*keys, "_bucket").orderBy(date).rowsBetween(W.unboundedPreceding, 0)
    return split.join(handed, [*keys, "_bucket"], "left"), inner


def ffill(df: DataFrame, keys: Sequence[str], date: str, cols: Sequence[str] | None = None,
          flag: str | None = None, bucket_days: int | None = None) -> DataFrame:
    """Carry the last known value forward; ``flag`` marks rows where something was carried.

    ``bucket_days`` spreads series too long for one task over buckets of that many days.
    """
    cols, order = list(cols or _values(df, keys, date)), df.columns
    if bucket_days:
        held = {f"_held_{c}": F.max_by(c, F.when(F.col(c).isNotNull(), F.col(date))) for c in cols}
        df, w = _carried(df, keys, date, bucket_days, held,
                         lambda n, over: F.last(n, ignorenulls=True).over(over))
        filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(w), F.col(f"_held_{c}"))
                  for c in cols}
    else:
        w = series_window(keys, date).rowsBetween(W.unboundedPreceding, 0)
        filled = {c: F.last(c, ignorenulls=True).over(w) for c in cols}
    if flag:
        was_null = F.lit(False)
        for c in cols:
            was_null = was_null | (F.col(c).isNull() & filled[c].isNotNull())
        filled[flag] = was_null
    return df.withColumns(filled).select(*order, *([flag] if flag else []))


def running_total(df: DataFrame, keys: Sequence[str], date: str, cols: Mapping[str, str],
                  seed: DataFrame | None = None, bucket_days: int | None = None) -> DataFrame:
    """Running totals (``cols`` maps input to output), on top of the seed row's totals if given.

    ``bucket_days`` spreads series too long for one task over buckets of that many days.
    """
    order = df.columns
    start = {out: F.lit(0) for out in cols.values()}
    if seed is not None:
        named = seed.select(*keys, *[F.col(o).alias(f"_seed_{o}") for o in cols.values()])
        df = attach_lookup(df, named, keys, [f"_seed_{o}" for o in cols.values()])
        start = {out: F.coalesce(F.col(f"_seed_{out}"), F.lit(0)) for out in cols.values()}
    if bucket_days:
        df, w = _carried(df, keys, date, bucket_days, {f"_sum_{o}": F.sum(c) for c, o in cols.items()},
                         lambda n, over: F.sum(n).over(over))
        totals = {}
        for c, out in cols.items():
            own, earlier = F.sum(c).over(w), F.col(f"_sum_{out}")
            totals[out] = F.coalesce(own + earlier, own, earlier) + start[out]
    else:
        w = series_window(keys, date).rowsBetween(W.unboundedPreceding, 0)
        totals = {out: F.sum(c).over(w) + start[out] for c, out in cols.items()}
    return df.withColumns(totals).select(*order, *cols.values())


def daily_change(df: DataFrame, keys: Sequence[str], date: str, cols: Mapping[str, str],
                 seed: DataFrame | None = None) -> DataFrame:
    """Difference to the day before; the first row differs from the seed row's value, or from 0.

    ``cols`` maps a level column to its change column; the seed has the level columns.
    """
    w = series_window(keys, date)
    before = {c: F.lit(0) for c in cols}
    if seed is not None:
        named = seed.select(*keys, *[F.col(c).alias(f"_seed_{c}") for c in cols])
        df = attach_lookup(df, named, keys, [f"_seed_{c}" for c in cols])
        before = {c: F.coalesce(F.col(f"_seed_{c}"), F.lit(0)) for c in cols}
    first = F.row_number().over(w) == 1
    return (df.withColumns({out: F.when(first, F.col(c) - before[c])
                           .otherwise(F.col(c) - F.lag(c).over(w)) for c, out in cols.items()})
            .drop(*[f"_seed_{c}" for c in cols]))


def share_of(df: DataFrame, cols: Mapping[str, str], denom: Column | str) -> DataFrame:
    denom = F.col(denom) if isinstance(denom, str) else denom
    return df.withColumns({out: F.try_divide(F.col(c).cast("double"), denom.cast("double"))
                           for c, out in cols.items()})


def latest_row(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """The newest row of each series, as a partial aggregate."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(date)).alias("_row"))
            .filter(F.col("_row").isNotNull()).select(*keys, "_row.*").select(*df.columns))


def difference(df: DataFrame, keys: Sequence[str], date: str, col: str, d: int = 1, D: int = 0,
               m: int = 1, drop: bool = True, name: str | None = None) -> DataFrame:
    """``d`` ordinary and ``D`` seasonal differences at period ``m``; first rows go if ``drop``."""
    name = name or col
    w = series_window(keys, date)
    out = df.withColumn("_x", F.col(col).cast("double"))
    for step in [1] * d + [m] * D:
        out = out.withColumn("_x", F.col("_x") - F.lag("_x", step).over(w))
    if drop and (d or D):
        out = out.withColumn("_pos", F.row_number().over(w)) \
            .filter(F.col("_pos") > d + D * m).drop("_pos")
    return out.withColumn(name, F.col("_x")).drop("_x")


def lags(df: DataFrame, keys: Sequence[str], date: str, col: str,
         lag_set: Sequence[int]) -> DataFrame:
    w = series_window(keys, date)
    return df.withColumns({f"{col}_lag{k}": F.lag(col, k).over(w) for k in lag_set})


def moving_trend(df: DataFrame, keys: Sequence[str], date: str, col: str, m: int = 7,
                 name: str = "trend") -> DataFrame:
    """Centred moving average over one period, NULL where the period does not fit."""
    w = series_window(keys, date)
    half = m // 2
    around = w.rowsBetween(-half, half)
    total = F.sum(F.col(col).cast("double")).over(around)
    if m % 2 == 0:  # both ends of an even period count half
        total = total - (F.lag(col, half).over(w) + F.lead(col, half).over(w)) / 2.0
    complete = F.count(col).over(around) == 2 * half + 1
    return df.withColumn(name, F.when(complete, total / m))


def last_n(df: DataFrame, keys: Sequence[str], date: str, n: int = 1) -> DataFrame:
    """``role`` is ``test`` on the last ``n`` rows of each series, ``train`` before."""
    position = F.row_number().over(series_window(keys, date))
    size = F.count(F.lit(1)).over(whole_series(keys))
    return df.withColumn("role", F.when(position > size - n, "test").otherwise("train"))


def folds_of(sized: DataFrame, keys: Sequence[str], n: str, n_splits: int = 10,
             max_test: int | None = None) -> DataFrame:
    """Walk-forward folds of series whose length is in column ``n``: see ``fold_table``."""
    rows = F.col(n).cast("int")
    block = F.floor(rows / (n_splits + 1)).cast("int")
    fold = F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("fold")
    out = sized.select(*keys, rows.alias("_n"), block.alias("_s"), fold).filter("_s > 0")
    size = F.col("_s") if max_test is None else F.least(F.col("_s"), F.lit(max_test))
    start = F.col("_n") - (n_splits - F.col("fold")) * F.col("_s")
    return out.select(*keys, "fold", start.alias("train_size"), size.alias("test_size"))


def fold_table(df: DataFrame, keys: Sequence[str], n_splits: int = 10,
               max_test: int | None = None) -> DataFrame:
    """Walk-forward folds of each series: test blocks of ⌊N/(n+1)⌋ rows, training all before.

    Row positions count from 0; a test block is cut to its first ``max_test`` rows.
    """
    return folds_of(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys, "n", n_splits,
                    max_test)


def walk_forward(df: DataFrame, keys: Sequence[str], date: str, n_splits: int = 10,
                 max_test: int | None = None) -> DataFrame:
    """Every row once per fold it takes part in, with ``fold`` and ``role``.

    A row knows its folds from its position alone, so nothing is joined.
    """
    out = df.withColumns({
        "_pos": F.row_number().over(series_window(keys, date)) - 1,
        "_n": F.count(F.lit(1)).over(whole_series(keys))})
    block = F.floor(F.col("_n") / (n_splits + 1))
    out = out.withColumn("_s", block).filter(F.col("_s") > 0)
    out = out.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    start = F.col("_n") - (n_splits - F.col("fold")) * F.col("_s")
    size = F.col("_s") if max_test is None else F.least(F.col("_s"), F.lit(max_test))
    role = (F.when(F.col("_pos") < start, "train")
            .when(F.col("_pos") < start + size, "test"))
    return out.withColumn("role", role).filter(F.col("role").isNotNull()).drop("_pos", "_n", "_s")


def hold_last(x: DataFrame, keys: Sequence[str], date: str, cols: Sequence[str],
              steps: int) -> DataFrame:
    """A future scenario: ``steps`` days after each series with its last known values."""
    known = x.groupBy(*keys).agg(
        F.max(date).alias("_last"),
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(date))).alias(c) for c in cols])
    days = F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", steps)))
    return known.filter(F.col("_last").isNotNull()).select(*keys, days.alias(date), *cols)
