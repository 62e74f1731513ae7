"""Appends, inserts and replacements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from dayline.operators.joins import newest_per_key


def append_checked(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                   expected: int | None = None, mode: str = "append") -> int:
    """Write ``df`` and return how many rows went out, counted while they were written.

    A count other than ``expected`` raises, but the rows are in the table by then: it reports. Where a
    wrong count must leave the table as it was, use :func:`dayline.sinks.loads.append_load`.
    """
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode)
    if partition_by:
        out = out.partitionBy(*partition_by)
    out.parquet(path)
    n = seen.get["n"]
    if expected is not None and n != expected:
        raise ValueError(f"wrote {n} rows, expected {expected}")
    return n


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Replace the whole table, whatever it held."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite") \
        .option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get["n"]


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    """Replace the partitions ``df`` has rows for and leave the others as they are."""
    seen = Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))
    return seen.get["n"]


def insert_if_absent(new: DataFrame, existing: DataFrame, keys: Sequence[str],
                     newest_by: str | None = None) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet, one per key.

    Among several new rows with one key the largest ``newest_by`` wins, without it the largest by all
    other columns, from the first on: runs agree.
    """
    rest = [c for c in new.columns if c not in keys]
    if newest_by:
        one = newest_per_key(new, keys, newest_by)
    elif rest:
        one = new.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row")).select(*keys, "_row.*").select(*new.columns)
    else:
        one = new.distinct()
    return one.join(existing.select(*keys), list(keys), "left_anti")


def replace_by_key(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` without the keys ``new`` has, plus ``new``."""
    kept = existing.join(new.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(new)
