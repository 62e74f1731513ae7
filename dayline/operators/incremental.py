"""Bringing a stored table up to date from its own high-water marks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayline.operators.aggregates import high_water_mark
from dayline.operators.joins import attach_lookup


def new_rows(source: DataFrame, target: DataFrame, keys: Sequence[str], date: str,
             epoch: str | None = None, measured: bool = True) -> DataFrame:
    """Source rows after the newest stored date of their key.

    Of a new key all rows, or with ``epoch`` those from that day on. ``measured`` writes the marks
    first, so that few marks are broadcast; sources of a row per key and day do without.
    """
    return rows_after(source, high_water_mark(target, date, keys, date), keys, date, epoch, measured)


def rows_after(source: DataFrame, marks: DataFrame, keys: Sequence[str], date: str,
               epoch: str | None = None, measured: bool = True) -> DataFrame:
    """The same from a table of marks, the newest stored ``date`` of each key: no history is read."""
    marks = marks.select(*keys, F.col(date).alias("_latest"))
    marked = attach_lookup(source, marks, list(keys), ["_latest"], measured)
    latest = F.col("_latest").cast("date")
    fresh = latest.isNull() if epoch is None else \
        latest.isNull() & (F.col(date) >= F.lit(epoch).cast("date"))
    return marked.filter(fresh | (F.col(date) > latest)).drop("_latest")


def rewind(target: DataFrame, arrivals: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """``target`` up to the day before each key's first arrival.

    Running totals depend on every earlier row, so when rows arrive late their keys are rebuilt
    from there; keys without arrivals stay whole.
    """
    first = arrivals.groupBy(*keys).agg(F.min(date).alias("_first"))
    marked = attach_lookup(target, first, list(keys), ["_first"], measured=True)
    return marked.filter(F.col("_first").isNull() | (F.col(date) < F.col("_first"))).drop("_first")
