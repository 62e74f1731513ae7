"""Predicates that reach the scan, and gates over whole sources."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline.functions.dates import partial_date


def scan_between(df: DataFrame, col: str, lo=None, hi=None, lo_open: bool = False) -> DataFrame:
    """Rows whose ``col`` lies in a range; a missing bound is open, ``lo_open`` excludes ``lo``."""
    if lo is not None:
        df = df.filter(F.col(col) > lo if lo_open else F.col(col) >= lo)
    if hi is not None:
        df = df.filter(F.col(col) <= hi)
    return df


def predicate(preds: Mapping[str, object]) -> Column:
    """AND of one test per column: range → between its ends, list → in, scalar → equality."""
    tests = []
    for name, value in preds.items():
        if isinstance(value, range):
            tests.append(F.col(name).between(value[0], value[-1]) if len(value) else F.lit(False))
        elif isinstance(value, (list, tuple, set)):
            tests.append(F.col(name).isin(list(value)))
        elif isinstance(value, (int, float, str, bool, Decimal, dt.date)):
            tests.append(F.col(name) == F.lit(value))
        else:
            raise TypeError(f"no test for {name}: {type(value).__name__}")
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def select_where(df: DataFrame, preds: Mapping[str, object], join: DataFrame | None = None,
                 on: Sequence[str] | str | None = None) -> DataFrame:
    """Filter, then optionally an inner join on common key columns."""
    out = df.filter(predicate(preds))
    if join is None:
        return out
    if not on:
        raise ValueError("a join needs its key columns")
    return out.join(join, [on] if isinstance(on, str) else list(on), "inner")


def crop_from(df: DataFrame, date: str, first: str) -> DataFrame:
    """Rows on or after a full or partial date; empty text keeps all."""
    return df if first == "" else df.filter(F.col(date) >= partial_date(first))


def drop_empty(df: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """Rows with a key and at least one measure."""
    return df.filter(F.col(key).isNotNull() & F.coalesce(
        *[F.col(m).cast("string") for m in measures]).isNotNull())


def gate_complete(df: DataFrame, sources: Sequence[DataFrame],
                  keys: Sequence[str] = ()) -> DataFrame:
    """All of ``df`` if every source has rows (for the same key), none of it otherwise."""
    for source in sources:
        if keys:
            df = df.join(source.select(*keys).distinct(), list(keys), "left_semi")
        else:
            df = df.filter(source.select(F.lit(1)).exists())
    return df
