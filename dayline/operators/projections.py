"""Column shaping: rename, constants, recoding, roles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayline.functions.columns import recode_column, transform_column


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def with_constants(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


def recode(df: DataFrame, col: str, mapping: Mapping, default=None) -> DataFrame:
    return df.withColumn(col, recode_column(col, mapping, default))


def nan_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in cols})


def columns_like(df: DataFrame, text: str) -> list[str]:
    return [c for c in df.columns if text in c]


def select_roles(df: DataFrame, keys: Sequence[str], date: str, y: str,
                 x: Sequence[str] = ()) -> DataFrame:
    """Keys, date, the output, then the regressors."""
    return df.select(*keys, date, y, *x)


def transform(df: DataFrame, col: str, kind: str | None) -> DataFrame:
    return df.withColumn(col, transform_column(col, kind))
