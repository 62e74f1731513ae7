"""Landed tables, as published, to preprocessed entity tables.

Each function renames, parses the dates, keeps the days in ``[lo, hi]`` (``EPOCH`` and today when
not given) and conforms to the entity's schema. Areas keep their own name unless ``names`` maps
them; with ``only_named`` the areas it does not map are left out.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline.functions.columns import RISK_COLOURS
from dayline.functions.dates import DAY_FIRST, ISO_DAY, date_bounds, parse_date
from dayline.operators.projections import recode, rename, with_constants
from dayline.schemas import RENAMES, conform
from dayline.sources.snapshots import latest_snapshot_per_day, scan_newest


def _within(df: DataFrame, lo, hi, lo_open: bool = False) -> DataFrame:
    low, high = date_bounds(lo, hi)
    above = F.col("date") > low if lo_open else F.col("date") >= low
    return df.filter(above & (F.col("date") <= high))


def _named(df: DataFrame, col: str, names: Mapping[str, str] | None, only_named: bool) -> DataFrame:
    if not names:
        return df
    if only_named:
        df = df.filter(F.col(col).isin(list(names)))
    known: Column = F.try_element_at(
        F.create_map(*[F.lit(v) for pair in names.items() for v in pair]), F.col(col))
    return df.withColumn(col, F.coalesce(known, F.col(col)))


def province_data(raw: DataFrame, name: str, lo=None, hi=None) -> DataFrame:
    out = rename(raw, RENAMES["province_data"]).withColumn("date", parse_date("date", DAY_FIRST[0]))
    return conform(with_constants(_within(out, lo, hi), name=name), "province_data")


def municipality_data(raw: DataFrame, version: str, committed: str, lo=None, hi=None) -> DataFrame:
    """From all landed versions of the table: per day of ``committed`` the newest ``version``."""
    low, high = date_bounds(lo, hi)
    dated = raw.withColumn("_day", F.to_date(committed)).filter(F.col("_day").between(low, high))
    newest = latest_snapshot_per_day(dated, "_day", version)
    out = rename(newest, RENAMES["municipality_data"])
    return conform(out.withColumn("date", parse_date("date", *DAY_FIRST)), "municipality_data")


def municipality_files(spark: SparkSession, path: str, lo=None, hi=None, **scan) -> DataFrame:
    """The same from the files of a history: of each day only the newest version is read."""
    columns = ", ".join(f"`{c}` string" for c in RENAMES["municipality_data"])
    low, high = [None if x is None else str(x) for x in (lo, hi)]
    newest = scan_newest(spark, path, columns, lo=low, hi=high, **{"header": True, **scan})
    out = rename(newest.drop("_day", "_version"), RENAMES["municipality_data"])
    return conform(out.withColumn("date", parse_date("date", *DAY_FIRST)), "municipality_data")


def region_risk(raw: DataFrame, lo=None, hi=None, names: Mapping[str, str] | None = None,
                only_named: bool = False, lo_open: bool = False) -> DataFrame:
    out = rename(raw, RENAMES["region_risk"]).withColumn("date", parse_date("date", *ISO_DAY))
    out = recode(_named(out, "region", names, only_named), "risk", RISK_COLOURS)
    return conform(_within(out, lo, hi, lo_open), "region_risk")


def _vaccines(raw: DataFrame, entity: str, lo, hi, names, only_named) -> DataFrame:
    out = rename(raw, RENAMES[entity]).withColumn("date", parse_date("date", *ISO_DAY))
    return conform(_within(_named(out, "region", names, only_named), lo, hi), entity)


def vaccines_administration(raw: DataFrame, lo=None, hi=None,
                            names: Mapping[str, str] | None = None,
                            only_named: bool = False) -> DataFrame:
    return _vaccines(raw, "vaccines_administration", lo, hi, names, only_named)


def vaccines_delivery(raw: DataFrame, lo=None, hi=None, names: Mapping[str, str] | None = None,
                      only_named: bool = False) -> DataFrame:
    return _vaccines(raw, "vaccines_delivery", lo, hi, names, only_named)


def municipality_codes(raw: DataFrame) -> DataFrame:
    """``(code, name, population)`` of the landed town list."""
    return rename(raw, RENAMES["municipality"]).select(
        F.col("code").try_cast("smallint").alias("code"), "name",
        F.col("population").try_cast("int").alias("population"))
