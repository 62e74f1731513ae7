"""First load of static tables and the daily update of the others."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayline.operators.incremental import rows_after
from dayline.operators.joins import inner_on, via_links
from dayline.schemas import conform
from dayline.sinks.loads import Latest, append_load, read_latest


class Entity(NamedTuple):
    """What to bring up to date: landed rows, where they are stored, and their keys."""

    landed: DataFrame
    path: str
    keys: Sequence[str] = ()
    date: str = "date"
    partition_by: Sequence[str] = ()
    links: DataFrame | None = None  # only rows reached by these links, on ``keys``
    epoch: str | None = None  # the first day of a key that is not stored yet


def stored(spark: SparkSession, path: str, like: DataFrame, partition_by: Sequence[str] = ()
           ) -> DataFrame:
    """The stored table, created empty if it is not there yet."""
    like.limit(0).write.mode("ignore").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(like.schema).parquet(path)


def update_entity(spark: SparkSession, entity: Entity) -> int:
    """Load what is newer than the stored rows; returns how many rows that were.

    The newest stored date of each key comes from the marks that the last load has left; the stored
    rows are not read. :func:`dayline.sinks.loads.read_loads` reads the table.
    """
    fresh, kept = entity.landed, Latest(entity.keys, entity.date)
    if entity.links is not None:
        fresh = via_links(fresh, entity.links.select(*entity.keys).distinct(), entity.keys, "left_semi")
    marks = read_latest(spark, entity.path, kept)
    if marks is not None:
        fresh = rows_after(fresh, marks, entity.keys, entity.date, entity.epoch)
    elif entity.epoch is not None:
        fresh = fresh.filter(F.col(entity.date) >= F.lit(entity.epoch).cast("date"))
    return append_load(fresh, entity.path, partition_by=entity.partition_by, latest=kept)


def update_all(spark: SparkSession, entities: Mapping[str, Entity],
               selected: Sequence[str] | None = None, skip: Sequence[str] = ()) -> DataFrame:
    """Update every entity (or the selected ones, without the skipped) and report on each.

    An entity that fails is reported and does not stop the others. ``seconds`` is the time each took.
    """
    report = []
    for name, entity in entities.items():
        if (selected is not None and name not in selected) or name in skip:
            continue
        began = time.perf_counter()
        try:
            row = (name, "success", update_entity(spark, entity), None)
        except Exception as e:  # the report is where a failed load is seen
            row = (name, "failed", 0, str(e).splitlines()[0] if str(e) else repr(e))
        report.append((*row, time.perf_counter() - began))
    return spark.createDataFrame(
        report, "entity string, status string, records long, error string, seconds double")


def load_static(codes: DataFrame, towns: DataFrame, province: str, province_code: int
                ) -> tuple[DataFrame, DataFrame]:
    """Municipality and province tables from town codes and populations.

    ``codes`` has code, lat and lon; ``towns`` code, name and population.
    """
    municipality = inner_on(codes.select("code", "lat", "lon"),
                            towns.select("code", "name", "population"), "code") \
        .withColumn("province", F.lit(province))
    whole = towns.agg(F.sum("population").alias("population")) \
        .withColumns({"name": F.lit(province), "code": F.lit(province_code)})
    return conform(municipality, "municipality"), conform(whole, "province")
