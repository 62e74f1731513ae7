"""Choosing versions of a table that is landed whole again and again.

A history is a folder of files whose names tell the day and the version. :func:`landed_files` lists it
as a table without opening a file, :func:`newest_files` chooses on that table, and :func:`scan_newest`
reads the chosen files alone. :func:`latest_snapshot_per_day` chooses among rows, where versions are a
column of one table.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dayline.operators.filters import scan_between
from dayline.schemas import conform
from dayline.sources.files import csv_frames

MOST_BROADCAST = 100_000  # chosen files whose days are sent to each task
#: A day as yyyy-MM-dd somewhere in the name, and what follows it, digits and separators, as version.
DAY = r"(\d{4}-\d{2}-\d{2})"
VERSION = r"\d{4}-\d{2}-\d{2}(.*)$"


def landed_files(spark: SparkSession, path: str, day: str = DAY, version: str | None = VERSION,
                 keys: Mapping[str, str] | None = None) -> DataFrame:
    """(path, uri, day, version, bytes, modified): one row for each landed file, from a listing alone.

    ``day`` and ``version`` are regular expressions for the part of a path below ``path``, whose first
    group counts; ``keys`` has more of them by column name. Without ``version`` the time of change
    tells versions apart. Files without a day are not part of the history.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path) \
        .select("path", F.col("_metadata.file_path").alias("uri"), "modificationTime", "length")  # no content is read
    root = re.sub(r"^[\w+.-]+:/*", "/", path.rstrip("/")) + "/"
    below = F.expr(f"substring(path, instr(path, {_quoted(root)}) + {len(root)})")

    def part(pattern: str) -> Column:
        return F.regexp_extract(below, pattern, 1)

    told = part(version) if version else F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    return files.select("path", "uri", F.try_to_date(part(day)).alias("day"), told.alias("version"),
                        *[part(p).alias(k) for k, p in (keys or {}).items()],
                        F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")).filter(F.col("day").isNotNull())


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def newest_files(files: DataFrame, keys: Sequence[str] = (), lo=None, hi=None) -> DataFrame:
    """The files of the newest version of each day (and key), for days in ``[lo, hi]``.

    A version of several files is kept whole. Versions compare as text, so give them a fixed width.
    """
    wanted = scan_between(files, "day", lo, hi)
    newest = wanted.groupBy(*keys, "day").agg(F.max("version").alias("version"))
    return wanted.join(newest, [*keys, "day", "version"], "left_semi")


def scan_newest(spark: SparkSession, path: str, schema: StructType | str, file_format: str = "csv", lo=None, hi=None,
                day: str = DAY, version: str | None = VERSION, keys: Mapping[str, str] | None = None, **options) -> DataFrame:
    """The rows of the newest version of each day, with ``_day``, ``_version`` and ``keys``.

    Only what the listing says of chosen files comes to the driver, a few rows for each day and key;
    files of other versions are never opened. Headed CSV files are read by the names in their headers.
    """
    own = [F.col("day").alias("_day"), F.col("version").alias("_version"), *(keys or ())]
    chosen = newest_files(landed_files(spark, path, day, version, keys), list(keys or ()), lo, hi) \
        .select("path", F.col("uri").alias("_uri"), *own)
    told = chosen.collect()
    names = spark.createDataFrame(told, chosen.schema).drop("path")
    whole = StructType([*(schema if isinstance(schema, StructType) else StructType.fromDDL(schema)), StructField("_uri", StringType())])
    paths, uri = sorted(r.path for r in told), F.col("_metadata.file_path")
    if not paths:
        rows = spark.createDataFrame([], whole)
    elif file_format == "csv" and str(options.get("header")).lower() == "true":
        rows = reduce(DataFrame.unionByName, [conform(f.withColumn("_uri", uri), whole) for f in csv_frames(spark, paths, **options)])
    else:
        rows = spark.read.format(file_format).schema(StructType(whole.fields[:-1])).options(**options).load(paths).withColumn("_uri", uri)
    return rows.join(F.broadcast(names) if len(told) <= MOST_BROADCAST else names, "_uri").drop("_uri")


def latest_snapshot_per_day(df: DataFrame, day: str, version: str, keys: Sequence[str] = (),
                            lo=None, hi=None) -> DataFrame:
    """Rows of the newest version of each day (per key), for days in ``[lo, hi]``.

    The newest version is a partial aggregate of three columns and the rows are kept by a semi
    join on the full (key, day, version): a day with very many rows is never sorted in one task.
    """
    wanted = scan_between(df, day, lo, hi)
    newest = wanted.groupBy(*keys, day).agg(F.max(version).alias(version))
    return wanted.join(newest, [*keys, day, version], "left_semi")
