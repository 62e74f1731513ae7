"""Loads that count once they are committed, with the newest row of each key kept beside them.

A table folder holds the rows of each load under ``_load=<name>``, a line for each finished load in
the small table ``_commits/lines``, and the newest row of each key under ``_latest/<name>``. A load is
written aside, counted while it is written, and its line is written last, as one file. Readers take
the loads that have a line, so a wrong count, a failure or a kill between the steps leaves the table
as it was, and a load that is repeated under its name changes nothing. The newest rows come from those
before and the new ones alone: no load reads the history. One writer a table at a time.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dayline.operators.joins import newest_per_key

LINE = "number long, name string, rows long, replaces boolean, latest boolean, schema string"


class Latest(NamedTuple):
    """What to keep of the newest row of each key: its date, and further columns."""

    keys: Sequence[str]
    date: str
    cols: Sequence[str] = ()


def commits(spark: SparkSession, path: str) -> list[Row]:
    """The lines of the finished loads that count, in order: those from the last replacement on."""
    place = os.path.join(path, "_commits", "lines")
    spark.createDataFrame([], LINE).write.mode("ignore").parquet(place)
    lines = sorted(spark.read.schema(LINE).parquet(place).collect(), key=lambda r: r.number)
    first = max([i for i, r in enumerate(lines) if r.replaces], default=0)
    return lines[first:]


def _place(path: str, name: str) -> str:
    return os.path.join(path, f"_load={name}")


def append_load(df: DataFrame, path: str, name: str | None = None, expected: int | None = None,
                partition_by: Sequence[str] = (), latest: Latest | None = None, replace: bool = False) -> int:
    """Append ``df`` as one load, or with ``replace`` put it in place of all loads; returns its rows.

    A count other than ``expected`` raises and publishes nothing. A ``name`` that is committed already
    is not loaded again: its count is returned. Without a name, loads are numbered.
    """
    spark, done = df.sparkSession, commits(df.sparkSession, path)
    if name is not None and not re.fullmatch(r"[\w.-]+", name):
        raise ValueError(f"a load cannot be named {name!r}")
    for line in done:
        if line.name == name:
            return line.rows
    number = done[-1].number + 1 if done else 0
    name = name or f"{number:08d}"
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (out.partitionBy(*partition_by) if partition_by else out).parquet(_place(path, name))
    n = seen.get["n"]
    if expected is not None and n != expected:
        raise ValueError(f"counted {n} rows, expected {expected}; nothing was published")
    if latest is not None:
        before = None if replace else read_latest(spark, path, latest)
        own = _newest(spark.read.schema(df.schema).option("basePath", _place(path, name)).parquet(_place(path, name)), latest)
        if before is not None:
            own = _newest(before.unionByName(own), latest)
        own.write.mode("overwrite").parquet(os.path.join(path, "_latest", name))
    line = [(number, name, n, replace, latest is not None, df.schema.json())]
    spark.createDataFrame(line, LINE).coalesce(1).write.mode("append").parquet(os.path.join(path, "_commits", "lines"))
    return n


def _newest(df: DataFrame, latest: Latest) -> DataFrame:
    cols = [c for c in latest.cols if c not in latest.keys and c != latest.date]
    rows = df.select(*latest.keys, latest.date, *cols).filter(F.col(latest.date).isNotNull())
    return newest_per_key(rows, list(latest.keys), latest.date).filter(F.col(latest.date).isNotNull())


def read_loads(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The rows of all committed loads, as the last one's columns (or ``schema``)."""
    done = commits(spark, path)
    if not done and schema is None:
        raise ValueError(f"nothing has been loaded into {path}")
    schema = schema or StructType.fromJson(json.loads(done[-1].schema))
    places = [_place(path, line.name) for line in done if line.rows]
    if not places:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*places).select(*schema.names)


def read_latest(spark: SparkSession, path: str, latest: Latest | None = None) -> DataFrame | None:
    """The newest row of each key as of the last load; None before any.

    Where a load has kept none, they are made from the whole table, if ``latest`` says of which columns.
    """
    done = commits(spark, path)
    if not done:
        return None
    if done[-1].latest:
        return spark.read.parquet(os.path.join(path, "_latest", done[-1].name))
    return _newest(read_loads(spark, path), latest) if latest else None
