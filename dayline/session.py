"""Session defaults and the one place that decides where scratch tables may live."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "dayline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; keyword names use ``__`` for the dots of a setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(name, value)
    return ship(builder.getOrCreate())


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Hand this package to the workers, once an application, as a zip file.

    Functions that run in tasks are found by import there, also where the package lies in no folder
    of the workers' own path.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        place = os.path.join(tempfile.mkdtemp(prefix="dayline-zip-"), "dayline-package.zip")
        with zipfile.ZipFile(place, "w") as out:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(place)
        _shipped.add(context.applicationId)
    return spark


_local_root: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table, under the shared folder of ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the executors
    would each write to their own disk.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        _local_root = _local_root or tempfile.mkdtemp(prefix="dayline-")
        root = _local_root
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")
