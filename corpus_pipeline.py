"""From documents to shards: five stages, each an operator of ``dayline.llm``, each written and reread."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dayline.llm import decontamination, mixing, quality, sharding, simhash  # noqa: E402
from dayline.llm.text import stored, table  # noqa: E402

# The classifier and the fingerprints are not expressible in SQL; tests/llm compares each stage with
# a plain version.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts; null and empty texts go."""
    return quality.accepted_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each group of near copies."""
    return simhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no window of a benchmark item."""
    return decontamination.leak_free(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each epoch that a document is taken in."""
    return mixing.mixed_documents(docs)


def place_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with slot and shard."""
    return sharding.place(docs)


STAGES = [("quality", keep_quality), ("near_copies", drop_near_copies), ("leaks", drop_leaks),
          ("mixing", mix_sources), ("shards", place_shards)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
