"""Running totals over a landing folder, one micro-batch per set of new files."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from dayline.operators.joins import attach_lookup, newest_per_key
from dayline.operators.windows import running_total


def totals_batch(batch: DataFrame, before: DataFrame | None, keys: Sequence[str], date: str,
                 cols: Mapping[str, str], epoch: str | None = None) -> DataFrame:
    """The days that a batch changes: of each key it has, from the first of its days on.

    ``before`` holds daily sums of earlier batches; a day may be in any number of them. Every row
    of a batch counts, whatever the stored dates are. With ``epoch`` earlier days are left out.
    """
    if epoch is not None:
        batch = batch.filter(F.col(date) >= F.lit(epoch).cast("date"))
    sums = [F.sum(c).alias(c) for c in cols]
    daily = batch.groupBy(*keys, date).agg(*sums)
    first = daily.groupBy(*keys).agg(F.min(date).alias("_first"))
    known = daily if before is None else before.select(daily.columns).unionByName(daily) \
        .groupBy(*keys, date).agg(*sums)
    touched = attach_lookup(known, first, list(keys), ["_first"]).filter("_first IS NOT NULL")
    rows = running_total(touched, keys, date, cols)
    return rows.filter(F.col(date) >= F.col("_first")).drop("_first")


def blocks_before(n: int) -> list[tuple[int, int]]:
    """Ranges ``[a, b)`` of batches that together are the first ``n``: a power of two each, falling."""
    out, first = [], 0
    for k in reversed(range(n.bit_length())):
        if n >> k & 1:
            out.append((first, first + (1 << k)))
            first += 1 << k
    return out


def _block(state: str, first: int, end: int) -> str:
    return os.path.join(state, f"first={first}-end={end}")


def write_batch(batch: DataFrame, batch_id: int, target: str, state: str, keys: Sequence[str],
                date: str, cols: Mapping[str, str], epoch: str | None = None) -> None:
    """Write the days that one batch changes, and its daily sums as a part of the state.

    The state holds daily sums by blocks of 1, 2, 4, ... batches: a batch writes its own and, where it
    fills a larger block, the sum of that one, so that ``n`` batches are read from at most log2(n)
    folders, and a sum is written once for each size of block. Blocks are never changed: a repeated
    batch starts from the blocks before it and writes its own again, also if it failed in a merge, so
    nothing is counted twice. Smaller blocks stay until :func:`drop_merged` removes them.
    """
    session = batch.sparkSession
    if epoch is not None:
        batch = batch.filter(F.col(date) >= F.lit(epoch).cast("date"))
    sums = [F.sum(c).alias(c) for c in cols]
    daily = batch.groupBy(*keys, date).agg(*sums)

    def read(blocks: Sequence[tuple[int, int]]) -> DataFrame:
        return session.read.schema(daily.schema).parquet(*[_block(state, *b) for b in blocks])

    daily.write.mode("overwrite").parquet(_block(state, batch_id, batch_id + 1))
    own, earlier = [(batch_id, batch_id + 1)], blocks_before(batch_id)
    rows = totals_batch(read(own), read(earlier) if earlier else None, keys, date, cols)
    rows.write.mode("overwrite").parquet(os.path.join(target, f"batch_id={batch_id}"))
    whole = blocks_before(batch_id + 1)[-1]
    if whole not in own:
        parts = [b for b in earlier if b[0] >= whole[0]] + own
        read(parts).groupBy(*keys, date).agg(*sums).write.mode("overwrite").parquet(_block(state, *whole))


def drop_merged(spark: SparkSession, state: str, batches: int) -> list[str]:
    """Remove the blocks that neither the last of ``batches`` finished ones, repeated, nor any later one reads."""
    needed = {_block(state, *b) for n in (batches - 1, batches) for b in blocks_before(n)}
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(state)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(hadoop)] if fs.exists(hadoop) else []
    gone = [x for x in names if x.startswith("first=") and os.path.join(state, x) not in needed
            and int(x.rpartition("=")[2]) <= batches]
    for name in gone:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(os.path.join(state, name)), True)
    return gone


def read_totals(spark: SparkSession, target: str, keys: Sequence[str], date: str) -> DataFrame:
    """The totals as they stand: of each key and day what the last batch that changed it wrote."""
    return newest_per_key(spark.read.parquet(target), [*keys, date], "batch_id").drop("batch_id")


def totals_stream(spark: SparkSession, landing: str, schema: StructType, target: str, state: str,
                  checkpoint: str, keys: Sequence[str], date: str, cols: Mapping[str, str],
                  file_format: str = "parquet", epoch: str | None = None,
                  max_files: int | None = None) -> StreamingQuery:
    """Process the files that wait in ``landing`` and stop; :func:`read_totals` gives the result.

    How files are divided over batches does not change it. A file counts once, by its name.
    """
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (reader.load(landing).writeStream
            .foreachBatch(lambda batch, n: write_batch(batch, n, target, state, keys, date, cols, epoch))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
