"""Texts as bytes: what the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayline.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"  # a run of anything but ASCII white space
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLOCK = 1 << 18  # bytes of text that one vector operation works on
FILTER_WORDS = 1 << 18  # 64-bit words of a filter of ids


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table written once under ``spark.checkpoint.dir``: cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(seed: str, *cols: Column) -> Column:
    """32 bits of MD5 as a long, the same in any SQL engine that has md5()."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), *parts)), 1, 8), 16, 10).cast("long")


def split_by_ids(rows: DataFrame, ids: DataFrame, *names: str) -> DataFrame:
    """``rows`` with ``may``: false only for rows whose columns ``names`` are surely not among ``ids``.

    The filter has ``FILTER_WORDS`` rows at most, which bounds what is broadcast; with very many ids
    it lets all rows through.
    """
    bit = F.pmod(F.xxhash64(*names), F.lit(FILTER_WORDS * 64))
    words = ids.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    joined = rows.withColumn("bit", bit).withColumn("word", F.shiftright("bit", 6)).join(
        F.broadcast(stored(words, "id-filter")), "word", "left")
    set_ = F.expr("coalesce(shiftrightunsigned(bits, cast(bit & 63 as int)) & 1, 0) = 1")
    return joined.withColumn("may", set_).drop("bit", "word", "bits")


def by_batch(df: DataFrame, setup: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
             fields: list[T.StructField]) -> DataFrame:
    """``df`` with further columns, which replace columns of those names.

    ``setup`` runs once a task and returns what makes the columns of an Arrow batch.
    """
    new = {f.name.lower() for f in fields}
    kept = [f for f in df.schema if f.name.lower() not in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = setup()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(batch.columns + make(batch), names=batch.schema.names + [f.name for f in fields])

    return df.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, T.StructType([*kept, *fields]))


def utf8_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column end to end and its n + 1 offsets; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.binary() if pa.types.is_string(column.type) else column.type) \
        .cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes; a longer text is a block of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


_POWERS = {"n": 0, "up": None, "down": None}
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POWERS["n"] < n:
        size = max(n, BLOCK + 4096)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            one = np.full(size, base, np.uint64)
            one[0] = 1
            _POWERS[name] = np.multiply.accumulate(one)
        _POWERS["n"] = size
    return _POWERS["up"][:n], _POWERS["down"][:n]


def scramble(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial sums of all prefixes of bytes or code points, for :func:`range_hashes`."""
    up, _ = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    # each byte goes in scrambled, so that the sum modulo 2^64 has no weak low bits
    np.cumsum((_SYMBOL[data] if data.dtype == np.uint8 else scramble(data.astype(np.uint64) + np.uint64(1))) * up, out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges, equal for equal bytes wherever they stand."""
    _, down = _powers(len(sums))
    return scramble((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


_SYMBOL = scramble(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Starts and ends of the words in bytes, and the n + 1 word offsets of the rows."""
    inside = is_word[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[edges] = inside[edges]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    stops[last] = inside[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays of whole numbers from 0 as compressed bytes; low and high bytes stand apart."""
    head, body = [], []
    for x in arrays:
        kind = 4 if not len(x) or int(x.max()) < 1 << 32 else 8
        planes = np.ascontiguousarray(x, f"<u{kind}").view(np.uint8).reshape(-1, kind).T
        kind = max((i + 1 for i in range(kind) if planes[i].any()), default=1)
        head += [kind, len(x)]
        body.append(np.ascontiguousarray(planes[:kind]).tobytes())
    data = np.array([len(arrays), *head], "<i8").tobytes() + b"".join(body)
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpack(packed: bytes) -> list[np.ndarray]:
    """What :func:`pack` was given, as 32-bit or, where needed, 64-bit numbers."""
    data = np.frombuffer(pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True), np.uint8)
    n = int(data[:8].view("<i8")[0])
    at, out = 8 + 16 * n, []
    for kind, size in data[8:at].view("<i8").reshape(n, 2).tolist():
        width = 4 if kind < 4 else 8
        whole = np.zeros((size, width), np.uint8)
        whole[:, :kind] = data[at:at + kind * size].reshape(kind, size).T
        out.append(whole.reshape(-1).view(f"<i{width}"))
        at += kind * size
    return out


def pack_words(words: pa.Array) -> list[np.ndarray]:
    """Two arrays for :func:`pack`: the sizes of the words and their bytes."""
    letters, ends = utf8_bytes(words)
    return [np.diff(ends), letters]


def unpack_words(sizes: np.ndarray, letters: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(letters.astype(np.uint8).tobytes())])
