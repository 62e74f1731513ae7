"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over training windows.

The windows of the benchmark are hashed and broadcast in blocks of at most ``BLOCK_WINDOWS``
windows, each block one more pass over the documents, so the broadcast does not grow with the
benchmark. A document's words are hashed in vector operations; where the hash of a window of words
is in the set, its words are compared. Documents are not shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayline.llm.text import (LOWER, blocks, by_batch, lower_ascii, prefix_hashes, range_hashes, scramble,
                              stored, utf8_bytes, word_spans)

NGRAM = 10
BLOCK_WINDOWS = 200_000
_WORDS = np.zeros(256, bool)
_WORDS[48:58] = _WORDS[97:123] = _WORDS[128:] = True
_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_windows(items: DataFrame, n: int = NGRAM) -> DataFrame:
    """(words, items): each distinct window of the items and the ids, as strings, that hold it.

    An item of fewer than ``n`` words, but not none, is one window. A null item_id is no item.
    """
    words = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(_PATTERN), F.lit(0))
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (n - 1))),
                      lambda i: F.array_join(F.slice("w", i, n), " "))
    return items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()) \
        .select(F.col("item_id").cast("string").alias("item"), words.alias("w")).where(F.size("w") > 0) \
        .select("item", F.explode(F.array_distinct(cut)).alias("words")) \
        .groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _window_hashes(word_hash: np.ndarray, length: int) -> np.ndarray:
    """The hash of each run of ``length`` words."""
    n = len(word_hash) - length + 1
    total = np.zeros(max(0, n), np.uint64)
    for k in range(length if n > 0 else 0):
        total = total * np.uint64(0x9FB21C651E98DF25) + word_hash[k:k + n]
    return scramble(total)


class _Block:
    """The windows of one pass: their words to their items, and sorted hashes by length in words."""

    def __init__(self, rows: list[tuple[str, list[str]]]):
        self.items = {words.encode(): items for words, items in rows}
        by_length: dict[int, list[int]] = {}
        for words in self.items:
            data = np.frombuffer(words, np.uint8)
            starts, ends, _ = word_spans(data, np.array([0, len(data)]), _WORDS)
            hashes = range_hashes(prefix_hashes(data), starts, ends)
            by_length.setdefault(len(starts), []).append(int(_window_hashes(hashes, len(starts))[0]))
        self.hashes = {k: np.unique(np.array(v, np.uint64)) for k, v in by_length.items()}
        self.filters = {}
        for k, hashes in self.hashes.items():
            self.filters[k] = np.zeros(1 << 20, bool)
            self.filters[k][hashes >> np.uint64(44)] = True


def _scan(data: np.ndarray, offsets: np.ndarray, block: _Block, out: list):
    """Appends (n_words, spans of hit words, items) for each row."""
    lowered = LOWER[data]
    starts, ends, firsts = word_spans(lowered, offsets, _WORDS)
    hashes = range_hashes(prefix_hashes(lowered), starts, ends)
    row_end = np.repeat(firsts[1:], np.diff(firsts))
    found: dict[int, list[tuple[int, int, list[str]]]] = {}
    for length, known in block.hashes.items():
        h = _window_hashes(hashes, length)
        at = np.flatnonzero(block.filters[length][h >> np.uint64(44)])
        at = at[(at + length <= row_end[at]) & np.isin(h[at], known)]
        if len(at):
            rows = np.searchsorted(firsts, at, "right") - 1
            for i, row in zip(at.tolist(), rows.tolist()):
                words = b" ".join([lowered[s:e].tobytes() for s, e in zip(starts[i:i + length], ends[i:i + length])])
                if (items := block.items.get(words)) is not None:
                    found.setdefault(row, []).append((i - int(firsts[row]), length, items))
    for row, n in enumerate(np.diff(firsts).tolist()):
        spans: list[list[int]] = []
        for start, length, _ in sorted(found.get(row, ()), key=lambda x: x[:2]):
            if spans and start <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], start + length)
            else:
                spans.append([start, start + length])
        out.append((n, spans, sorted({x for _, _, items in found.get(row, ()) for x in items})))


def _scanner(block):
    def setup():
        windows = _Block(block.value)

        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            data, offsets = utf8_bytes(batch.column("text"))
            rows: list = []
            for a, b in blocks(offsets):
                _scan(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], windows, rows)
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            return [pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([[{"start": s, "end": e} for s, e in r[1]] for r in rows], pa.list_(span)),
                    pa.array([r[2] for r in rows], pa.list_(pa.string()))]
        return make
    return setup


_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
_MARKS = [T.StructField("n_words", T.LongType()), T.StructField("hit_spans", T.ArrayType(_SPAN)),
          T.StructField("hit_items", T.ArrayType(T.StringType()))]


def find_leaks(docs: DataFrame, items: DataFrame, n: int = NGRAM, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` with n_words, hit_spans (ranges of hit words, merged) and hit_items (sorted ids).

    ``docs`` needs text, ``items`` item_id and text. A-Z are lowered; words are runs of ASCII digits,
    letters and non-ASCII characters. A null or empty text has no words and no hits; repeated rows
    are marked alike; an empty benchmark marks nothing; columns of ``docs`` with the new names are
    replaced, all others pass through.
    """
    context = docs.sparkSession.sparkContext
    windows = stored(item_windows(items, n), "windows")
    parts = max(1, -(-windows.count() // block_windows))
    windows = windows.withColumn("part", F.pmod(F.xxhash64("words"), F.lit(parts)))
    marked = docs
    for part in range(parts):
        rows = windows.where(F.col("part") == part).select("words", "items").collect()  # a block at most
        block = context.broadcast([(r.words, list(r.items)) for r in rows])
        if part:
            marked = marked.withColumnsRenamed({"hit_spans": "_spans", "hit_items": "_items"})
        marked = by_batch(marked, _scanner(block), _MARKS)
        if part:
            marked = marked.withColumns({"hit_spans": _merged(F.array_sort(F.concat("_spans", "hit_spans"))),
                                         "hit_items": F.array_sort(F.array_union("_items", "hit_items"))}) \
                .drop("_spans", "_items")
    return marked


def _merged(spans: Column) -> Column:
    """Sorted spans with those that touch as one."""
    def add(done, x):
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (x["start"] <= last["end"]), F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(x)))
    return F.aggregate(spans, F.array().cast(T.ArrayType(_SPAN)), add)


def hit_words() -> Column:
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def without_spans(text: Column, spans: Column) -> Column:
    """The text's words, lowered and joined by spaces, without those in the spans."""
    words = F.regexp_extract_all(lower_ascii(text), F.lit(_PATTERN), F.lit(0))
    return F.array_join(F.filter(words, lambda w, i: ~F.exists(spans, lambda s: (s["start"] <= i) & (i < s["end"]))), " ")


def leak_free(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents of ``docs`` that hold no window of an item, with their columns as they are."""
    return find_leaks(docs, items, **options).where(F.size("hit_spans") == 0) \
        .select(*[F.col(f"`{c}`") for c in docs.columns])
