"""SimHash near-duplicates by an inverted index of byte positions with count filtering.

A fingerprint has eight bytes; two that differ in at most four bits share at least four of them.
The index holds each distinct fingerprint under twenty triples of byte positions, chosen so that
any four positions contain one of them: a pair that shares four positional bytes meets there, and
postings are a 2^24th part of the table instead of a 2^8th. For each pair that meets, the shared
bytes are tallied, pairs with at least four are kept, and the bit distance is verified. A pair is
looked at only under the first triple it shares. Long postings give a spanning forest of their
links instead of all of them; the longest are indexed again with a fourth position.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayline.llm.components import components
from dayline.llm.text import LOWER, stored, utf8_bytes

SHINGLE = 4
MAX_BITS = 4
PAIRS_UP_TO = 48  # postings up to this length are compared pair by pair in vector operations
REFINE_ABOVE = 20_000
_LOWER = LOWER.tobytes()


def _triples() -> list[tuple[int, int, int]]:
    """Triples of 0-7 of which any four positions contain one.

    With the positions in three parts, four of them hold three of one part, or two of a part and one
    of the next.
    """
    part = [0, 0, 0, 1, 1, 1, 2, 2]
    return [t for t in combinations(range(8), 3)
            if len({part[x] for x in t}) == 1 or any(
                sorted(part[x] for x in t) == sorted((p, p, (p + 1) % 3)) for p in range(3))]


TRIPLES = _triples()
_FIRST = np.array([next((i for i, t in enumerate(TRIPLES) if all(m >> p & 1 for p in t)), 255)
                   for m in range(256)], np.uint8)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of whole words in shingles; 0 for a text without words."""
    words = text.translate(_LOWER).split()  # bytes.split() is by ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words)) - 1
    starts, ends = starts[:len(starts) - k].tolist(), ends[k:].tolist()
    ones, hash_of = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), 1 << 16):
        h = np.array([hash_of(joined[s:e], 42) for s, e in zip(starts[at:at + (1 << 16)], ends[at:at + (1 << 16)])],
                     np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp) for each row of ``docs`` (doc_id, text), fp as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_bytes(batch.column("text"))
            ends = offsets.tolist()
            found = np.fromiter((fingerprint(data[a:b].tobytes(), shingle) for a, b in zip(ends, ends[1:])),
                                np.uint64, len(ends) - 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("text_hash"),
                                              pa.array(found.view(np.int64))], names=["doc_id", "text_hash", "fp"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text") \
        .mapInArrow(run, "doc_id long, text_hash long, fp long")


def _forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of the fingerprints: one less than each component has."""
    a, b, rest = [], [], fps
    while len(rest):
        reached, rest = rest[:1], rest[1:]
        while len(reached) and len(rest):
            near = np.bitwise_count(rest ^ reached[0]) <= max_bits
            hits = rest[near]
            a.append(np.full(len(hits), reached[0], np.uint64))
            b.append(hits)
            reached, rest = np.concatenate((reached[1:], hits)), rest[~near]
    return (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (a, b))


def _links(key: np.ndarray, fp: np.ndarray, max_bits: int, refine_above: int | None):
    """Links among equal keys of whole postings sorted by key, and the indices to index again."""
    change = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    lengths = np.diff(change)
    a, b, again = [], [], []
    short = np.repeat(lengths <= PAIRS_UP_TO, lengths)
    for step in range(1, min(PAIRS_UP_TO, int(lengths.max(initial=0)))):
        same = np.flatnonzero((key[:-step] == key[step:]) & short[:-step])
        if not len(same):
            break
        x, y = fp[same], fp[same + step]
        differ = x ^ y
        near = np.bitwise_count(differ) <= max_bits
        x, y, differ, triple = x[near], y[near], differ[near], (key[same][near] >> 24) & 255
        shared = np.packbits(differ.view(np.uint8).reshape(-1, 8) == 0, axis=1, bitorder="little")[:, 0] \
            if len(x) else np.zeros(0, np.uint8)
        first = (np.bitwise_count(shared) >= 8 - max_bits) & (_FIRST[shared] == triple)
        if refine_above is None:  # keys with a fourth position: a pair may meet more than once
            first = np.bitwise_count(shared) >= 8 - max_bits
        a.append(x[first])
        b.append(y[first])
    for i in np.flatnonzero(lengths > PAIRS_UP_TO):
        if refine_above is not None and lengths[i] > refine_above:
            again.append(np.arange(change[i], change[i + 1]))
            continue
        x, y = _forest(fp[change[i]:change[i + 1]], max_bits)
        a.append(x)
        b.append(y)
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *a]), np.concatenate([empty, *b]), np.concatenate([np.zeros(0, np.int64), *again])


def _linker(max_bits: int, refine_above: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key, fp):
            a, b, again = _links(key, fp, max_bits, refine_above)
            n, m = len(a), len(again)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((a, fp[again])).view(np.int64)),
                 pa.array(np.concatenate((b, fp[again])).view(np.int64)),
                 pa.array(np.concatenate((np.full(n, -1), key[again] >> 24)), pa.int64())],
                names=["a", "b", "again"])

        keys, fps = [], []  # the rows since the last change of key
        for batch in batches:
            key = batch.column("key").to_numpy(zero_copy_only=False)
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))
            keys.append(key[:last] if last else key)
            fps.append(fp[:last] if last else fp)
            if last:
                yield out(np.concatenate(keys), np.concatenate(fps))
                keys, fps = [key[last:]], [fp[last:]]
            elif len(keys) > 1 and keys[-2][-1] != key[0]:
                yield out(np.concatenate(keys[:-1]), np.concatenate(fps[:-1]))
                keys, fps = keys[-1:], fps[-1:]
        if keys:
            yield out(np.concatenate(keys), np.concatenate(fps))
    return run


def _byte(position: int):
    return F.shiftrightunsigned("fp", 8 * position).bitwiseAND(F.lit(255).cast("long"))


def links(fps: DataFrame, max_bits: int = MAX_BITS, refine_above: int = REFINE_ABOVE) -> DataFrame:
    """(a, b): links that connect whatever distinct fingerprints (fp) are within ``max_bits``."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the index guarantees four shared bytes up to four bits")
    def keyed(triple: int, t) -> list:
        return F.lit(triple << 24).cast("long") + F.shiftleft(_byte(t[0]), 16) + F.shiftleft(_byte(t[1]), 8) + _byte(t[2])

    indexed = fps.select("fp", F.explode(F.array(*[keyed(i, t) for i, t in enumerate(TRIPLES)])).alias("key"))
    found = stored(indexed.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp").mapInArrow(
        _linker(max_bits, refine_above), "a long, b long, again long"), "links")
    pairs = found.where("again < 0").select("a", "b")
    long = found.where("again >= 0").select(F.col("a").alias("fp"), F.col("again").alias("triple"))
    if long.isEmpty():
        return pairs
    finer = []
    for i, t in enumerate(TRIPLES):
        rest = [p for p in range(8) if p not in t]
        keys = F.array(*[F.shiftleft(keyed(0, t), 8) + _byte(p) + F.lit((i * 8 + p) << 32).cast("long") for p in rest])
        finer.append(F.when(F.col("triple") == i, keys))
    again = long.select("fp", F.explode(F.coalesce(*finer)).alias("key"))
    more = again.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp").mapInArrow(
        _linker(max_bits, None), "a long, b long, again long")
    return pairs.unionByName(more.select("a", "b"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs`` (doc_id, text).

    component_id is the least doc_id that links of at most ``max_bits`` bits reach. Null, empty and
    wordless texts have fingerprint 0 and link like others. A null doc_id takes part in links but is
    never the least of a component that has another; rows that repeat stay rows; an empty table
    gives an empty result; further columns are not looked at.
    """
    marked = stored(fingerprints(docs, shingle).select("doc_id", "fp"), "fingerprints")
    least = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    labelled = _labelled(least, max_bits)
    ids = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = labelled.join(ids, "label").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def _labelled(least: DataFrame, max_bits: int) -> DataFrame:
    """(fp, least, label) from (fp, least), a row for each fingerprint; linked ones have one label."""
    joined = components(links(least, max_bits))
    return least.join(joined, least.fp == joined.node, "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each component of near copies; columns as they are.

    The row of least doc_id stays, of several the one of least text hash, and of rows that share both
    any one. Rows without doc_id link like others and stay only in a component that has no other. A
    row with neither doc_id nor text has nothing to compare and stays.
    """
    doc, text_hash = F.col("doc_id").cast("long"), F.xxhash64("text")
    blank = F.col("doc_id").isNull() & F.col("text").isNull()
    marked = fingerprints(docs.where(~blank), shingle).groupBy("fp", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "n")
    least = stored(marked.groupBy("fp").agg(F.min(place).alias("least")), "distinct")
    firsts = _labelled(least, max_bits).groupBy("label").agg(F.min("least").alias("first"))
    # a row may share doc_id and text hash with the first, so n says whether one is to be picked
    firsts = stored(firsts.select(F.col("first.doc_id").alias("_doc"), F.col("first.text_hash").alias("_hash"), "first.n"), "firsts")
    same = doc.eqNullSafe(F.col("_doc")) & (text_hash == F.col("_hash"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    kept = docs.where(~blank).join(firsts.where("n = 1"), same, "left_semi").select(*columns)
    again = firsts.where("n > 1")
    if not again.isEmpty():
        copies = docs.where(~blank).withColumns({"_id": doc, "_text": text_hash}).join(
            again, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_hash")), "left_semi")
        kept = kept.unionByName(copies.dropDuplicates(["_id", "_text"]).select(*columns))
    return kept.unionByName(docs.where(blank))
