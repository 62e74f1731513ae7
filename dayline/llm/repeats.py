"""Removal of bytes in repeated 100-byte strings, by column-wise construction of suffix orders.

A column-wise construction inserts one symbol of each text per round, so over whole documents it has
as many rounds as the longest document has bytes, each of them a pass over all that was inserted.
Documents are therefore first cut into segments that any two equal strings share: a string of
``LENGTH`` bytes belongs to the least hashed ``GRAM``-byte string inside it (the leftmost of equals),
and the strings that follow one another with the same one are a segment, of at most
2 * LENGTH - GRAM bytes. Equal strings lie in segments of equal gram, at the same place around it.

1. Segments that are equal as a whole are grouped by hash; all but the first are repeats. Each task
   first does this for its own, so a passage that a third of the documents share leaves a task once.
2. Where one gram has several segments, their texts are fetched and the suffixes of each block of
   them are ordered column by column: round after round, one more symbol of each segment is put
   before its suffix, and the order of all suffixes follows from the symbols before them and the
   order so far. Neighbours in the last order that share ``LENGTH`` bytes are equal strings.
3. Grams with more segments than a block holds compare hashes of their strings through a shuffle.

Texts are shuffled only for documents that a fixed-size filter of ids lets through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayline.llm.text import BLOCK, blocks, prefix_hashes, range_hashes, scramble, split_by_ids, stored, utf8_bytes

LENGTH = 100
GRAM = 24
SLICE = 8 << 20  # bytes whose segments a task compares among themselves before they are shuffled
PIECE = 4 << 20  # longer texts are cut into pieces of so many starts
BLOCK_SEGMENTS = 512  # of several grams; a gram with up to LARGE is a block of its own
LARGE = 2048
NO_ID = 1 << 62  # null doc_ids are numbers from here, by the hash of their text


def segments(data: np.ndarray, offsets: np.ndarray):
    """(gram hash, content hash, row, start, strings, place of the gram) of all segments, as arrays."""
    width = LENGTH - GRAM + 1
    empty = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    if len(data) < LENGTH:
        return empty
    sums = prefix_hashes(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = range_hashes(sums, at, at + GRAM)
    # hash in the upper 40 bits, position in the lower 24: the least is the leftmost of the least hashed
    least = (grams & np.uint64(0xFFFFFFFFFF000000)) | at.astype(np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    least = np.minimum(least[:len(least) - rest], least[rest:])
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(least)]
    starts = np.flatnonzero(np.arange(len(least)) + LENGTH <= offsets[1:][rows])
    if not len(starts):
        return empty
    gram_at = (least[starts] & np.uint64(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], gram_at[1:] != gram_at[:-1])))
    n = np.diff(np.append(first, len(starts)))
    begin, gram_at = starts[first], gram_at[first]
    row = rows[begin]
    return (grams[gram_at], range_hashes(sums, begin, begin + n + LENGTH - 1), row, begin - offsets[row], n, gram_at - begin)


def _pieces(data: np.ndarray, offsets: np.ndarray):
    """Segments of all rows; texts too long for one vector operation are cut where strings may start."""
    for a, b in blocks(offsets):
        lo, hi = offsets[a], offsets[b]
        for start in range(lo, max(hi - LENGTH + 1, lo + 1), PIECE):
            end = min(hi, start + PIECE + LENGTH - 1) if hi - lo > PIECE else hi
            ends = offsets[a:b + 1] - offsets[a] if hi - lo <= PIECE else np.array([0, end - start])
            kh, ch, row, at, n, place = segments(data[start:end], ends)
            yield kh, ch, row + a, at + (start - lo if hi - lo > PIECE else 0), n, place
            if hi - lo <= PIECE:
                break


# doc is the order of documents and th, the hash of the text, tells rows of one doc apart;
# spot: start, strings (8 bits) and whether it is a repeat (1 bit)
_RUN = ("kh", "ch", "doc", "th", "spot")
_RUN_TYPE = "kh long, ch long, doc long, th long, spot long"


def _first_of_slice(parts: list[tuple]) -> pa.RecordBatch:
    """The segments of a slice; ``again`` marks those that an earlier one of the slice equals.

    Those need no group any more and get a gram of their own, so that they spread over all tasks.
    """
    kh, ch, doc, th, at, n = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((th, at, doc, scramble(kh ^ scramble(ch))))
    kh, ch, doc, th, at, n = (x[order] for x in (kh, ch, doc, th, at, n))
    same = np.concatenate(([False], (kh[1:] == kh[:-1]) & (ch[1:] == ch[:-1])))
    # a repeated row has equal positions: it is the same document, not an earlier one
    tie = np.concatenate(([False], same[1:] & (doc[1:] == doc[:-1]) & (at[1:] == at[:-1]) & (th[1:] == th[:-1])))
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(kh))))
    again = same & ~((doc == doc[head]) & (at == at[head]))
    kh = np.where(again, scramble(scramble(doc.astype(np.uint64)) + at.astype(np.uint64)), kh) >> np.uint64(16)
    columns = (kh.view(np.int64), ch.view(np.int64), doc, th, (at << 9) | (n << 1) | again)
    return pa.RecordBatch.from_arrays([pa.array(x[~tie]) for x in columns], names=list(_RUN))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, size = [], 0
    for batch in batches:
        data, offsets = utf8_bytes(batch.column("text"))
        docs, hashes = batch.column("doc").to_numpy(), batch.column("th").to_numpy()
        for kh, ch, row, at, n, _ in _pieces(data, offsets):
            parts.append((kh, ch, docs[row], hashes[row], at, n))
            size += int(n.sum())
            if size >= SLICE:
                yield _first_of_slice(parts)
                parts, size = [], 0
    if parts:
        yield _first_of_slice(parts)


def suffix_order(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes of the texts in order, column by column: text and length of each; and the texts
    end to end, as rows of equal width that are filled from the left with 255, which UTF-8 lacks."""
    width = max(map(len, texts), default=0) + 1
    symbols = np.frombuffer(b"".join(t.rjust(width, b"\xff") for t in texts), np.uint8)
    ends = (np.arange(len(texts), dtype=np.int32) + 1) * np.int32(width) - np.int32(1)
    before = ends  # for each suffix so far, in order, where the symbol before it stands
    for _ in range(width - 1):
        symbol = symbols[before]
        order = np.argsort(symbol, kind="stable")
        # suffixes that are whole texts have the fill before them, sort last and are not extended
        order = order[:len(order) - int(np.count_nonzero(symbol == 255))]
        before = np.concatenate((ends, before[order] - 1))
    text = before // width
    return text, ends[text] - before, symbols


def repeated_strings(texts: list[bytes], doc: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """For each text whether the string at each of its starts also starts earlier in another place."""
    text, length, flat = suffix_order(texts)
    whole = length >= LENGTH
    text, length = text[whole], length[whole]
    begin = (text + 1) * (len(flat) // max(1, len(texts))) - length
    equal = np.ones(max(0, len(text) - 1), bool)
    open_ = np.arange(len(equal))
    for column in range(LENGTH):
        open_ = open_[flat[begin[open_] + column] == flat[begin[open_ + 1] + column]]
    equal[:] = False
    equal[open_] = True
    group = np.concatenate(([0], np.cumsum(~equal))) if len(text) else np.zeros(0, np.int64)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    offset = lengths[text] - length
    place = at[text] + offset
    order = np.lexsort((place, doc[text], group))
    head = np.searchsorted(group, np.arange(group[-1] + 1)) if len(group) else np.zeros(0, np.int64)
    first = order[head][group] if len(group) else order  # group ids are sorted, so heads of order are firsts
    again = (doc[text] != doc[text[first]]) | (place != place[first])
    out = [np.zeros(max(0, n - LENGTH + 1), bool) for n in lengths]
    for t, o in zip(text[again].tolist(), offset[again].tolist()):
        out[t][o] = True
    return out


def _with_company(kh: np.ndarray, data: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Segments that may share a string with another of their gram.

    A string has (LENGTH - GRAM) / 2 bytes beside the gram on one side at least, so two segments that
    share one share the gram with that many bytes before it, or with that many after it.
    """
    sums, side = prefix_hashes(data), (LENGTH - GRAM + 1) // 2
    at = base[:-1] + segments(data, base)[5]  # all strings of a segment belong to one gram
    out = np.zeros(len(kh), bool)
    for lo, hi in ((at - side, at + GRAM), (at, at + GRAM + side)):
        there = np.flatnonzero((lo >= base[:-1]) & (hi <= base[1:]))
        _, which, times = np.unique(scramble(range_hashes(sums, lo[there], hi[there]) ^ kh[there].view(np.uint64)),
                                    return_inverse=True, return_counts=True)
        out[there[times[which] > 1]] = True
    return out


_GONE = "kh long, doc long, th long, lo long, hi long, ch long, open boolean"


def _gone(kh, doc, th, lo, hi, ch, open_) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in (kh, doc, th, lo, hi)]
                                      + [pa.array(np.asarray(ch, np.uint64).view(np.int64)), pa.array(np.full(len(doc), open_))],
                                      names=["kh", "doc", "th", "lo", "hi", "ch", "open"])


def _resolve(kh: np.ndarray, doc: np.ndarray, th: np.ndarray, at: np.ndarray, texts: list[bytes],
             part_of_large: bool) -> Iterator[pa.RecordBatch]:
    """Repeated strings of whole groups of segments with one gram, in blocks; strings of groups that
    are too large for a block come out open, with their hashes."""
    if not part_of_large:
        keep = _with_company(kh, np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))))
        kh, doc, th, at = kh[keep], doc[keep], th[keep], at[keep]
        texts = [t for t, k in zip(texts, keep.tolist()) if k]
    if not len(kh):
        return
    cuts = np.flatnonzero(np.concatenate(([True], kh[1:] != kh[:-1], [True])))
    a = 0
    while a < len(cuts) - 1:
        b = a + 1
        while b < len(cuts) - 1 and cuts[b + 1] - cuts[a] <= BLOCK_SEGMENTS:
            b += 1
        lo, hi = cuts[a], cuts[b]
        part = texts[lo:hi]
        data = np.frombuffer(b"".join(part), np.uint8)
        sums = prefix_hashes(data)
        base = np.concatenate(([0], np.cumsum([len(t) for t in part])))
        if part_of_large or hi - lo > LARGE:
            for i in range(len(part)):
                s = np.arange(base[i], base[i + 1] - LENGTH + 1)
                place = at[lo + i] + np.arange(len(s))
                yield _gone(np.full(len(s), kh[lo]), np.full(len(s), doc[lo + i]), np.full(len(s), th[lo + i]), place, place + LENGTH,
                            range_hashes(sums, s, s + LENGTH), True)
        else:
            rows: list[tuple] = []
            for i, again in enumerate(repeated_strings(part, doc[lo:hi], at[lo:hi])):
                edges = np.flatnonzero(np.diff(np.concatenate(([0], again.view(np.int8), [0]))))
                rows += [(i, s, e + LENGTH - 1) for s, e in zip(edges[::2].tolist(), edges[1::2].tolist())]
            if rows:
                i, s, e = np.array(rows).T
                yield _gone(kh[lo + i], doc[lo + i], th[lo + i], at[lo + i] + s, at[lo + i] + e,
                            range_hashes(sums, base[i] + s, base[i] + e), False)
        a = b


def _in_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """:func:`_resolve` over batches sorted by gram; only groups too large for a block are cut."""
    held: list = []
    large = None  # the gram of which a part was given out

    def drain(rows):
        if rows:
            yield from _resolve(*(np.concatenate([r[k] for r in rows]) for k in range(4)), [t for r in rows for t in r[4]],
                                rows[0][0][0] == large)

    for batch in batches:
        kh, doc, th, at = (batch.column(c).to_numpy() for c in ("kh", "doc", "th", "at"))
        texts = batch.column("segment").to_pylist()
        if not len(kh):
            continue
        cuts = [0, int(np.searchsorted(kh, kh[0], "right")), int(np.searchsorted(kh, kh[-1])), len(kh)]
        # the end of what is held, the groups in between, and the last group, which may go on
        for lo, hi in zip(cuts, cuts[1:]) if cuts[2] else [(0, len(kh))]:
            if lo >= hi:
                continue
            if held and held[-1][0][-1] != kh[lo]:
                yield from drain(held)
                held = []
            held.append((kh[lo:hi], doc[lo:hi], th[lo:hi], at[lo:hi], texts[lo:hi]))
            if held[0][0][0] == held[-1][0][-1] and sum(len(r[0]) for r in held) > LARGE:
                large = held[0][0][0]
                yield from drain(held)
                held = []
    yield from drain(held)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of the segments that are wanted of each document."""
    for batch in batches:
        data, offsets = utf8_bytes(batch.column("text"))
        wanted = batch.column("wanted").to_pylist()
        rows = []
        for i, (doc, th) in enumerate(zip(batch.column("doc").to_pylist(), batch.column("th").to_pylist())):
            text = data[offsets[i]:offsets[i + 1]]
            sums = prefix_hashes(text)
            for w in wanted[i]:
                lo, hi = w["at"], w["at"] + w["n"] + LENGTH - 1
                # two texts of one doc_id may share a hash
                if hi <= len(text) and int(range_hashes(sums, np.array([lo]), np.array([hi])).view(np.int64)[0]) == w["ch"]:
                    rows.append((w["kh"], doc, th, lo, text[lo:hi].tobytes()))
        kh, doc, th, at, segment = zip(*rows) if rows else ((), (), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (kh, doc, th, at)] + [pa.array(segment, pa.binary())],
                                         names=["kh", "doc", "th", "at", "segment"])


def _kept(text: np.ndarray, spans: list | None) -> tuple[list[tuple[int, int]], bytes]:
    """The maximal removed runs of a text and what is left."""
    edges = np.zeros(len(text) + 1, np.int32)
    if spans:
        sums = prefix_hashes(text)
        lo, hi, ch = (np.array([s[k] for s in spans], np.int64) for k in ("lo", "hi", "ch"))
        fits = hi <= len(text)
        lo, hi, ch = lo[fits], hi[fits], ch[fits]
        own = range_hashes(sums, lo, hi).view(np.int64) == ch
        np.add.at(edges, lo[own], 1)
        np.add.at(edges, hi[own], -1)
    gone = np.cumsum(edges[:-1]) > 0
    cuts = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
    return list(zip(cuts[::2].tolist(), cuts[1::2].tolist())), text[~gone].tobytes()


_RESULT = ("n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<lo:long,hi:long>>, kept binary")


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("lo", pa.int64()), ("hi", pa.int64())])
    for batch in batches:
        data, offsets = utf8_bytes(batch.column("text"))
        spans = batch.column("spans").to_pylist()
        done = [_kept(data[offsets[i]:offsets[i + 1]], s) for i, s in enumerate(spans)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(np.diff(offsets).astype(np.int64)),
             pa.array([sum(e - s for s, e in runs) for runs, _ in done], pa.int64()),
             pa.array([len(runs) for runs, _ in done], pa.int64()),
             pa.array([hashlib.sha256(kept).hexdigest() for _, kept in done], pa.string()),
             pa.array([[{"lo": s, "hi": e} for s, e in runs] for runs, _ in done], pa.list_(span)),
             pa.array([kept for _, kept in done], pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): what is removed and what is left.

    Columns: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (byte ranges) and kept (bytes).
    A byte goes if a string of ``LENGTH`` bytes over it also starts earlier: in a smaller doc_id, or
    earlier in the same document. Null texts are empty; shorter texts keep all. Rows with a null doc_id
    come after the others (below ``NO_ID``), by the hash of their text. Rows that share a doc_id, and
    rows without one that share their text, are one document: a string at the same place of two of
    them is not earlier in either, so repeated rows fare alike. An empty table gives an empty result;
    further columns are not looked at.
    """
    text = F.coalesce("text", F.lit(""))
    unnamed = F.lit(NO_ID) + F.shiftrightunsigned("th", 2)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th")) \
        .withColumn("doc", F.coalesce("doc_id", unnamed))
    long = rows.where(F.octet_length("text") >= LENGTH).select("doc", "th", "text")
    found = long.mapInArrow(_find, _RUN_TYPE)
    same = Window.partitionBy("kh", "ch").orderBy("doc", "spot")
    whole = Window.partitionBy("kh")
    # dealt once, by gram, for both windows; rows of one doc at the first place are all first
    marked = found.repartition("kh").withColumn("first", F.first(F.struct("doc", "spot")).over(same)) \
        .withColumn("varied", F.min("ch").over(whole) != F.max("ch").over(whole)) \
        .withColumn("again", (F.col("spot").bitwiseAND(F.lit(1).cast("long")) == 1) | (F.col("first") != F.struct("doc", "spot")))
    marked = stored(marked.where(F.col("again") | F.col("varied")).select(
        "kh", "ch", "doc", "th", F.shiftright("spot", 9).alias("at"),
        F.shiftright("spot", 1).bitwiseAND(F.lit(255).cast("long")).alias("n"), "again", "varied"), "segments")
    varied = marked.where("varied and not again").select("doc", "th", F.struct("kh", "at", "n", "ch").alias("w")).distinct() \
        .groupBy("doc", "th").agg(F.collect_list("w").alias("wanted"))
    varied = stored(varied, "wanted")
    # of rows that repeat one text is cut, with the partitioning of the join
    texts = split_by_ids(long, varied, "doc", "th").where("may").select("doc", "th", "text").dropDuplicates(["doc", "th"]).join(varied, ["doc", "th"])
    cut = texts.mapInArrow(_cut, "kh long, doc long, th long, at long, segment binary")
    resolved = stored(cut.repartition("kh").sortWithinPartitions("kh", "doc", "at").mapInArrow(_in_groups, _GONE), "resolved")
    gone = marked.where("again").select("doc", "th", F.col("at").alias("lo"), (F.col("at") + F.col("n") + (LENGTH - 1)).alias("hi"), "ch") \
        .unionByName(resolved.where("not open").select("doc", "th", "lo", "hi", "ch"))
    if not (large := resolved.where("open")).isEmpty():
        firsts = large.groupBy("kh", "ch").agg(F.min(F.struct("doc", "lo")).alias("first"))
        later = large.join(firsts, ["kh", "ch"]).where(F.struct("doc", "lo") != F.col("first"))
        gone = gone.unionByName(later.select("doc", "th", "lo", "hi", "ch"))
    # repeated rows yield equal spans
    spans = stored(gone.groupBy("doc", "th").agg(F.collect_set(F.struct("lo", "hi", "ch")).alias("spans")), "spans")
    split = split_by_ids(rows, spans, "doc", "th")
    met = split.where("may").drop("may").join(spans, ["doc", "th"], "left").select("doc_id", "text", "spans")
    none = split.where("not may").select("doc_id", "text", F.lit(None).cast("array<struct<lo:long,hi:long,ch:long>>").alias("spans"))
    return met.mapInArrow(_finish, f"doc_id long, {_RESULT}").unionByName(none.mapInArrow(_finish, f"doc_id long, {_RESULT}"))
