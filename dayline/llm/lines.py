"""Line dedup by a segment-partition edit join.

Two lines link if the shorter one has ``SYMBOLS`` symbols for each edit between them, up to ``EDITS``:
below 10 symbols only equal lines are the same, below 20 one edit may lie between them, else two. Cut
the shorter into ``EDITS`` + 1 segments, and one of them stands unchanged in the other, near its own
place. So each line is indexed under its segments, with their
number and the line's length, and probes the segments of lines up to ``EDITS`` shorter with the few
substrings that may match. Index and probe meet by hash in one shuffle of hashes. Only lines that
meet another there are fetched as text, and pairs are verified by a banded bit-parallel automaton.

A pair is verified under the first segment it shares, so it counts once. A task gives out how many
links each line has and links that span its components, never all pairs of a group. Common lines
are one row from the start, as the join is over distinct lines. Where more than ``REFINE_ABOVE``
lines share a segment, they are dealt anew by that segment and a piece of what is beside it: of
``EDITS`` + 1 such pieces one is unchanged as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayline.llm.components import components
from dayline.llm.text import prefix_hashes, range_hashes, scramble, stored

EDITS = 2
SYMBOLS = 10  # code points of the shorter line for each edit; shorter lines link to none, so they are not indexed
SLICE = 1 << 22  # code points of distinct lines that a task signs at a time
POINTS = 1 << 18  # code points that one vector operation works on
FILTER_WORDS = 1 << 18
REFINE_ABOVE = 1000
_WORD = (1 << 64) - 1


def allowed(length: int, edits: int = EDITS) -> int:
    """Edits that may lie between a line of this length and one that is as long or longer."""
    return min(edits, length // SYMBOLS)


def has_word(line: str) -> bool:
    return bool(line.strip(" \t\n\v\f\r"))


def segment(length, i: int, edits: int = EDITS):
    """Start and length of segment ``i`` of a line of the given length (number or array)."""
    short = length // (edits + 1)
    longer = length - short * (edits + 1)  # so many segments at the end have one more
    first_long = edits + 1 - longer
    return i * short + np.maximum(0, i - first_long), short + (i >= first_long)


def probes(i: int, shorter: int, edits: int = EDITS) -> range:
    """Where segment ``i`` of a line ``shorter`` by so much may stand, relative to its own place."""
    rest = edits - i
    return range(max(-i, shorter - rest), min(i, shorter + rest) + 1)


def piece(length: int, i: int, j: int, edits: int = EDITS) -> tuple[int, int]:
    """Start and length of piece ``j`` of a line beside its segment ``i``; no piece runs across it."""
    start, size = (int(x) for x in segment(length, i, edits))
    before = (edits + 1) * i // max(1, edits)
    begin, rest, n, at = (0, start, before, j) if j < before else \
        (start + size, length - start - size, edits + 1 - before, j - before)
    return begin + rest * at // n, rest * (at + 1) // n - rest * at // n


def _split(texts: list, edits: int):
    """Lines with a word of the texts: text number, line number, line."""
    for row, text in enumerate(texts):
        for no, line in enumerate((text or "").split("\n")):
            if has_word(line):
                yield row, no, line


def _hashed(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix sums over the code points of all lines, and where each begins and how long it is."""
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    return prefix_hashes(points), np.cumsum(lengths) - lengths, lengths


def _parts(lines: list[str]) -> Iterator[tuple[int, list[str]]]:
    """The lines in runs of about ``POINTS`` code points, each with the number of its first line."""
    first, size = 0, 0
    for i, line in enumerate(lines):
        if size >= POINTS:
            yield first, lines[first:i]
            first, size = i, 0
        size += len(line)
    if first < len(lines):
        yield first, lines[first:]


def line_ids(lines: list[str]) -> np.ndarray:
    out = [np.zeros(0, np.uint64)]
    for _, part in _parts(lines):
        sums, begins, lengths = _hashed(part)
        out.append(range_hashes(sums, begins, begins + lengths))
    return np.concatenate(out).view(np.int64)


def _key(sums, begins, starts, sizes, length, i) -> np.ndarray:
    at = begins + starts
    return scramble(range_hashes(sums, at, at + sizes) ^ scramble((length * 16 + i).astype(np.uint64)))


def signatures(lines: list[str], edits: int = EDITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, key, index): a row for each segment of a line, and each substring that may be one of another."""
    who, keys, index = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
    for first, part in _parts(lines):
        sums, begins, lengths = _hashed(part)
        every = np.arange(first, first + len(part))
        for shorter in range(edits + 1):
            length = lengths - shorter
            for i in range(edits + 1):
                start, size = segment(length, i, edits)
                for shift in probes(i, shorter, edits):
                    ok = (start + shift >= 0) & (start + shift + size <= lengths) & (length >= SYMBOLS)
                    own = shorter == 0 and shift == 0  # its own segment: indexed, and probes lines as long
                    key = _key(sums, begins, np.where(ok, start + shift, 0), np.where(ok, size, 0), length, i)
                    who.append(every[ok])
                    keys.append(key[ok])
                    index.append(np.full(int(ok.sum()), own))
    return np.concatenate(who), np.concatenate(keys).view(np.int64), np.concatenate(index)


def _same_start(a: str, b: str) -> int:
    """How many symbols both begin with."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def within(a: str, b: str, edits: int = EDITS) -> bool:
    """Whether the edit distance is at most ``edits``: an automaton with a word of bits, one for each
    diagonal of the band, for each number of edits; it ends as soon as no state is left. It runs from
    the first to the last symbol in which the two differ."""
    if abs(len(a) - len(b)) > edits:
        return False
    start = _same_start(a, b)
    a, b = a[start:], b[start:]
    end = _same_start(a[::-1], b[::-1])
    a, b = a[:len(a) - end], b[:len(b) - end]
    if not a or not b:
        return True
    where: dict[str, int] = {}
    for j, c in enumerate(b):
        where[c] = where.get(c, 0) | 1 << (j + edits)
    width = 2 * edits + 1
    band = (1 << width) - 1
    # bit d of states[k]: after i symbols of a, i + d - edits symbols of b are reached with k edits
    states = [1 << edits]
    for k in range(edits):
        states.append(states[k] | states[k] << 1 & band)
    for i, c in enumerate(a):
        same = where.get(c, 0) >> i & band
        before, new = states, []
        for k in range(edits + 1):
            s = before[k] & same
            if k:
                s |= before[k - 1] | before[k - 1] >> 1 | new[k - 1] << 1
            new.append(s & band)
        states = new
        if not states[edits]:
            return False
    return bool(states[edits] >> (len(b) - len(a) + edits) & 1)


def _first_shared(r: str, s: str, edits: int, beside: int | None = None) -> int:
    """The first segment of ``r`` that stands in ``s`` where a probe looks for it, or the first piece
    beside the segment ``beside``."""
    shorter = len(s) - len(r)
    for i in range(edits + 1):
        start, size = segment(len(r), i, edits) if beside is None else piece(len(r), beside, i, edits)
        want = r[start:start + size]
        if edits and not want:  # an empty piece stands everywhere: no key
            continue
        for shift in probes(i, shorter, edits):
            if start + shift >= 0 and s[start + shift:start + shift + size] == want:
                return i
    return -1


def _segment_of(line: str, key: int, edits: int) -> int:
    """The segment of the line that the key is of."""
    sums, begins, lengths = _hashed([line])
    for i in range(edits, -1, -1):
        start, size = segment(len(line), i, edits)
        if int(_key(sums, begins, np.array([start]), np.array([size]), lengths, i).view(np.int64)[0]) == key:
            return i
    return -1


def _group_links(ids: list[int], lines: list[str], parts: list[int], edits: int, degree: dict, pairs: list) -> None:
    """Verified links of the lines of one key: counts in ``degree``, a spanning forest in ``pairs``.

    The first lines of the group, as many as ``parts``, are the indexed ones.
    """
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for r, part in enumerate(parts):
        a = lines[r]
        most = allowed(len(a), edits)
        i, j = part % 16, part // 16 - 1  # without a piece: -1
        for s in range(len(ids)):
            b = lines[s]
            # of lines of equal length, the lesser id is the indexed one
            if len(b) < len(a) or len(b) > len(a) + most or ids[s] == ids[r] or (len(a) == len(b) and ids[s] < ids[r]):
                continue
            if j >= 0 and _first_shared(a, b, edits, i) != j:
                continue
            if _first_shared(a, b, edits) != i or not within(a, b, most):
                continue
            degree[ids[r]] = degree.get(ids[r], 0) + 1
            degree[ids[s]] = degree.get(ids[s], 0) + 1
            if find(ids[r]) != find(ids[s]):
                root[find(ids[r])] = find(ids[s])
                pairs.append((ids[r], ids[s]))


_LINKED = "a long, b long, n long, key long, line string, index boolean, part int"


def _piece_key(key: int, i: int, j: int, content: str) -> int:
    return xxhash.xxh64_intdigest(content.encode("utf-8", "surrogatepass"), (key ^ (i * 16 + j + 1)) & _WORD) - (1 << 63)


def _dealt_anew(i: int, line: str, own: bool, key: int, spots: set, edits: int) -> Iterator[tuple]:
    """The rows of a line of a large group, by the pieces beside the segment at each of ``spots``."""
    for length, part in spots:
        if not 0 <= len(line) - length <= edits:
            continue
        for j in range(edits + 1):
            start, size = piece(length, part, j, edits)
            if edits and not size:
                continue
            for shift in probes(j, len(line) - length, edits):
                at = start + shift
                if at >= 0 and at + size <= len(line):
                    yield (i, None, None, _piece_key(key, part, j, line[at:at + size]), line,
                           own and shift == 0 and len(line) == length, part + 16 * (j + 1))


def _linker(edits: int, refine_above: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (a, b, n): a link if b is there, n links of a otherwise; and lines to be dealt anew.

        Batches are sorted by key, indexed lines first. ``refine_above`` lines are held at most, if given.
        """
        degree: dict[int, int] = {}
        pairs: list[tuple[int, int]] = []
        anew: list[tuple] = []

        def out():
            rows = [(a, b, 0, None, None, None, None) for a, b in pairs] \
                + [(a, None, n, None, None, None, None) for a, n in degree.items()] + anew
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int32())
            columns = list(zip(*rows)) if rows else [()] * len(kinds)
            for held in (degree, pairs, anew):
                held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)],
                                              names=["a", "b", "n", "key", "line", "index", "part"])

        key, ids, lines, parts, spots = None, {}, [], [], None
        for batch in batches:
            for k, i, line, own, part in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "line", "index", "part"))):
                if k != key:
                    if len(lines) > 1:
                        _group_links(list(ids), lines, parts, edits, degree, pairs)
                    key, ids, lines, parts, spots = k, {}, [], [], None
                if spots is not None:
                    if own:
                        spots.add((len(line), _segment_of(line, key, edits)))
                    anew += _dealt_anew(i, line, own, key, spots, edits)
                elif i not in ids:
                    ids[i] = len(lines)
                    lines.append(line)
                    if own:
                        parts.append(part if part >= 0 else _segment_of(line, key, edits))
                    if refine_above is not None and len(lines) > refine_above:
                        spots = {(len(x), p) for x, p in zip(lines, parts)}
                        for n, (held, x) in enumerate(zip(ids, lines)):
                            anew += _dealt_anew(held, x, n < len(parts), key, spots, edits)
                        ids, lines, parts = {}, [], []
                if len(anew) > 20_000:
                    yield out()
            if len(pairs) + len(degree) > 100_000:
                yield out()
        if len(lines) > 1:
            _group_links(list(ids), lines, parts, edits, degree, pairs)
        yield out()
    return run


def _signed(edits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: dict[str, None] = {}
        size = 0

        def out():
            found = list(lines)
            ids = line_ids(found)
            who, key, index = signatures(found, edits)
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids[who]), pa.array(index)], names=["key", "id", "index"])

        for batch in batches:
            for _, _, line in _split(batch.column("text").to_pylist(), edits):
                if len(line) >= SYMBOLS and line not in lines:
                    lines[line] = None
                    size += len(line)
                    if size >= SLICE:
                        yield out()
                        lines, size = {}, 0
        if lines:
            yield out()
    return run


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text_hash, no, id) of each line with a word."""
    for batch in batches:
        rows = list(_split(batch.column("text").to_pylist(), EDITS))
        row = np.array([r for r, _, _ in rows], np.int64)
        ids = line_ids([x for _, _, x in rows]) if rows else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).take(pa.array(row)) for c in ("doc_id", "text_hash")]
            + [pa.array([no for _, no, _ in rows], pa.int32()), pa.array(ids)], names=["doc_id", "text_hash", "no", "id"])


def _fetcher(words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, line) of the lines that the filter of ids lets through, each once a batch."""
        for batch in batches:
            lines = list({x: None for _, _, x in _split(batch.column("text").to_pylist(), EDITS) if len(x) >= SYMBOLS})
            ids = line_ids(lines)
            bit = ids & (FILTER_WORDS * 64 - 1)
            at = np.flatnonzero(words.value[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1))
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array([lines[i] for i in at], pa.string())], names=["id", "line"])
    return run


def line_links(docs: DataFrame, edits: int = EDITS, refine_above: int = REFINE_ABOVE) -> tuple[DataFrame, DataFrame]:
    """(a, b): links that span the components of lines; (id, n_links): how many links a line has."""
    signed = docs.select("text").mapInArrow(_signed(edits), "key long, id long, index boolean")
    meets = Window.partitionBy("key")
    met = stored(signed.withColumn("least", F.min("id").over(meets)).withColumn("most", F.max("id").over(meets))
                 .withColumn("indexed", F.max("index").over(meets))
                 .where("indexed and least <> most").select("key", "id", "index"), "meetings")
    # the lines that meet others, by a filter of fixed size before their texts are shuffled
    bit = F.col("id").bitwiseAND(F.lit(FILTER_WORDS * 64 - 1).cast("long"))
    bits = met.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toArrow()
    words = np.zeros(FILTER_WORDS, np.uint64)
    words[bits["word"].to_numpy()] = bits["bits"].to_numpy().view(np.uint64)
    fetch = _fetcher(docs.sparkSession.sparkContext.broadcast(words))
    texts = stored(docs.select("text").mapInArrow(fetch, "id long, line string").groupBy("id").agg(
        F.min("line").alias("line")), "line-texts")
    rows = met.join(texts, "id").select("key", "id", "line", "index", F.lit(-1).alias("part"))

    def met_lines(rows: DataFrame, most: int | None) -> DataFrame:
        return stored(rows.repartition("key").sortWithinPartitions("key", F.desc("index"), "id").mapInArrow(
            _linker(edits, most), _LINKED), "line-links")

    linked = met_lines(rows, refine_above)
    anew = linked.where("line is not null").select("key", F.col("a").alias("id"), "line", "index", "part")
    if not anew.isEmpty():
        linked = linked.where("line is null").unionByName(met_lines(anew, None))
    return linked.where("b is not null").select("a", "b"), \
        linked.where("b is null and n is not null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n_links"))


def repeated_lines(docs: DataFrame, edits: int = EDITS, refine_above: int = REFINE_ABOVE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): which of its lines go.

    Columns: doc_id, text_hash, n_lines (with a word), n_links (of its lines to other distinct lines),
    removed_lines (numbers from 0, ascending), n_removed, and classes: of each line that is removed or
    linked its number, the class, the distinct line (a hash) and its links, so that every class can be
    put together from the result. Lines link if no more edits lie between them than :func:`allowed`
    says of the shorter one; of each class of linked lines the first goes on, by doc_id and line number. Null and empty texts have no lines; a null doc_id
    comes last; rows that share a doc_id are one document, so repeated rows fare alike; an empty table
    gives an empty result; further columns are not looked at.
    """
    if not 0 <= edits <= 7:
        raise ValueError("edits must be from 0 to 7")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("text_hash", F.xxhash64("text"))
    placed = stored(rows.mapInArrow(_placed, "doc_id long, text_hash long, no int, id long"), "line-places")
    pairs, degrees = line_links(rows, edits, refine_above)
    labels = components(pairs).select(F.col("node").alias("id"), "label")
    lines = placed.select("id").distinct().join(labels, "id", "left").join(degrees, "id", "left").select(
        "id", F.coalesce("label", "id").alias("class"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    lines = stored(lines, "line-classes")
    place = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), "no")
    first = placed.groupBy("id").agg(F.min(place).alias("own")).join(lines, "id").groupBy("class").agg(F.min("own").alias("first"))
    known = stored(lines.join(first, "class").select("id", "class", "n_links", "first"), "line-firsts")
    judged = placed.distinct().join(known, "id").withColumn("gone", place != F.col("first"))
    entry = F.struct("no", "class", F.col("id").alias("line"), "n_links")
    per = judged.groupBy("doc_id", "text_hash").agg(
        F.count("*").alias("n_lines"), F.sum("n_links").alias("n_links"),
        F.sort_array(F.collect_list(F.when(F.col("gone"), F.col("no")))).alias("removed_lines"),
        F.sort_array(F.collect_list(F.when(F.col("gone") | (F.col("n_links") > 0), entry))).alias("classes")) \
        .withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    zero = F.lit(0).cast("long")
    return rows.select("doc_id", "text_hash").join(
        per, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")), "left").select(
        "doc_id", "text_hash", F.coalesce("n_lines", zero).alias("n_lines"), F.coalesce("n_links", zero).alias("n_links"),
        F.coalesce("removed_lines", F.array().cast("array<int>")).alias("removed_lines"),
        F.coalesce("classes", F.array().cast("array<struct<no: int, class: bigint, line: bigint, n_links: bigint>>")).alias("classes")) \
        .withColumn("n_removed", F.size("removed_lines").cast("long"))


def without_repeats(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """``docs`` with the lines that go taken out of text; other columns as they are."""
    gone = repeated_lines(docs, edits).groupBy("doc_id", "text_hash").agg(F.first("removed_lines").alias("_gone")) \
        .withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    met = docs.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col("_doc"))
                    & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("_hash")))
    kept = F.array_join(F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains("_gone", i)), "\n")
    return met.select(*[kept.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
