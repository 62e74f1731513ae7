"""Phrase collocation mining by weighted acyclic automata.

Each task counts the phrases of one to three words of a chunk of texts. The sorted phrases become an
acyclic automaton whose arcs carry words and whose weights are counts (:class:`Transducer`), built
level by level as the sorted run leaves the states: a state that equals an earlier one, arcs, weights
and targets alike, is shared with it. The automaton is cut at prefix ranges of the sorted phrases, and
only these parts are shuffled. A task unites the parts of one range and sums their weights, which
gives the counts of the corpus there; phrases below the least count go. What the two sides of a cut
phrase count is found by composing the automaton of all asked sides of a range with the range's own.

Ranges are chosen on a sample of phrases so that each stands for about ``RANGE_BYTES`` of text; they
share out the work and do not change the result. A phrase that is frequent is one weight in each
chunk's automaton, and a frequent first word is cut into several ranges.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayline.llm.text import (BLOCK, LOWER, blocks, pack, pack_words, scramble, stored, unpack, unpack_words, utf8_bytes,
                              word_spans)

LEAST_COUNT = 10
CONTAINED = 50  # per cent of a phrase's count in a longer one, from which the phrase is dropped
TOP = 2000
CHUNK_BYTES = 8 << 20  # of text for one automaton
RANGE_BYTES = 10 << 20  # of text that a range stands for
FAN = 128  # parts that an automaton is cut into at once
MOST_RANGES = 1 << 20  # the list of bounds goes to each task
SAMPLE_POINTS = 200_000  # phrases that the bounds are chosen from, or eight a range
SALTS = 64
_SPLITS = np.zeros(256, bool)
_SPLITS[[*b".,;:!?", *range(10, 14)]] = True
_INSIDE = ~_SPLITS
_INSIDE[[32, 9]] = False
NO_LANG = "und"


@dataclass
class Phrases:
    """Sorted phrases as a tree: nodes of one, two and three words with their counts.

    ``lang`` and ``w1`` to ``w3`` are places in ``labels`` (sorted bytes), ``p2`` and ``p3`` places
    of the parents. A node without a count of its own is there for its children.
    """

    labels: pa.Array
    lang: np.ndarray
    w1: np.ndarray
    c1: np.ndarray
    p2: np.ndarray
    w2: np.ndarray
    c2: np.ndarray
    p3: np.ndarray
    w3: np.ndarray
    c3: np.ndarray

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ascending numbers of the nodes of each length."""
        return _key(self.lang, self.w1), _key(self.p2, self.w2), _key(self.p3, self.w3)

    def part(self, low: tuple[int, int, int], high: tuple[int, int, int]) -> Phrases:
        """The phrases from place ``low`` to ``high`` of each length, with the nodes above them."""
        (u0, b0, t0), (u1, b1, t1) = low, high
        b2 = (min(b0, int(self.p3[t0])), max(b1, int(self.p3[t1 - 1]) + 1)) if t0 < t1 else (b0, b1)
        u2 = (min(u0, int(self.p2[b2[0]])), max(u1, int(self.p2[b2[1] - 1]) + 1)) if b2[0] < b2[1] else (u0, u1)

        def counts(c: np.ndarray, most: tuple[int, int], own: tuple[int, int]) -> np.ndarray:
            c, at = c[slice(*most)].copy(), np.arange(*most)
            c[(at < own[0]) | (at >= own[1])] = 0
            return c

        u, b, t = slice(*u2), slice(*b2), slice(t0, t1)
        return Phrases(self.labels, self.lang[u], self.w1[u], counts(self.c1, u2, (u0, u1)), self.p2[b] - u2[0], self.w2[b],
                       counts(self.c2, b2, (b0, b1)), self.p3[t] - b2[0], self.w3[t], self.c3[t]).relabelled()

    def relabelled(self) -> Phrases:
        """With the labels that occur."""
        used = np.zeros(len(self.labels), bool)
        for x in (self.lang, self.w1, self.w2, self.w3):
            used[x] = True
        to = np.cumsum(used) - 1
        return Phrases(self.labels.filter(pa.array(used)), to[self.lang], to[self.w1], self.c1, self.p2, to[self.w2], self.c2,
                       self.p3, to[self.w3], self.c3)

    def at_least(self, least: int) -> Phrases:
        """The phrases of that count, with the nodes above them."""
        k3 = self.c3 >= least
        k2 = self.c2 >= least
        k2[self.p3[k3]] = True
        k1 = self.c1 >= least
        k1[self.p2[k2]] = True
        c1, c2 = np.where(self.c1 >= least, self.c1, 0), np.where(self.c2 >= least, self.c2, 0)
        return Phrases(self.labels, self.lang[k1], self.w1[k1], c1[k1], (np.cumsum(k1) - 1)[self.p2[k2]], self.w2[k2], c2[k2],
                       (np.cumsum(k2) - 1)[self.p3[k3]], self.w3[k3], self.c3[k3]).relabelled()

    def cuts(self, bounds: list[tuple[bytes, ...]]) -> list[tuple[int, int, int]]:
        """For each bound (language and up to three words), the first place of each length not below it."""
        labels = self.labels.to_pylist()
        k1, k2, k3 = self.keys()
        out = []
        for bound in bounds:
            at = [bisect_left(labels, x) for x in bound]
            met = [i < len(labels) and labels[i] == x for i, x in zip(at, bound)]
            u = int(np.searchsorted(k1, np.uint64((at[0] << 32) + (at[1] if met[0] and len(bound) > 1 else 0))))
            same = len(bound) > 1 and met[0] and met[1] and u < len(k1) and int(k1[u]) == (at[0] << 32) + at[1]
            longer = same and len(bound) > 2
            b = int(np.searchsorted(k2, np.uint64((u << 32) + (at[2] if longer else 0))))
            same = longer and met[2] and b < len(k2) and int(k2[b]) == (u << 32) + at[2]
            longest = same and len(bound) > 3
            t = int(np.searchsorted(k3, np.uint64((b << 32) + (at[3] if longest else 0))))
            out.append((u + longer, b + longest, t))
        return out

    def texts(self, length: int) -> tuple[pa.Array, pa.Array]:
        """Language and phrase of each node of two or three words."""
        one, two = self.w1[self.p2], self.w2
        lang, words = self.lang[self.p2], [one, two]
        if length == 3:
            lang, words = lang[self.p3], [one[self.p3], two[self.p3], self.w3]
        return tuple(x.cast(pa.string()) for x in (self.labels.take(pa.array(lang)),
                     pc.binary_join_element_wise(*[self.labels.take(pa.array(w)) for w in words], b" ")))


def _key(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (high.astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64)


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, their sums, and the place of each given key among them."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    firsts, place = np.flatnonzero(new), np.empty(len(keys), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    if counts is None:
        return keys[firsts], np.diff(np.append(firsts, len(keys))), place
    return keys[firsts], np.add.reduceat(counts[order], firsts) if len(firsts) else counts[:0], place


def _halves(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (keys >> np.uint64(32)).astype(np.int32), keys.astype(np.uint32).astype(np.int32)


def _in_order(words: pa.Array | pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The distinct words sorted, and the place of each given one among them."""
    found = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
    found = (found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found).dictionary_encode()
    order = pc.sort_indices(found.dictionary).to_numpy()
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    return found.dictionary.take(pa.array(order)), rank[found.indices.to_numpy()]


def tree(words: pa.Array, langs: np.ndarray, names: list[bytes], new: np.ndarray) -> Phrases:
    """All phrases of up to three words of a run of words; ``new`` marks the first word of each piece."""
    n = len(words)
    labels, ids = _in_order(pa.chunked_array([words, pa.array(names, pa.binary())]))
    lang, ids = ids[n:][langs], ids[:n]
    k1, c1, r1 = _summed(_key(lang, ids))
    goes_on = np.append(~new[1:], False) if n else new
    two = np.flatnonzero(goes_on)
    k2, c2, r2 = _summed(_key(r1[two], ids[two + 1]))
    further = goes_on[two + 1] if len(two) else goes_on[:0]
    k3, c3, _ = _summed(_key(r2[further], ids[two[further] + 2]))
    return Phrases(labels, *_halves(k1), c1, *_halves(k2), c2, *_halves(k3), c3)


def united(trees: list[Phrases]) -> Phrases:
    """All phrases of all trees, equal ones summed."""
    labels, ids = _in_order(pa.chunked_array([t.labels for t in trees], pa.binary()))
    starts = np.cumsum([0, *[len(t.labels) for t in trees]])
    to = [ids[a:b] for a, b in zip(starts, starts[1:])]

    def whole(values) -> np.ndarray:
        return np.concatenate(list(values))
    k1, c1, place = _summed(whole(_key(m[t.lang], m[t.w1]) for m, t in zip(to, trees)), whole(t.c1 for t in trees))
    first = np.cumsum([0, *[len(t.w1) for t in trees]])
    k2, c2, place = _summed(whole(_key(place[t.p2 + s], m[t.w2]) for m, t, s in zip(to, trees, first)), whole(t.c2 for t in trees))
    first = np.cumsum([0, *[len(t.w2) for t in trees]])
    k3, c3, _ = _summed(whole(_key(place[t.p3 + s], m[t.w3]) for m, t, s in zip(to, trees, first)), whole(t.c3 for t in trees))
    return Phrases(labels, *_halves(k1), c1, *_halves(k2), c2, *_halves(k3), c3)


def _expanded(states: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The arcs of the states one after another, and whose each is."""
    counts = sizes[states]
    ends = np.cumsum(counts)
    of = np.repeat(np.arange(len(states)), counts)
    return np.repeat((np.cumsum(sizes) - sizes)[states] - (ends - counts), counts) + np.arange(len(of)), of


def shared_states(sizes: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Equal states as one: the state that stands for each, and sizes and arcs of those that are left.

    States are compared by a hash of their arcs, then arc by arc.
    """
    ends = np.cumsum(sizes)
    starts = ends - sizes
    arcs = np.zeros(len(columns[0]), np.uint64)
    for x in columns:
        arcs = scramble(arcs + x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(arcs, dtype=np.uint64)])
    _, first, same = np.unique(scramble(sums[ends] - sums[starts] + sizes.astype(np.uint64)), return_index=True, return_inverse=True)
    like = first[same]
    wrong = sizes != sizes[like]
    at, of = _expanded(np.flatnonzero(~wrong), sizes)
    of = np.flatnonzero(~wrong)[of]
    twin = starts[like[of]] + at - starts[of]
    for x in columns:
        wrong[of[x[at] != x[twin]]] = True
    like[wrong] = np.flatnonzero(wrong)  # equal hashes, other arcs: a state of its own
    left, to = np.unique(like, return_inverse=True)
    at, _ = _expanded(left, sizes)
    return to, sizes[left], [x[at] for x in columns]


@dataclass
class Transducer:
    """An acyclic automaton from languages over words to counts; equal states are shared.

    Level 0 has the languages, levels 1 to 3 the words. ``s`` are the numbers of arcs of a level's
    states, ``w`` the labels, ``c`` the counts and ``t`` the target states.
    """

    labels: pa.Array
    w0: np.ndarray
    t0: np.ndarray
    s1: np.ndarray
    w1: np.ndarray
    c1: np.ndarray
    t1: np.ndarray
    s2: np.ndarray
    w2: np.ndarray
    c2: np.ndarray
    t2: np.ndarray
    s3: np.ndarray
    w3: np.ndarray
    c3: np.ndarray

    @classmethod
    def of(cls, tree: Phrases) -> Transducer:
        """States freeze from the last level up, as their targets must be known."""
        t2, s3, (w3, c3) = shared_states(np.bincount(tree.p3, minlength=len(tree.w2)), [tree.w3, tree.c3])
        t1, s2, (w2, c2, t2) = shared_states(np.bincount(tree.p2, minlength=len(tree.w1)), [tree.w2, tree.c2, t2])
        w0, sizes = np.unique(tree.lang, return_counts=True)
        t0, s1, (w1, c1, t1) = shared_states(sizes, [tree.w1, tree.c1, t1])
        return cls(tree.labels, w0, t0, s1, w1, c1, t1, s2, w2, c2, t2, s3, w3, c3)

    def tree(self) -> Phrases:
        at1, of = _expanded(self.t0, self.s1)
        lang = self.w0[of]
        at2, p2 = _expanded(self.t1[at1], self.s2)
        at3, p3 = _expanded(self.t2[at2], self.s3)
        return Phrases(self.labels, lang, self.w1[at1], self.c1[at1], p2, self.w2[at2], self.c2[at2], p3, self.w3[at3], self.c3[at3])

    def dumps(self) -> bytes:
        return pack([*pack_words(self.labels), *[getattr(self, f.name) for f in fields(self)[1:]]])

    @classmethod
    def loads(cls, data: bytes) -> Transducer:
        sizes, letters, *rest = unpack(data)
        return cls(unpack_words(sizes, letters), *[x.astype(np.int64) if f.name in ("c1", "c2", "c3") else x
                                                   for f, x in zip(fields(cls)[1:], rest)])


def composed(asked: Phrases, counts: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """The counts of the asked nodes of one and of two words, 0 where there are none."""
    place = {x: i for i, x in enumerate(counts.labels.to_pylist())}
    to = np.array([place.get(x, -1) for x in asked.labels.to_pylist()] or [-1], np.int64)
    k1, k2, _ = counts.keys()

    def met(keys: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        known = (high >= 0) & (low >= 0)
        want = _key(np.where(known, high, 0), np.where(known, low, 0))
        at = np.searchsorted(keys, want)
        known &= at < len(keys)
        known[known] = keys[at[known]] == want[known]
        return np.where(known, at, -1)

    one = met(k1, to[asked.lang], to[asked.w1])
    two = met(k2, one[asked.p2], to[asked.w2])
    return np.where(one >= 0, np.append(counts.c1, 0)[one], 0), np.where(two >= 0, np.append(counts.c2, 0)[two], 0)


class _Words:
    """The words of texts as they come, until a chunk is full."""

    def __init__(self):
        self.names: dict[bytes, int] = {}
        self.words, self.langs, self.new, self.size = [], [], [], 0

    def add(self, langs: list[str | None], texts: pa.Array) -> None:
        data, offsets = utf8_bytes(texts)
        codes = np.array([self.names.setdefault(x.encode(), len(self.names)) for x in (NO_LANG if x is None else x for x in langs)], np.int64)
        for first, last in blocks(offsets, 4 * BLOCK):
            part = LOWER[data[offsets[first]:offsets[last]]]
            rows = offsets[first:last + 1] - offsets[first]
            starts, ends, edges = word_spans(part, rows, _INSIDE)
            if not len(starts):
                continue
            pieces = np.cumsum(_SPLITS[part], dtype=np.int32)[starts]
            new = np.ones(len(starts), bool)
            new[1:] = pieces[1:] != pieces[:-1]
            new[edges[:-1][edges[:-1] < len(starts)]] = True
            kept = part[_INSIDE[part]]
            spans = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
            self.words.append(pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(spans.tobytes()), pa.py_buffer(kept.tobytes())]))
            self.langs.append(np.repeat(codes[first:last], np.diff(edges)))
            self.new.append(new)
        self.size += len(data)

    def tree(self) -> Phrases:
        words = pa.concat_arrays(self.words) if self.words else pa.array([], pa.binary())
        return tree(words, np.concatenate(self.langs) if self.langs else np.zeros(0, np.int64), list(self.names),
                    np.concatenate(self.new) if self.new else np.zeros(0, bool))


def _bounds(texts: DataFrame, range_bytes: int) -> list[tuple[bytes, ...]]:
    """Where the prefix ranges begin, from the phrases of a sample of texts."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = min(MOST_RANGES, -(-size // range_bytes))
    if ranges < 2:
        return []
    share = min(1.0, max(0.01, 4e6 / size))
    stride = max(8, int(size * share / 6 / max(SAMPLE_POINTS, 8 * ranges)))

    def run(batches):
        for batch in batches:
            held = _Words()
            held.add(batch.column(0).to_pylist(), batch.column(1))
            found = held.tree()
            for length, c in ((2, found.c2), (3, found.c3)):
                lang, phrase = found.texts(length)
                own = pa.array(np.arange(len(c)) % stride == length)
                yield pa.RecordBatch.from_arrays([lang.filter(own), phrase.filter(own)], names=["lang", "phrase"])

    points = texts.where(F.pmod(F.xxhash64("text"), F.lit(10_000)) < int(share * 10_000)).mapInArrow(run, "lang string, phrase string")
    found = sorted({(r.lang.encode(), *r.phrase.encode().split(b" ")) for r in points.collect()})
    return sorted({found[i * len(found) // ranges] for i in range(1, ranges)}) if found else []


def _cut(whole: Phrases, bounds: list[tuple[bytes, ...]], first: int) -> Iterator[tuple[int, bytes]]:
    """The automata of the parts between the bounds, numbered from ``first``; empty ones are left out."""
    ends = [(0, 0, 0), *whole.cuts(bounds), (len(whole.w1), len(whole.w2), len(whole.w3))]
    for i, (a, b) in enumerate(zip(ends, ends[1:])):
        if a != b:
            yield first + i, Transducer.of(whole.part(a, b)).dumps()


def _whole(parts: pa.ChunkedArray) -> Phrases:
    return united([Transducer.loads(x).tree() for x in parts.to_pylist()])


def _united_ranges(texts: DataFrame, bounds: list[tuple[bytes, ...]], least: int, chunk_bytes: int, fan: int) -> DataFrame:
    """(range, lang, n, phrases): words of each language, and the automaton of frequent phrases, by range.

    An automaton is cut into ``fan`` parts at most. Where there are more ranges, the parts of ``fan``
    (or its square, ...) neighbouring ranges are first united in as many batches as they have ranges,
    each of which is cut anew, so that no part gets small.
    """
    width = 1
    while (len(bounds) + 1) > fan * width:
        width *= fan

    def parts(batches):
        number = TaskContext.get().partitionId() * 7919

        def cut(held: _Words):
            found = list(_cut(held.tree(), bounds[width - 1::width], 0))
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()), pa.array([number % width] * len(found), pa.int32()),
                                              pa.array([x for _, x in found], pa.binary())], names=["range", "batch", "part"])
        held = _Words()
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                piece = batch.slice(i, 500)
                held.add(piece.column(0).to_pylist(), piece.column(1))
                if held.size >= chunk_bytes:
                    yield from cut(held)
                    held, number = _Words(), number + 1
        if held.size:
            yield from cut(held)

    def finer(wide: int, narrow: int):
        def run(table: pa.Table) -> pa.Table:
            at, batch = table.column("range")[0].as_py(), table.column("batch")[0].as_py()
            found = list(_cut(_whole(table.column("part")), bounds[at * wide + narrow - 1:(at + 1) * wide - 1:narrow], at * (wide // narrow)))
            return pa.table([pa.array([k for k, _ in found], pa.int32()), pa.array([batch % narrow] * len(found), pa.int32()),
                             pa.array([x for _, x in found], pa.binary())], names=["range", "batch", "part"])
        return run

    def unite(table: pa.Table) -> pa.Table:
        whole = _whole(table.column("part"))
        langs, at = np.unique(whole.lang, return_inverse=True)
        sums = np.zeros(len(langs), np.int64)
        np.add.at(sums, at, whole.c1)
        names = whole.labels.take(pa.array(langs)).cast(pa.string()).to_pylist()
        number = table.column("range")[0].as_py()
        return pa.table({"range": pa.array([number] * (len(langs) + 1), pa.int32()), "lang": pa.array([*names, None], pa.string()),
                         "n": pa.array([*sums.tolist(), None], pa.int64()),
                         "phrases": pa.array([*[None] * len(langs), Transducer.of(whole.at_least(least)).dumps()], pa.binary())})

    schema = "range int, batch int, part binary"
    dealt = texts.mapInArrow(parts, schema)
    while width > 1:
        dealt = dealt.groupBy("range", "batch").applyInArrow(finer(width, width // fan), schema)
        width //= fan
    return dealt.groupBy("range").applyInArrow(unite, "range int, lang string, n long, phrases binary")


def _candidates(ranges: DataFrame) -> DataFrame:
    """(lang, phrase, words, a): phrases of two and three words."""
    def run(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                found = Transducer.loads(data).tree()
                for length, c in ((2, found.c2), (3, found.c3)):
                    lang, phrase = found.texts(length)
                    own = pa.array(c > 0)
                    whole = pa.table([lang, phrase, pa.array(np.full(len(c), length, np.int32)), pa.array(c)],
                                     names=["lang", "phrase", "words", "a"]).filter(own)
                    yield from whole.to_batches(100_000)
    return ranges.where("phrases IS NOT NULL").select("phrases").mapInArrow(run, "lang string, phrase string, words int, a long")


def _looked_up(sides: DataFrame, ranges: DataFrame, bounds: list[tuple[bytes, ...]]) -> DataFrame:
    """(lang, side, f): counts of phrases of one and two words, each asked once."""
    def place(batches):
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            at = [bisect_right(bounds, (lang.encode(), *side.encode().split(b" "))) for lang, side in keys]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], names=["lang", "side", "place"])

    def look(asked: pa.Table, own: pa.Table) -> pa.Table:
        langs, sides = [x.encode() for x in asked.column("lang").to_pylist()], [x.encode().split(b" ") for x in asked.column("side").to_pylist()]
        names = {x: i for i, x in enumerate(dict.fromkeys(langs))}
        sizes = np.array([len(x) for x in sides])
        new = np.zeros(sizes.sum(), bool)
        new[np.cumsum(sizes) - sizes] = True
        asking = tree(pa.array([w for x in sides for w in x], pa.binary()), np.repeat([names[x] for x in langs], sizes), list(names), new)
        one, two = composed(asking, Transducer.loads(own.column("phrases")[0].as_py()).tree())
        rows = {}
        labels = asking.labels.to_pylist()
        for i, (lang, w) in enumerate(zip(asking.lang, asking.w1)):
            rows[labels[lang], labels[w]] = one[i]
        for i, (p, w) in enumerate(zip(asking.p2, asking.w2)):
            rows[labels[asking.lang[p]], labels[asking.w1[p]] + b" " + labels[w]] = two[i]
        found = [int(rows[lang, b" ".join(x)]) for lang, x in zip(langs, sides)]
        return pa.table([asked.column("lang"), asked.column("side"), pa.array(found, pa.int64())], names=["lang", "side", "f"])

    placed = sides.select("lang", "side").distinct().mapInArrow(place, "lang string, side string, place int")
    own = ranges.where("phrases IS NOT NULL").select("range", "phrases")
    return placed.groupBy("place").cogroup(own.groupBy("range")).applyInArrow(look, "lang string, side string, f long")


def collocations(docs: DataFrame, least: int = LEAST_COUNT, contained: int = CONTAINED, top: int = TOP,
                 chunk_bytes: int = CHUNK_BYTES, range_bytes: int = RANGE_BYTES, fan: int = FAN) -> DataFrame:
    """The first ``top`` phrases of two and three words of each language of ``docs`` (lang, text).

    Columns: lang, rank, phrase, a (its count), l and r (counts of the sides of its lowest-scoring
    cut), n (words of the language), score = floor(10^6 a^2 / (l r)), exact as long as counts stay
    below 10^16. Ranked by score and count, highest first, then by the bytes of the phrase. A phrase
    is dropped if a longer one of at least ``least`` occurrences holds it and has ``contained`` per
    cent of its count. A null language is ``und``, a null or empty text has no words, repeated rows
    count as often as they stand there; an empty table gives an empty result; further columns are not
    looked at.
    """
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = _bounds(texts, range_bytes)
    ranges = stored(_united_ranges(texts, bounds, least, chunk_bytes, fan), "phrase-ranges")
    totals = ranges.where("phrases IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    found = stored(_candidates(ranges), "phrase-candidates")

    words = F.split("phrase", " ")
    cut = F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice(words, F.lit(1), k), " ").alias("left"),
        F.array_join(F.slice(words, k + 1, F.col("words") - k), " ").alias("right")))
    cuts = found.select("lang", "phrase", "a", F.inline(cut))
    sides = cuts.select("lang", F.explode(F.array("left", "right")).alias("side"))
    known = stored(_looked_up(sides, ranges, bounds), "phrase-sides")
    both = cuts.join(known.select("lang", F.col("side").alias("left"), F.col("f").alias("l")), ["lang", "left"]) \
        .join(known.select("lang", F.col("side").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    exact = [F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")]
    both = both.withColumns({"_up": (exact[0] * exact[0] * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)"),
                             "_down": (exact[1] * exact[2]).cast("decimal(38,0)")}).withColumn("score", F.expr("_up div _down"))
    best = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = F.array(*[F.array_join(F.slice(words, i, 2), " ") for i in (1, 2)])
    longer = found.where("words = 3").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "a") \
        .groupBy("lang", "phrase").agg(F.max("a").alias("_most"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(F.col("_most").isNull() | (100 * F.col("_most") < contained * F.col("a")))

    flat = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    first = flat.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))) \
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
