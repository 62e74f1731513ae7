"""Scores under a language model that mixes hashed-context bit predictors by logistic mixing.

A text is its lowered words and an end. A token is spelled byte by byte and closed by a blank, or by a
line feed for the end. Each byte is spelled bit by bit in a code of four bits for the most usual bytes,
eight for others and sixteen for the rest. The probabilities of all tokens sum to one, less what the
longest code would give to usual bytes.
Each predictor counts zeros and ones in a hashed table, under the bits of the byte so far and its
own context: nothing, the last one, two, three or five bytes of the text, the token so far, or that
and the token before. Contexts run on from token to token and begin with the text. Their predictions
are mixed in the logistic domain with weights gated by the bits so far, and the mix is refined by a
table of gate and quantised prediction that adapts to what followed.

The counts are of all training texts, so they grow with the corpus until the tables are full; the
tables have a fixed size (``SLOT_BITS``) and are broadcast. Weights and refinement are learned from
all training texts too, each occurrence left out of the counts it meets: parts of the texts are gone
through online, each from the same start, and their weights are averaged by what they have seen. Then
every bit of every text is predicted where it stands. Last, the token's own count joins the mix, as a
fixed table cannot hold all tokens apart: counts less a discount, whose mass goes to the spelled
probability, and half of the whole goes to the spelled probability by itself, so the sum stays as it is.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayline.llm.language import held_out
from dayline.llm.text import LOWER, scramble, stored

TOKEN, PAIR = 255, 256
CONTEXTS = (0, 1, 2, 3, 5, TOKEN, PAIR)  # bytes of the text that a predictor looks back on; the token so far; that and the one before
SLOT_BITS = (10, 17, 18, 20, 21, 21, 21)
CHUNK_BYTES = 14 << 20
TASK_BYTES, TASKS = 32 << 20, 256  # of texts that a task counts; how many tasks do at most
TASK_TOKENS = 1_000_000  # of a part that is learned from
STEPS = 500  # of learning in a part, unless that is less than 600 or more than STEP bytes a step
STEP = 16384
RATE = 0.05
FIRST = 0.03  # what both counts start from: bits within a token mostly follow from its first
_BEGIN = ((0.25, 0.0), (0.13, 0.4), (0.05, 0.75), (0.01, 0.97))  # first weights by what the last context has seen
USUAL = b" eanirtosldhu\xc3cmgpfvbwyk.,\n\xa9zq"  # a code of four bits for 15 bytes, eight for 15 more; the code changes the cost, not what can be spelled
CODES = 3 + 16  # what four bits stand for: one of the first, one of the next, half a byte, the other half after each of these
NODES = CODES * 16
GATES = NODES * 16  # the bits so far, and how much the two last contexts have seen
TEXT_BYTES = 1 << 16  # of texts that are spelled at a time
END = b""
_STARTS = np.concatenate(([0], np.cumsum([1 << b for b in SLOT_BITS]))).astype(np.int64)
_SHIFTS = np.array([[68 - b] for b in SLOT_BITS], np.uint64)  # a block of 16 slots has four bits
_RANK = np.full(256, len(USUAL), np.uint8)
_RANK[list(USUAL)] = np.arange(len(USUAL))
_SYMBOLS = scramble(np.arange(1, 257, dtype=np.uint64))
_LOWER = LOWER.tobytes()
_CELLS, _LARGEST = 49, 12.0
_FINE = 256  # predictions are kept in tables as whole parts of this
_TEN, _HALF = np.log(10), np.log10(2)
_UNIT = 1 << 20  # sums of learning are rounded to its parts
_BLOCK = 4096  # numbers in a row of sums


def tokens(text: bytes) -> list[bytes]:
    return [*text.translate(_LOWER).split(), END]


def spell(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens spelled end to end, each as a text of its own, and their n + 1 offsets."""
    return _joined([w + b" " if w else b"\n" for w in words])


def spell_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of texts spelled end to end, and the n + 1 offsets of the texts."""
    return _joined([b" ".join([*text.translate(_LOWER).split(), b"\n"]) for text in texts])


def _joined(spelled: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.concatenate(([0], np.cumsum(np.fromiter(map(len, spelled), np.int64, len(spelled)))))
    return np.frombuffer(b"".join(spelled), np.uint8), offsets


def token_starts(data: np.ndarray) -> np.ndarray:
    """Where tokens begin: after each blank and line feed."""
    after = np.flatnonzero((data == 32) | (data == 10)) + 1
    return np.concatenate(([0], after[:-1])) if len(after) else after


def context_hashes(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each predictor a hash of its context at each byte; contexts do not cross texts."""
    n = len(data)
    place = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
    symbols = _SYMBOLS[data]
    out, h = [], np.zeros(n, np.uint64)
    for k in range(max(c for c in CONTEXTS if c < TOKEN) + 1):
        if k:
            earlier = np.zeros(n, np.uint64)
            earlier[k:] = symbols[:n - k]
            earlier[place < k] = 0
            h = (h + earlier) * np.uint64(0x9FB21C651E98DF25)
        if k in CONTEXTS:
            out.append(scramble(h + np.uint64(k + 1)))
    starts = token_starts(data)
    sizes = np.diff(np.append(starts, n))
    begins = np.repeat(starts, sizes)
    within = np.arange(n) - begins
    # a sum over the token so far, each byte by its place
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(
        symbols * scramble(np.arange(1, sizes.max(initial=0) + 1, dtype=np.uint64))[within], dtype=np.uint64)))
    so_far = sums[:-1] - sums[begins]
    before = np.zeros(len(starts), np.uint64)
    before[1:] = sums[starts[1:]] - sums[starts[:-1]]
    before[place[starts] == 0] = 0
    return [*out, scramble(so_far + np.uint64(TOKEN)), scramble(so_far + np.repeat(scramble(before + np.uint64(PAIR)), sizes))]


def fours(data: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[np.ndarray | slice, int | np.ndarray, np.ndarray, np.ndarray]]:
    """For each four bits of the code of bytes: which bytes have them, what they stand for, the four bits,
    and where the block of each predictor begins."""
    rank = _RANK[data].astype(np.int64)
    next_, rest = np.flatnonzero(rank >= 15), np.flatnonzero(rank >= 30)
    high, low = data[rest].astype(np.int64) >> 4, data[rest].astype(np.int64) & 15
    for where, code, four in ((slice(None), 0, np.minimum(rank, 15)), (next_, 1, np.minimum(rank[next_] - 15, 15)),
                              (rest, 2, high), (rest, 3 + high, low)):
        if len(four):
            base = ((hashes[:, where] + np.asarray(code).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) >> _SHIFTS).view(np.int64)
            base <<= 4
            base += _STARTS[:-1, None]
            yield where, code, four, base


def bits(data: np.ndarray, hashes: np.ndarray) -> Iterator[tuple]:
    """For each bit of the code of bytes: which bytes have it, the bit, the node of those before it, and a
    predictor's block and slot in it."""
    for where, code, four, base in fours(data, hashes):
        within = np.ones(len(four), np.int64)
        for b in (3, 2, 1, 0):
            bit = four >> b & 1
            yield where, bit, code * 16 + within, base, within
            within = within * 2 + bit


def _hashed(data: np.ndarray, offsets: np.ndarray, step: int = STEP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Steps of bytes with the hashes of their contexts, a row for each predictor."""
    hashes = np.stack(context_hashes(data, offsets))
    for at in range(0, len(data), step):
        yield data[at:at + step], hashes[:, at:at + step]


def _some(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All texts spelled, some at a time."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= TEXT_BYTES or i + 1 == len(texts):
            yield spell_texts(texts[first:i + 1])
            first, size = i + 1, 0


def add_fours(data: np.ndarray, offsets: np.ndarray, times: np.ndarray | None, counts: np.ndarray) -> None:
    """Adds how often each four bits follow in each block of slots; texts count ``times``."""
    often = None if times is None else np.repeat(times, np.diff(offsets))
    at = 0
    for part, hashes in _hashed(data, offsets):
        for where, _, four, base in fours(part, hashes):
            base += four
            np.add.at(counts, base.ravel(), 1 if often is None else np.tile(often[at:at + len(part)][where], len(base)))
        at += len(part)


def by_bit(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones by slot from how often each four bits follow in a block."""
    zeros, ones = (np.zeros((len(counts) // 16, 16), np.float32) for _ in range(2))
    for level in range(4):
        nodes = counts.reshape(-1, 1 << level, 2, 8 >> level).sum(axis=3)
        zeros[:, 1 << level:2 << level], ones[:, 1 << level:2 << level] = nodes[..., 0], nodes[..., 1]
    return zeros.ravel(), ones.ravel()


def bit_counts(words: list[bytes], times: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> None:
    """Adds to the zeros and ones by slot those of tokens by themselves that occur ``times`` often."""
    counts = np.zeros(_STARTS[-1], np.int64)
    add_fours(*spell(words), np.asarray(times, np.int64), counts)
    more = by_bit(counts)
    zeros += more[0]
    ones += more[1]


def packed(zeros: np.ndarray, ones: np.ndarray, n: np.ndarray) -> np.ndarray:
    """By slot the prediction in the logistic domain, and in the last two bits how much it has seen, in four steps."""
    stretched = np.clip(np.rint(np.log((ones + FIRST) / (zeros + FIRST)) * _FINE), -4000, 4000).astype(np.int16) * 4
    return stretched + (n > 0.5) + (n > 3.5) + (n > 30.5)


def _squash(x):
    return 1 / (1 + np.exp(-x))


def _cells(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lower cell of each prediction, none beyond ``_LARGEST``, and the part of the way to the next."""
    at = (x + np.float32(_LARGEST)) * np.float32((_CELLS - 1) / (2 * _LARGEST))
    low = np.minimum(at.astype(np.int64), _CELLS - 2)
    return low, at - low


def _start() -> tuple[np.ndarray, np.ndarray]:
    """First weights by gate, and ones and all by gate and cell as if a few had been seen."""
    weights = np.empty((GATES, len(CONTEXTS)))
    for level, (rest, whole) in enumerate(_BEGIN):
        at = np.arange(GATES) // NODES % 4 == level
        weights[at, :-1], weights[at, -1] = rest, whole
    centres = _squash(np.linspace(-_LARGEST, _LARGEST, _CELLS))
    return weights, np.tile(np.stack((centres, np.ones(_CELLS))) * 8, (GATES, 1, 1))


def apart(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """What an occurrence meets that does not see itself: by slot with a zero to come (one zero less), then
    with a one (one one less)."""
    n = zeros + ones - 1
    return np.concatenate((packed(np.maximum(zeros - 1, 0), ones, n), packed(zeros, np.maximum(ones - 1, 0), n)))


def _met(table: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Predictions in parts of ``_FINE``, and by how much the two last contexts have seen the level."""
    found = np.take(table, slots, mode="clip")
    level = (found[-1] & 3) + 4 * (found[-2] & 3)
    return (found >> 2).astype(np.float32), level.astype(np.int64)


def _mixed(x: np.ndarray, weights: np.ndarray, gate: np.ndarray) -> np.ndarray:
    mixed = x[0] * np.take(weights[0], gate, mode="clip")
    for xi, wi in zip(x[1:], weights[1:]):
        mixed += xi * np.take(wi, gate, mode="clip")
    return np.clip(mixed, -_LARGEST, _LARGEST, out=mixed)


def gone_through(steps: Iterable[tuple[np.ndarray, np.ndarray]], without: np.ndarray) -> np.ndarray:
    """What learning online from steps of bytes and their hashes adds up to.

    Three tables end to end: by gate its weights times the bits they were learned from, those bits, and
    by gate the ones and all by cell.
    """
    n_slots = len(without) // 2
    weights = np.ascontiguousarray(_start()[0].T, np.float32)
    squares, seen_bits, seen = np.full(weights.shape, 1e-4), np.zeros(GATES), np.zeros(GATES * _CELLS * 2)
    for data, hashes in steps:
        for _, bit, node, base, within in bits(data, hashes):
            x, level = _met(without, base + (within + bit * n_slots))
            x *= np.float32(1 / _FINE)
            gate = level * NODES + node
            mixed = _mixed(x, weights, gate)
            off = (bit - _squash(mixed)).astype(np.float64)
            n = np.bincount(gate, minlength=GATES)
            at = np.flatnonzero(n)
            step = np.stack([np.bincount(gate, off * xi, GATES)[at] for xi in x]) / n[at]
            squares[:, at] += step * step
            weights[:, at] += RATE * step / np.sqrt(squares[:, at])
            seen_bits += n
            low, far = _cells(mixed)
            cell = (gate * _CELLS + low) * 2 + bit
            far = far.astype(np.float64)
            np.add.at(seen, cell, 1 - far)
            np.add.at(seen, cell + 2, far)
    seen = seen.reshape(GATES, _CELLS, 2)
    seen = np.stack((seen[..., 1], seen.sum(axis=2)), axis=1)
    return np.concatenate([(weights * seen_bits).T.ravel(), seen_bits, seen.ravel()])


def learned(sums: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> dict:
    """The model from what :func:`gone_through` gives, summed over all parts."""
    k = GATES * len(CONTEXTS)
    weights, seen = _start()
    by_bits, n, more = sums[:k].reshape(GATES, -1), sums[k:k + GATES], sums[k + GATES:].reshape(seen.shape)
    met = n > 0
    weights[met] = by_bits[met] / n[met, None]
    seen = seen + more
    return {"weights": weights.astype(np.float32), "refined": (seen[:, 0] / seen[:, 1]).astype(np.float32),
            "table": packed(zeros, ones, zeros + ones)}


def learn(texts: list[bytes], zeros: np.ndarray, ones: np.ndarray, step: int = 600) -> dict:
    """Weights by gate and the refinement from texts in turn, in one part."""
    steps = (x for some in _some(texts) for x in _hashed(*some, step))
    return learned(gone_through(steps, apart(zeros, ones)), zeros, ones)


def learned_parts(texts: list[bytes], without: np.ndarray, most: int) -> np.ndarray:
    """What learning from texts adds up to, in parts of about ``most`` tokens, as whole numbers."""
    # in an order by hash, so that parts are like each other and the same in each run
    texts, parts, size = sorted(texts, key=lambda t: (zlib.crc32(t), t)), [[]], 0
    for text in texts:
        if size >= most:
            parts.append([])
            size = 0
        parts[-1].append(text)
        size += len(text.split()) + 1
    total = np.zeros(GATES * (len(CONTEXTS) + 1 + 2 * _CELLS), np.int64)
    for part in parts:
        step = min(STEP, max(600, sum(map(len, part)) // STEPS))
        steps = (x for some in _some(part) for x in _hashed(*some, step))
        total += np.rint(gone_through(steps, without) * _UNIT).astype(np.int64)
    return total


def byte_scores(data: np.ndarray, offsets: np.ndarray, model: dict) -> np.ndarray:
    """log10 of each byte's probability after what stands before it in its text."""
    out, table, refined = [np.zeros(0)], model["table"], model["refined"].ravel()
    weights = np.ascontiguousarray(model["weights"].T / np.float32(_FINE))
    for part, hashes in _hashed(data, offsets):
        total = np.ones(len(part))
        for where, bit, node, base, within in bits(part, hashes):
            x, level = _met(table, base + within)
            gate = level * NODES + node
            mixed = _mixed(x, weights, gate)
            low, far = _cells(mixed)
            low += gate * _CELLS
            p = np.take(refined, low, mode="clip")
            p += (np.take(refined, low + 1, mode="clip") - p) * far
            p = np.clip((_squash(mixed) + p) * np.float32(0.5), 1e-6, 1 - 1e-6)
            total[where] *= np.abs((1 - bit) - p.astype(np.float64))
        out.append(np.log10(total))
    return np.concatenate(out)


def token_scores(words: list[bytes], model: dict) -> np.ndarray:
    """log10 of the probability of each of some tokens as the first of a text."""
    out = [np.zeros(0)]
    for at in range(0, len(words), 20_000):
        data, offsets = spell(words[at:at + 20_000])
        out.append(np.add.reduceat(byte_scores(data, offsets, model), offsets[:-1]))
    return np.concatenate(out)


def text_scores(texts: list[bytes], model: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """log10 of the probability of each token of texts where it stands, some texts at a time, and how many tokens each has."""
    for data, offsets in _some(texts):
        starts = token_starts(data)
        yield np.add.reduceat(byte_scores(data, offsets, model), starts), np.diff(np.searchsorted(starts, offsets))


def discount(once: int, twice: int) -> float:
    """What is taken off each count, from how many tokens occur once and twice."""
    return min(max(once / (once + 2 * twice), 0.1), 0.95) if once else 0.5


def with_counts(spelled: np.ndarray, c: np.ndarray, n: int, v: int, off: float) -> np.ndarray:
    """log10 of each token's probability from its spelled one and its count of ``n``, of ``v`` tokens."""
    if not n:
        return spelled
    with np.errstate(divide="ignore"):
        own = np.log(np.maximum(c - off, 0) / n)
    return np.logaddexp(own, np.log(off * v / n) + spelled * np.log(10)) / np.log(10)


def _texts(table: pa.Table | pa.RecordBatch) -> list[bytes]:
    return [x or b"" for x in table["text"].to_pylist()]


def _rows_of(sums: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Blocks of whole numbers that are not all zero, in as few bytes as hold them."""
    for block, at in enumerate(range(0, len(sums), _BLOCK)):
        part = sums[at:at + _BLOCK]
        if part.any():
            largest = np.abs(part).max()
            yield block, part.astype("<i2" if largest < 1 << 15 else "<i4" if largest < 1 << 31 else "<i8").tobytes()


def _numbers(block: int, sums: bytes, size: int) -> np.ndarray:
    n = min(_BLOCK, size - block * _BLOCK)
    return np.frombuffer(sums, f"<i{len(sums) // n}").astype(np.int64)


def summed(rows: DataFrame, size: int) -> np.ndarray:
    """All rows (block, sums) added up: ``size`` whole numbers, whatever the corpus."""
    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        total = sum(_numbers(key[0].as_py(), x.as_py(), size) for x in table["sums"])
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([total.astype("<i8").tobytes()], pa.binary())})

    out = np.zeros(size, np.int64)
    for row in rows.groupBy("block").applyInArrow(add, "block int, sums binary").toLocalIterator():
        at = row["block"] * _BLOCK
        out[at:at + _BLOCK] = _numbers(row["block"], row["sums"], size)
    return out


def _text_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by slot of the task's texts."""
    counts = np.zeros(_STARTS[-1], np.int64)
    for batch in batches:
        for data, offsets in _some(_texts(batch)):
            add_fours(data, offsets, None, counts)
    for block, sums in _rows_of(counts):
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([sums], pa.binary())], names=["block", "sums"])


def tables(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones by slot of all training texts (text), of about ``size`` bytes."""
    tasks = max(1, min(TASKS, -(-size // TASK_BYTES)))
    counts = summed(texts.coalesce(tasks).mapInArrow(_text_counts, "block int, sums binary"), _STARTS[-1])
    return by_bit(counts)


def fit(parts: DataFrame, zeros: np.ndarray, ones: np.ndarray) -> dict:
    """The model from what learning from all training texts has added up to (block, sums)."""
    return learned(summed(parts, GATES * (len(CONTEXTS) + 1 + 2 * _CELLS)) / _UNIT, zeros, ones)


def score(docs: DataFrame, modulus: int = 7, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its scores under the base and the mixed model.

    Columns: doc_id, held_out, n_bytes, n_tokens, n_known, train_tokens, base_score (log10, unigram
    with one added), score (log10, mixed) and bits_per_byte (null without bytes). Learned from rows
    that are not held out. A null or empty text is its end alone; with nothing to learn from all bits
    are equally likely. Repeated rows score alike and count each; a null doc_id counts as an empty id;
    an empty table gives an empty result; further columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                       held_out(F.col("doc_id"), modulus).alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    chunks = max(1, -(-size // chunk_bytes))
    # texts go to chunks by their own hash as well, so that rows of one id spread
    spread = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("long"))
    context = docs.sparkSession.sparkContext
    zeros, ones = tables(rows.where(~F.col("held_out")).select("text"), size)
    others, most = context.broadcast(apart(zeros, ones)), TASK_TOKENS

    def chunk_tokens(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """The distinct tokens of a chunk with how often training documents have them, and what is learned from these."""
        times: Counter = Counter()
        taught = []
        for text, out in zip(_texts(table), table["held_out"].to_pylist()):
            found = tokens(text)
            times.update(dict.fromkeys(found, 0) if out else found)
            if not out:
                taught.append(text)
        parts = [*_rows_of(learned_parts(taught, others.value, most))]
        return pa.table({"chunk": pa.array([key[0].as_py()] * (len(times) + len(parts)), pa.int64()),
                         "token": pa.array([*times, *[None] * len(parts)], pa.binary()),
                         "n": pa.array([*times.values(), *[None] * len(parts)], pa.int64()),
                         "block": pa.array([*[None] * len(times), *(b for b, _ in parts)], pa.int32()),
                         "sums": pa.array([*[None] * len(times), *(x for _, x in parts)], pa.binary())})

    found = stored(spread.select("chunk", "text", "held_out").groupBy("chunk").applyInArrow(
        chunk_tokens, "chunk long, token binary, n long, block int, sums binary"), "chunk-tokens")
    seen = found.where("token IS NOT NULL").select("chunk", "token", "n")
    counts = stored(seen.groupBy("token").agg(F.sum("n").alias("c")), "tokens")
    total = counts.agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v"),
                       F.count_if(F.col("c") == 1).alias("once"), F.count_if(F.col("c") == 2).alias("twice")).first()
    n, v = total["n"] or 0, total["v"] or 0
    off = discount(total["once"], total["twice"])
    model = context.broadcast(fit(found.where("block IS NOT NULL").select("block", "sums"), zeros, ones))

    def documents(key: tuple[pa.Scalar, ...], texts: pa.Table, known: pa.Table) -> pa.Table:
        place = {t: i for i, t in enumerate(known["token"].to_pylist())}
        counted = known["c"].to_numpy()
        added = np.log10(counted + 1.0)
        out, all_texts = [], _texts(texts)
        for spelled, sizes in text_scores(all_texts, model.value):
            some = all_texts[len(out):len(out) + len(sizes)]
            at = np.fromiter((place[w] for text in some for w in tokens(text)), np.int64, len(spelled))
            c = counted[at]
            both = np.logaddexp(with_counts(spelled, c, n, v, off) * _TEN, spelled * _TEN) / _TEN - _HALF
            begins = np.cumsum(sizes) - sizes
            ways = (sizes, np.add.reduceat((c > 0).astype(np.int64), begins), np.add.reduceat(added[at], begins), np.add.reduceat(both, begins))
            out += [(len(text), int(m), int(k), float(base - m * np.log10(n + v + 1.0)), float(p)) for text, m, k, base, p in zip(some, *ways)]
        columns = list(zip(*out)) if out else [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table({"doc_id": texts["doc_id"], "held_out": texts["held_out"]} | {
            name: pa.array(values, kind) for name, values, kind in
            zip(("n_bytes", "n_tokens", "n_known", "base_score", "score"), columns, kinds)})

    held = seen.select("chunk", "token").join(counts, "token")
    result = spread.groupBy("chunk").cogroup(held.groupBy("chunk")).applyInArrow(
        documents, "doc_id long, held_out boolean, n_bytes long, n_tokens long, n_known long, base_score double, score double")
    return result.withColumn("train_tokens", F.lit(n).cast("long")).withColumn("bits_per_byte", F.when(
        F.col("n_bytes") > 0, F.col("score") / F.col("n_bytes") / F.lit(-np.log10(2.0))))
