"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over bytes, of order ``ORDER``. It is fitted on every distinct trusted text that is not kept
out, whole. Its tables, which are broadcast, have a row for each n-gram seen, not for each place: of bytes
there are far fewer of them, and more text adds ever fewer. Counts, continuation counts, context totals and the interpolation are joins of
tables sharded by n-gram and context. Every document is scored as a whole against these tables
inside its map task; joining the n-grams of all documents by shuffle instead would write several
times the corpus. Trusted texts that are kept out of the model give each language's
bounds, above and below, from quantiles of what they score. The fewer a language has, the more its
bounds come from those of all languages together, and its middle from all its distinct texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayline.llm.text import blocks, by_batch, split_by_ids, stored, unit_hash, utf8_bytes

ORDER = 5
COUNT_BYTES = 1 << 21  # of text whose n-grams a task sorts at a time
HELD_OUT = 5  # one of so many trusted texts is kept out of the model and calibrates the bounds
TAIL = 0.05  # the part of them beyond each of the quantiles that bounds are derived from
REACH = 3.0  # bounds lie so many times as far from the median as those quantiles
SETTLED = 50.0  # the root of the bytes from which scores vary hardly less with length
PRIOR = 10.0  # what is known of all languages counts like so many texts kept out of a language
WIDE = 8.0  # the least width of those bounds of all languages
BROADCAST_LANGS = 10_000  # thresholds of more languages are joined by shuffle
PAD = 10  # the byte that stands before a text


def kept_out(text_hash: Column) -> Column:
    """Whether a trusted text, with all its copies, calibrates the bounds instead of being in the model."""
    return unit_hash("calibrate", text_hash) % HELD_OUT == 0


def _named(lang: Column) -> Column:
    """A null language as a name of its own, so that joins keep it."""
    return F.when(lang.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), lang))


def trusted(labels: DataFrame) -> DataFrame:
    """(doc_id): labelled quality 1 and not toxic."""
    return labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).select("doc_id").distinct()


def trusted_sample(docs: DataFrame, labels: DataFrame, sample_docs: int | None = None) -> DataFrame:
    """(text): all distinct trusted texts of each language that are not kept out, of any length.

    With ``sample_docs`` only so many of each language, the least by hash; the classifier takes all.
    """
    hashed = docs.where(F.octet_length("text") > 0).select(
        "doc_id", _named(F.col("lang")).alias("name"), "text", F.xxhash64("text").alias("_hash")).where(~kept_out(F.col("_hash")))
    chosen = hashed.select("doc_id", "name", "_hash").join(trusted(labels), "doc_id", "left_semi").groupBy("name", "_hash").agg(
        F.min("doc_id").alias("doc_id"))
    if sample_docs is not None:
        turn = F.row_number().over(Window.partitionBy("name").orderBy(unit_hash("trust", F.col("_hash")), "_hash"))
        chosen = chosen.withColumn("turn", turn).where(F.col("turn") <= sample_docs)
    keys = ["doc_id", "name", "_hash"]
    chosen = stored(chosen.select(*keys), "chosen")
    # a filter of fixed size goes before the texts are shuffled; what it lets through is then joined
    texts = split_by_ids(hashed, chosen, *keys).where("may").groupBy(*keys).agg(F.min("text").alias("text"))
    return texts.join(chosen, keys, "left_semi").select("text")


def _grams(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """The n-gram that ends at each byte, as a number; a text is preceded by padding."""
    rows, pad = np.diff(offsets), order - 1
    padded = np.full(len(data) + pad * len(rows), PAD, np.uint64)
    at = np.arange(len(data)) + np.repeat(np.arange(1, len(rows) + 1) * pad, rows)
    padded[at] = data
    keys = np.zeros(len(data), np.uint64)
    for k in range(pad, -1, -1):
        keys = (keys << np.uint64(8)) | padded[at - k]
    return keys


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_bytes(batch.column("text"))
            for a, b in blocks(offsets, COUNT_BYTES):
                keys, n = np.unique(_grams(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], order),
                                    return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))],
                                                 names=["gram", "n"])
    return run


def _discounts(counts: DataFrame) -> list[float]:
    """The three discounts of modified Kneser-Ney from the counts of counts."""
    row = counts.agg(*[F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n = [float(row[f"n{k}"] or 0) for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    raw = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.5 * k for k in (1, 2, 3)]
    return [min(max(d, 0.1 * k), 0.95 * k) for k, d in enumerate(raw, 1)]


def kneser_ney(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """The model as rows (level, kind, key, value): log10 probability of each n-gram seen ('p') and
    log10 weight of the shorter context for each context seen ('b')."""
    counts = stored(texts.select("text").mapInArrow(_count(order), "gram long, n long")
                    .groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    levels = {order: counts}
    for level in range(order - 1, 0, -1):  # in how many contexts one byte longer it was seen
        suffix = F.col("gram").bitwiseAND(F.lit((1 << 8 * level) - 1).cast("long"))
        levels[level] = stored(levels[level + 1].groupBy(suffix.alias("gram")).agg(F.count("*").alias("n")), "grams")
    parts, lower = [], None
    for level in range(1, order + 1):
        d = _discounts(levels[level])
        cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        rows = levels[level].withColumn("context", F.shiftright("gram", 8)).withColumn("cut", cut)
        contexts = rows.groupBy("context").agg(F.sum("n").alias("total"), F.sum("cut").alias("freed")) \
            .select("context", "total", (F.col("freed") / F.col("total")).alias("weight"))
        rows = rows.join(contexts, "context").withColumn(
            "suffix", F.col("gram").bitwiseAND(F.lit((1 << 8 * (level - 1)) - 1).cast("long")))
        rows = rows.withColumn("shorter", F.lit(1 / 256)) if lower is None else \
            rows.join(lower, "suffix").withColumn("shorter", F.col("p"))
        p = (F.col("n") - F.col("cut")) / F.col("total") + F.col("weight") * F.col("shorter")
        solved = stored(rows.select("gram", p.alias("p"), "context", "weight"), "solved")
        lower = solved.select(F.col("gram").alias("suffix"), "p")
        parts.append(solved.select(F.lit(level).alias("level"), F.lit("p").alias("kind"), F.col("gram").alias("key"),
                                   F.log10("p").alias("value")))
        parts.append(solved.select(F.lit(level).alias("level"), F.lit("b").alias("kind"), F.col("context").alias("key"),
                                   F.log10("weight").alias("value")).distinct())
    model = parts[0]
    for part in parts[1:]:
        model = model.unionByName(part)
    return model


def _tables(model: DataFrame) -> dict:
    """Sorted keys and values by (kind, level)."""
    of = 2 * F.col("level") + (F.col("kind") == "b").cast("int")
    rows = model.select(of.cast("byte").alias("of"), "key", F.col("value").cast("float").alias("value")).toArrow()
    of, key, value = (rows[c].to_numpy() for c in ("of", "key", "value"))
    out = {}
    for k in np.unique(of).tolist():
        at = np.flatnonzero(of == k)
        at = at[np.argsort(key[at])]
        out["pb"[k % 2], k // 2] = key[at].astype(np.uint64), value[at]
    return out


def byte_scores(keys: np.ndarray, tables: dict, order: int) -> np.ndarray:
    """log10 P(byte | bytes before) for each n-gram."""
    def find(table, wanted):
        known, value = table
        if not len(known):
            return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.float32)
        at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        return known[at] == wanted, value[at]

    none = np.zeros(0, np.uint64), np.zeros(0, np.float32)
    out = np.zeros(len(keys), np.float32)
    open_, gathered, wanted = np.arange(len(keys)), np.zeros(len(keys), np.float32), keys
    for level in range(order, 0, -1):
        wanted = wanted & np.uint64((1 << 8 * level) - 1)
        hit, value = find(tables.get(("p", level), none), wanted)
        out[open_[hit]] = gathered[hit] + value[hit]
        open_, gathered, wanted = open_[~hit], gathered[~hit], wanted[~hit]
        known, value = find(tables.get(("b", level), none), wanted >> np.uint64(8))
        gathered = gathered + np.where(known, value, 0).astype(np.float32)
    out[open_] = gathered - np.float32(np.log10(256))
    return out


def scored(docs: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """``docs`` with n_bytes, log_prob (log10) and bits (a byte; null for a text without bytes)."""
    tables = docs.sparkSession.sparkContext.broadcast(_tables(model))

    def setup():
        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            data, offsets = utf8_bytes(batch.column("text"))
            sums = [np.zeros(0)]
            for a, b in blocks(offsets):
                ends = offsets[a:b + 1] - offsets[a]
                scores = byte_scores(_grams(data[offsets[a]:offsets[b]], ends, order), tables.value, order)
                total = np.concatenate(([0.0], np.cumsum(scores, dtype=np.float64)))
                sums.append(total[ends[1:]] - total[ends[:-1]])
            n, sums = np.diff(offsets), np.concatenate(sums)
            bits = sums / np.maximum(n, 1) / -np.log10(2.0)
            return [pa.array(n.astype(np.int64)), pa.array(sums), pa.array(bits, mask=n == 0)]
        return make

    return by_batch(docs, setup, [T.StructField("n_bytes", T.LongType()), T.StructField("log_prob", T.DoubleType()),
                                  T.StructField("bits", T.DoubleType())])


def _width(n_bytes: Column) -> Column:
    """How much scores of texts of this length vary, up to a factor."""
    return 1 / F.sqrt(F.greatest(n_bytes, F.lit(1))) + 1 / SETTLED


def _settled(n: Column, own: Column, prior: Column) -> Column:
    """What ``n`` texts say, the less of it the fewer they are."""
    n = F.coalesce(n, F.lit(0))
    return (n * F.coalesce(own, F.lit(0.0)) + PRIOR * prior) / (n + PRIOR)


def bounds(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """(name, middle, below, above) of each language of ``scores`` (name, doc_id, _hash, n_bytes, bits).

    A text may have middle + above * width(bytes) bits at most and middle + below * width(bytes) at
    least. middle is the median of the language's texts that are kept out, and below and above are
    ``REACH`` times what a ``TAIL`` of them exceeds. With ``n`` such texts each counts n times, and
    ``PRIOR`` times what stands in for it: the median of all texts of the language, and the bounds
    from the texts kept out of all languages, ``WIDE`` at least, as one language may vary more than
    others and is less well known to the model. Copies, which have one ``_hash``, count once.
    """
    some = scores.where("bits is not null")
    once = [F.min("bits").alias("bits"), F.min("n_bytes").alias("n_bytes")]
    median = F.percentile_approx("bits", 0.5, 10_000)
    held = stored(some.where(kept_out(F.col("_hash"))).join(trusted(labels), "doc_id", "left_semi")
                  .groupBy("name", "_hash").agg(*once), "kept-out")
    own = held.groupBy("name").agg(F.count("*").alias("n"), median.alias("own"))
    middles = stored(some.groupBy("name", "_hash").agg(*once).groupBy("name").agg(median.alias("all")).join(own, "name", "left").select(
        "name", "n", _settled(F.col("n"), F.col("own"), F.col("all")).alias("middle")), "middles")
    away = held.join(middles, "name").withColumn("away", (F.col("bits") - F.col("middle")) / _width(F.col("n_bytes")))
    tails = F.percentile_approx("away", [TAIL, 1 - TAIL], 10_000).alias("q")  # null without rows
    low, high = away.agg(tails).first()["q"] or (0.0, 0.0)
    pooled = min(REACH * low, -WIDE), max(REACH * high, WIDE)
    return middles.join(away.groupBy("name").agg(tails), "name", "left").select("name", "middle", *[
        _settled(F.col("n"), REACH * F.col("q")[i], F.lit(pooled[i])).alias(c) for i, c in enumerate(("below", "above"))])


def classify(docs: DataFrame, labels: DataFrame, carry: bool = False, order: int = ORDER) -> DataFrame:
    """(doc_id, lang, n_bytes, bits, threshold, accepted) for each row of ``docs``; with ``carry`` all
    its columns besides.

    ``labels`` has doc_id, quality and toxic. The most bits, threshold, and the least come from
    :func:`bounds`. Null and empty texts have no bits and are not accepted. A null language is a
    language of its own. Without any trusted row all bytes are equally likely, so all texts score
    alike and are accepted. Repeated rows are judged alike; an empty table gives an empty result;
    columns with the new names are replaced.
    """
    model = kneser_ney(trusted_sample(docs, labels), order)
    rows = docs if carry else docs.select("doc_id", "lang", "text")
    scores = scored(rows.withColumn("_hash", F.xxhash64("text")), model, order)
    scores = stored(scores if carry else scores.drop("text"), "scores")
    named = scores.select(_named(F.col("lang")).alias("name"), "doc_id", "_hash", "n_bytes", "bits")
    levels = stored(bounds(named, labels).withColumnsRenamed({c: f"_{c}" for c in ("name", "middle", "below", "above")}), "levels")
    if levels.count() <= BROADCAST_LANGS:
        levels = F.broadcast(levels)
    width = _width(F.col("n_bytes"))
    judged = scores.withColumn("_name", _named(F.col("lang"))).join(levels, "_name", "left").withColumn(
        "threshold", F.col("_middle") + F.col("_above") * width).withColumn(
        "accepted", F.coalesce(F.col("bits").between(F.col("_middle") + F.col("_below") * width, F.col("threshold")), F.lit(False))).drop(
        "_name", "_hash", "_middle", "_below", "_above")
    return judged if carry else judged.select("doc_id", "lang", "n_bytes", "bits", "threshold", "accepted")


def accepted_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are accepted, with their columns as they are."""
    inner = {c: c if c.lower() in ("doc_id", "lang", "text") else f"_c{i}" for i, c in enumerate(docs.columns)}
    whole = docs.select(*[F.col(f"`{c}`").alias(name) for c, name in inner.items()])
    return classify(whole, labels, carry=True, **options).where("accepted").select(
        *[F.col(name).alias(c) for c, name in inner.items()])
