"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the mean of the vectors of its byte n-grams, hashed into ``BUCKETS`` rows; one linear
layer gives the languages. Both are trained by stochastic gradient descent in numpy on a bounded
sample (``SAMPLE_DOCS`` labelled training texts of at most ``SAMPLE_BYTES`` bytes, shared evenly by
all languages, of each one text at least), which reaches the driver as hashed counts. A part of the sample that is
not trained on gives the temperature of the scores and the score below which a text is rejected.
Every whole text is then predicted in its map task; nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayline.llm.text import LOWER, by_batch, stored, unit_hash, utf8_bytes

GRAMS = (1, 2, 3, 4)
BUCKETS = 1 << 14
DIMENSIONS = 16  # at least; up to 64 if there are more languages
SAMPLE_DOCS = 1200
SAMPLE_BYTES = 20_000
EPOCHS = 12
REJECT = 0.01  # the part of the right answers of the calibration texts that may be rejected
_ASCII = np.zeros(256, bool)
_ASCII[65:91] = _ASCII[97:123] = True


def held_out(doc_id: Column, modulus: int) -> Column:
    """Whether crc32 of the id as text leaves 2; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == 2


def buckets(data: np.ndarray) -> np.ndarray:
    """The buckets of all n-grams of a text's bytes, A-Z lowered, between blanks."""
    b = np.concatenate(([32], LOWER[data], [32])).astype(np.uint64)
    out, key = [], np.zeros(len(b), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        key = (key[:len(b) - n + 1] << np.uint64(8)) | b[n - 1:]
        if n in GRAMS:
            out.append(((key + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 14))
    return np.concatenate(out).astype(np.int64)


def has_letter(data: np.ndarray) -> bool:
    return bool(_ASCII[data].any()) or (bool((data > 127).any())
                                        and any(map(str.isalpha, data.tobytes().decode("utf-8", "replace"))))


def training_sample(docs: DataFrame, modulus: int = 4, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(lang, text): the least hashes of each language among training rows with lang and a letter or more."""
    size = F.octet_length("text")
    usable = docs.where(F.col("lang").isNotNull() & (size > 0) & (size <= SAMPLE_BYTES)
                        & ~held_out(F.col("doc_id"), modulus) & F.col("text").rlike(r"\p{L}")).select(
        "lang", "text", unit_hash("language", F.col("doc_id")).alias("key"))
    langs = stored(usable.groupBy("lang").agg(F.count("*").alias("n")), "langs")
    # up to 1,000, Spark ranks in each task before the shuffle, so that equal ids, which could be many, stay few
    share = min(1000, max(1, sample_docs // max(1, langs.count())))
    near = usable.join(langs, "lang").where(F.col("key") * F.col("n") < float(2 * share + 20) * (1 << 32))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("key", F.xxhash64("text")))
    return stored(near.withColumn("turn", turn).where(F.col("turn") <= share).select("lang", "text", "key"), "language-sample")


def _counted(sample: DataFrame) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, buckets, shares) of the sample's texts that have a letter."""
    def setup():
        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            data, offsets = utf8_bytes(batch.column("text"))
            at, n = [], []
            for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
                found, times = np.unique(buckets(data[a:b]), return_counts=True) if has_letter(data[a:b]) else ([], [])
                at.append(found)
                n.append(times)
            return [pa.array(at, pa.list_(pa.int32())), pa.array(n, pa.list_(pa.int32()))]
        return make

    ints = T.ArrayType(T.IntegerType())
    rows = by_batch(sample, setup, [T.StructField("at", ints), T.StructField("times", ints)]) \
        .select("lang", "key", "at", "times").toArrow().sort_by([("key", "ascending"), ("lang", "ascending")])
    return [(lang, np.array(at), np.array(n, np.float32) / sum(n))
            for lang, at, n in zip(rows["lang"].to_pylist(), rows["at"].to_pylist(), rows["times"].to_pylist()) if at]


def train(sample: list[tuple[str, np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 0) -> dict:
    """The model: langs, a score of each language for each bucket, temperature and rejection score."""
    langs = sorted({lang for lang, _, _ in sample})
    if not langs:
        return {"langs": [], "table": np.zeros((BUCKETS, 0), np.float32), "bias": np.zeros(0), "temperature": 1.0, "reject": 0.0}
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(sample))
    number = {lang: i for i, lang in enumerate(langs)}
    y = np.array([number[lang] for lang, _, _ in sample])
    first = np.isin(np.arange(len(order)), np.unique(y[order], return_index=True)[1])  # one of each language is trained on
    rest = order[~first]
    checks, trains = rest[:len(order) // 5], np.concatenate((order[first], rest[len(order) // 5:]))
    size, epochs = max(DIMENSIONS, min(64, len(langs))), epochs * max(1, len(langs) // 32)
    vectors = rng.uniform(-1, 1, (BUCKETS, size)).astype(np.float32) / size
    layer, bias = np.zeros((size, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    squares = [np.full_like(p, 1e-6) for p in (vectors, layer, bias)]

    def dense(rows):
        x = np.zeros((len(rows), BUCKETS), np.float32)
        for i, r in enumerate(rows):
            x[i, sample[r][1]] = sample[r][2]
        return x

    def softmax(z):
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    for _ in range(epochs):
        for at in np.array_split(rng.permutation(trains), max(1, len(trains) // 32)):
            x = dense(at)
            mean = x @ vectors
            wrong = softmax(mean @ layer + bias)
            wrong[np.arange(len(at)), y[at]] -= 1
            wrong /= len(at)
            for p, q, g in zip((vectors, layer, bias), squares, (x.T @ (wrong @ layer.T), mean.T @ wrong, wrong.sum(axis=0))):
                q += g * g
                p -= 0.1 * g / np.sqrt(q)
    held = checks if len(checks) else trains
    z = np.concatenate([dense(at) @ vectors @ layer + bias for at in np.array_split(held, max(1, len(held) // 64))])
    choices = np.geomspace(0.05, 20, 61)
    loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(held)), y[held]], 1e-12)).mean() for t in choices]
    temperature = float(choices[int(np.argmin(loss))])
    p = softmax(z / temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == y[held]]
    return {"langs": langs, "table": vectors @ layer, "bias": bias, "temperature": temperature,
            "reject": float(np.quantile(right, REJECT)) if len(right) else 0.0}


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and accepted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def setup():
        m = shared.value
        table, bias, langs = m["table"], m["bias"], m["langs"]

        def scores(data):
            if not langs or not has_letter(data):
                return None
            at = buckets(data)
            mean = table[at].mean(axis=0) if len(at) < BUCKETS else \
                np.bincount(at, minlength=BUCKETS).astype(np.float32) @ table / len(at)
            z = (mean + bias).astype(np.float64) / m["temperature"]
            e = np.exp(z - z.max())
            return e / e.sum()

        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            data, offsets = utf8_bytes(batch.column("text"))
            found = [scores(data[a:b]) for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
            best = [None if p is None else int(p.argmax()) for p in found]
            top = [0.0 if p is None else float(p[i]) for p, i in zip(found, best)]
            return [pa.array(["und" if i is None else langs[i] for i in best], pa.string()), pa.array(top, pa.float64()),
                    pa.array([i is not None and s >= m["reject"] for i, s in zip(best, top)], pa.bool_())]
        return make

    return by_batch(docs, setup, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                                  T.StructField("accepted", T.BooleanType())])


def identify(docs: DataFrame, modulus: int = 4, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``docs`` (doc_id, text, lang and others) with held_out, lang_pred, score and accepted.

    Only text and lang of rows that are not held out are learned from; a prediction uses the text
    alone. A null text and one without any letter is ``und`` with score 0, not accepted, as is every
    text if there is nothing to learn from. accepted is false where the score is below what right
    answers usually have. Repeated rows get equal answers; an empty table gives an empty result;
    columns with the new names are replaced, all others pass through.
    """
    model = train(_counted(training_sample(docs.select("doc_id", "text", "lang"), modulus, sample_docs)))
    return predict(docs.withColumn("held_out", held_out(F.col("doc_id"), modulus)), model)
