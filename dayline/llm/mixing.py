"""Mixing sources to target weights, by DataFrame functions alone.

Documents get hash-random keys from doc_id and text, so rows without an id spread as well. Each source is cut into ranges of those keys, about ``RANGE_ROWS``
documents each; the prefix sum of a document is the sum of the ranges before its own, from a table
with a row per range, and the running sum inside its range. So a source with a third of all rows
is as many tasks as it has ranges. The source is then cut at its exact budget, after as many whole
epochs as the budget holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayline.llm.text import stored, unit_hash, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2.0
RANGE_ROWS = 2_000
BROADCAST_SOURCES = 100_000  # a table of more sources is joined by shuffle
SALTS = 32


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   limit: float = LIMIT) -> DataFrame:
    """(source, source_size, n_docs, target) from rows (source, size).

    Sources in code-point order, null last, take ``weights`` in turn and divide ``share`` of all
    words; no target exceeds ``limit`` times its source, and what a full source leaves over goes to
    the others by weight. With sources ordered by limit / weight, the full ones come first, so one
    pass of sums finds the level at which the rest divide. The window holds a row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    everything = Window.partitionBy(F.lit(0))
    turn = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    ranked = per.withColumn("turn", turn) \
        .withColumn("weight", F.get(kinds, F.col("turn") % len(weights))) \
        .withColumn("most", F.col("source_size") * F.lit(float(limit))) \
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
    by_ratio = everything.orderBy(F.col("most") / F.col("weight"), "turn")
    before = F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    levels = ranked.withColumn("level", (F.col("budget") - before) / rest) \
        .withColumn("fits", F.col("level") <= F.col("most") / F.col("weight"))
    level = F.min(F.when(F.col("fits"), F.struct(F.col("most") / F.col("weight"), "turn", "level"))) \
        .over(everything)["level"]
    target = F.least(F.coalesce(F.col("weight") * level, F.col("most")), F.col("most"))
    return levels.withColumn("target", target).select("source", "source_size", "n_docs", "target")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT,
        range_rows: int = RANGE_ROWS, seed: str = "mix", whole: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): what the mix takes of it.

    Columns: doc_id, source, size, source_size, target, epochs (whole passes over the source) and
    taken (words, repeats counted); with ``whole`` also document, a struct of the row's columns.
    Null and empty texts have size 0 and give nothing; a null source is a source of its own; rows
    that repeat are rows like others, equal rows share a range and are exchangeable, and null ids are
    told apart by their texts; an empty table gives an
    empty result; further columns are not looked at.
    """
    # nulls as a name of their own, so that joins by source keep them
    name = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source"))
    keyed = [name.alias("name"), "doc_id", "source", word_count(F.col("text")).alias("size"),
             unit_hash(seed, F.col("doc_id"), F.col("text")).alias("key")]
    sizes = stored(docs.select(*keyed), "mix-sizes")
    document = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")] if whole else []
    targets = stored(source_targets(sizes, weights, share, limit).select(
        name.alias("name"), "source_size", "target",
        F.greatest(F.lit(1), F.ceil(F.col("n_docs") / range_rows)).cast("long").alias("ranges")), "mix-targets")
    few = targets.count() <= BROADCAST_SOURCES

    def with_target(rows: DataFrame) -> DataFrame:
        if few:
            return rows.join(F.broadcast(targets), "name")
        salts = targets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        return rows.withColumn("salt", (F.col("key") % SALTS).cast("int")).join(salts, ["name", "salt"]).drop("salt")

    ranged = F.shiftright(F.col("key") * F.col("ranges"), 32).alias("range")
    by_name = Window.partitionBy("name").orderBy("range")
    ahead = with_target(sizes).groupBy("name", ranged).agg(F.sum("size").alias("words")) \
        .select("name", "range", (F.sum("words").over(by_name) - F.col("words")).alias("ahead"))
    in_range = Window.partitionBy("name", "range").orderBy("key", F.col("doc_id").asc_nulls_last(), "size") \
        .rowsBetween(Window.unboundedPreceding, 0)
    rows = with_target(docs.select(*keyed, *document) if whole else sizes)
    placed = rows.withColumn("range", ranged).withColumn(
        "within", F.sum("size").over(in_range) - F.col("size")).join(ahead, ["name", "range"])
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    left = budget - F.col("epochs") * F.col("source_size") - F.col("ahead") - F.col("within")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left))
    return placed.withColumn("epochs", epochs).select(
        "doc_id", "source", "size", "source_size", "target", "epochs",
        (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"), *[c for c in ["document"] if whole])


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a row for each epoch a document is in.

    The document at the cut of the last epoch stays whole, so a source exceeds its target by less
    than one document. Documents without words, and those after the cut, go.
    """
    passes = F.ceil(F.col("taken") / F.col("size")).cast("int")
    return mix(docs, whole=True, **options).where(F.col("taken") > 0) \
        .select("document", F.explode(F.sequence(F.lit(1), passes)).alias("pass")).select("document.*")
