"""Quality rules with cross-document line frequency, by DataFrame functions alone.

Counts within a text come from arrays of its own words and lines. Across documents, normalised lines
are hashed and the distinct texts of a host that hold each are counted; what is counted and joined
is a narrow table of hashes, never text. A line is boilerplate of its host if more than
``LINE_DOCS`` distinct texts hold it, however large the host; a document that loses more than
``DEPLETED`` of its words with those lines is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline.llm.text import WORD, stored

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of the words
LINE_DOCS = 10
DEPLETED = 0.5


def normal_line(line: Column) -> Column:
    """Lower case, white space as single blanks, digits as 0."""
    blanks = F.trim(F.regexp_replace(line, SPACE, " "))
    return F.lower(F.regexp_replace(blanks, "[0-9]", "0"))


def repeated_words(hashes: Column) -> Column:
    """Words covered by windows whose hash is found twice or more, from the hash at each start."""
    def covered(s):  # s: (hash, start), sorted
        twice = F.filter(s, lambda x, i: (F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)))
                         | (F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))))
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        begin = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(starts, begin, lambda a, i: F.struct(
            i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")), lambda a: a["n"])

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # bound as a one-element array, so that the sorted pairs are made once
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.transform(F.array(pairs), covered)[0]) \
        .otherwise(F.lit(0).cast("long"))


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` (with text) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce("text", F.lit(""))
    split = docs.withColumn("_words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).withColumn(
        "_lines", F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    windows = F.when(F.size("_words") >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_words", i, WINDOW)))) \
        .otherwise(F.array().cast("array<bigint>"))
    counted = split.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
        "n_symbols": (F.char_length(text) - F.char_length(F.regexp_replace(text, "[#*$%&|<>]", ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_windows": windows})
    done = counted.withColumn("n_repeat_words", repeated_words(F.col("_windows"))).drop("_words", "_lines", "_windows")
    return done.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                           | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def common_lines(lines: DataFrame, line_docs: int = LINE_DOCS) -> DataFrame:
    """(host, line): the lines above the limit, from lines (host, line, text_hash)."""
    texts = lines.groupBy("host", "line").agg(F.countDistinct("text_hash").alias("docs"))
    return texts.where(F.col("docs") > line_docs).select("host", "line")


def judge(docs: DataFrame, line_docs: int = LINE_DOCS, depleted: float = DEPLETED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): its counts, removed_lines and the verdict.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    removed_words, removed_lines (hashes, see :func:`without_lines`), text_hash, host, kept. Exact
    copies count as one document of a line. The host is the source; a null source is a host of its
    own. Null and empty texts have no words, so they fail; repeated rows are judged alike, also with
    a null doc_id; an empty table gives an empty result; further columns are not looked at.
    """
    host = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source"))
    base = docs.select("doc_id", host.alias("host"), F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("text_hash", F.xxhash64("text"))
    rows = stored(measures(base).drop("text"), "measures")
    lines = F.transform(F.split("text", "\n", -1), lambda x: F.struct(
        F.xxhash64(normal_line(x)).alias("line"), F.regexp_count(x, F.lit(WORD)).cast("long").alias("words")))
    lines = stored(base.select("host", "doc_id", "text_hash", F.posexplode(lines).alias("at", "x")).select(
        "host", "doc_id", "text_hash", "at", "x.line", "x.words").where("words > 0"), "lines")
    common = common_lines(lines, line_docs)
    hits = lines.join(common, ["host", "line"]).select("host", "doc_id", "text_hash", "at", "line", "words").distinct()
    lost = hits.groupBy("host", "doc_id", "text_hash").agg(
        F.sum("words").alias("removed_words"), F.sort_array(F.collect_set("line")).alias("removed_lines")) \
        .withColumnsRenamed({"host": "_host", "doc_id": "_doc", "text_hash": "_hash"})
    same = (F.col("host") == F.col("_host")) & F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash"))
    judged = rows.join(lost, same, "left").withColumns({
        "removed_words": F.coalesce("removed_words", F.lit(0).cast("long")),
        "removed_lines": F.coalesce("removed_lines", F.array().cast("array<bigint>"))})
    return judged.drop("_host", "_doc", "_hash").withColumn(
        "kept", ~F.col("base_failed") & (F.col("removed_words") <= depleted * F.col("n_words")))


def without_lines(text: Column, removed: Column) -> Column:
    """The text without the lines whose hashes are given."""
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda x: ~F.array_contains(removed, F.xxhash64(normal_line(x)))), "\n")


def cleaned(docs: DataFrame, **limits) -> DataFrame:
    """The documents that are kept, without their host's boilerplate lines; other columns as they are."""
    verdicts = judge(docs, **limits).where("kept").groupBy("doc_id", "host", "text_hash").agg(
        F.first("removed_lines").alias("_removed")).withColumnsRenamed({"doc_id": "_doc", "host": "_host", "text_hash": "_hash"})
    host = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source"))
    met = docs.join(verdicts, F.col("doc_id").eqNullSafe(F.col("_doc")) & (host == F.col("_host"))
                    & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("_hash")))
    return met.select(*[without_lines(F.col("text"), F.col("_removed")).alias("text") if c == "text" else F.col(f"`{c}`")
                        for c in docs.columns])
