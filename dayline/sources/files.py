"""Scans of landed files under a declared schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dayline.schemas import conform


def csv_headers(spark: SparkSession, path: str | Sequence[str], **options) -> DataFrame:
    """(header, uri): the first line of each file that has one.

    One pass over the lines of the files, of which a task keeps one for each file that begins in it.
    """
    lines = spark.read.options(**options).text(path).select(
        F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("start"),
        F.rtrim("value").alias("line"), F.monotonically_increasing_id().alias("at"))
    return lines.filter("start = 0 AND line <> ''").groupBy("uri").agg(F.min_by("line", "at").alias("header")).select("header", "uri")


def csv_frames(spark: SparkSession, path: str | Sequence[str], **options) -> list[DataFrame]:
    """Headed CSV files as text columns: one frame for each distinct header.

    The names of files come to the driver only where headers differ.
    """
    walk = {k: v for k, v in options.items() if k in ("recursiveFileLookup", "pathGlobFilter")}
    headers = csv_headers(spark, path, **walk)
    distinct = [r.header for r in headers.select("header").distinct().limit(2).collect()]
    if not distinct:
        return []
    groups = [path] if len(distinct) == 1 else [
        [unquote(uri) for uri in sorted(r.uris)] for r in headers.groupBy("header").agg(F.collect_list("uri").alias("uris")).collect()]
    reader = spark.read.options(**options).option("header", True)
    frames = []
    for group in groups:
        header = reader.csv(group).schema
        frames.append(spark.read.options(**options).option("header", True).schema(header).option("enforceSchema", False).csv(group))
    return frames


def scan_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str, **options) -> DataFrame:
    """Headed CSV files made to fit ``schema`` by column name; values that do not fit become NULL.

    Files may have their columns in any order, lack some and have others besides: each distinct header
    is scanned apart, and all are united by name. Blank lines before a header are passed over.
    """
    frames = [conform(f, schema) for f in csv_frames(spark, path, **options)]
    return reduce(DataFrame.unionByName, frames) if frames else conform(spark.createDataFrame([], "none int"), schema)


def scan_json_records(spark: SparkSession, path: str, schema: StructType | str,
                      multi_line: bool = True) -> DataFrame:
    """Files holding an array of flat records; one record per line if not ``multi_line``.

    A multi-line file is read by one task; :func:`scan_json_array` reads a large one by many.
    """
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def _quotes(text: Column) -> Column:
    """How many quotes of JSON text open or close a string."""
    plain = F.regexp_replace(text, r"\\.", "")
    return F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))


def _opened(text: Column, inside: Column) -> Column:
    """How many braces of JSON text open outside of strings, if it begins ``inside`` one or not."""
    plain = F.concat(F.when(inside, '"').otherwise(""), F.regexp_replace(text, r"\\.", ""))
    bare = F.regexp_replace(plain, '"[^"]*("|$)', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit("{"), F.lit("")))


def scan_json_array(spark: SparkSession, path: str | Sequence[str], schema: StructType | str, **options) -> DataFrame:
    """Files that each hold one array of records, of any size and layout, each read by many tasks.

    A file is read in blocks, as pieces that end with a closing brace. Whether a piece ends inside of
    a string, and how deep, follows from running sums within its block and from sums over the blocks
    before it, a row each. A record that is one piece, as flat ones are, is parsed where it stands;
    the pieces of others, nested or with braces in strings, meet by file and number of the record. No
    task holds more than a block. Values that do not fit become NULL, and a record that is no JSON a
    row of NULLs; empty files and arrays give no rows.
    """
    block, file = ["uri", "start"], Window.partitionBy("uri").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy(*block).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    pieces = spark.read.options(**options).text(path, lineSep="}").select(
        F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), "value").withColumn("quotes", _quotes(F.col("value")))

    def before(sums: DataFrame, *names: str) -> DataFrame:
        return sums.select(*block, *[F.coalesce(F.sum(n).over(file), F.lit(0)).alias(f"{n}_before") for n in names])

    quotes = before(pieces.groupBy(*block).agg(F.sum("quotes").alias("quotes")), "quotes")
    marked = pieces.withColumn("seen", F.sum("quotes").over(so_far)).join(quotes, block)
    ends_inside = (F.col("seen") + F.col("quotes_before")) % 2 == 1
    begins_inside = (F.col("seen") - F.col("quotes") + F.col("quotes_before")) % 2 == 1
    marked = marked.select(*block, "at", "value", (_opened(F.col("value"), begins_inside) - F.when(ends_inside, 0).otherwise(1)).alias("step"))
    levels = before(marked.groupBy(*block).agg(F.sum("step").alias("step")), "step")
    level = F.sum("step").over(so_far) + F.col("step_before")
    marked = marked.join(levels, block).withColumn("level", level).withColumn("closes", (F.col("level") <= 0).cast("long"))
    ends = before(marked.groupBy(*block).agg(F.sum("closes").alias("closes")), "closes")
    marked = marked.join(ends, block).withColumn("record", F.sum("closes").over(so_far) - F.col("closes") + F.col("closes_before"))
    # a piece that opens a record begins at level 0
    whole = (F.col("closes") == 1) & (F.col("level") - F.col("step") == 0)
    alone = marked.filter(whole).select("value")
    split = marked.filter(~whole).groupBy("uri", "record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "at", "value"))), lambda x: x["value"]), "}").alias("value"))
    records = alone.unionByName(split.select("value")).select(F.regexp_replace("value", r"^[\s,\[\uFEFF]+", "").alias("value"))
    parsed = records.filter(F.startswith("value", F.lit("{"))).select(F.from_json(F.concat("value", F.lit("}")), schema).alias("r"))
    return parsed.select("r.*")


def scan_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as ``(path, value)``, for nested documents and pages."""
    return spark.read.text(path, wholetext=True).selectExpr("_metadata.file_path AS path", "value")


def scan(spark: SparkSession, path: str, entity: str | None = None) -> DataFrame:
    """A stored table, made to fit its entity schema when one is named."""
    df = spark.read.parquet(path)
    return conform(df, entity) if entity else df
