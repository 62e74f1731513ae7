"""Shapes of the supplied tables that several queries start from, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayline.operators.aggregates import daily


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_days(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    """Orders and their value per day (and key)."""
    return daily(table(spark, sf_dir, "orders"), keys, "o_orderdate",
                 {"n": F.count(F.lit(1)), "price": F.round(F.sum("o_totalprice"), 2)})


def order_days_sql(*keys: str) -> str:
    cols = "".join(f"{k}, " for k in keys)
    return (f"SELECT {cols}CAST(o_orderdate AS DATE) AS date, count(*) AS n, "
            f"round(sum(o_totalprice), 2) AS price FROM orders "
            f"GROUP BY {cols}CAST(o_orderdate AS DATE)")


def event_days(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    return daily(table(spark, sf_dir, "events"), keys, "ts",
                 {"n": F.count(F.lit(1)), "value": F.round(F.sum("value"), 2)})


def event_days_sql(*keys: str) -> str:
    cols = "".join(f"{k}, " for k in keys)
    return (f"SELECT {cols}CAST(ts AS DATE) AS date, count(*) AS n, round(sum(value), 2) AS value "
            f"FROM events GROUP BY {cols}CAST(ts AS DATE)")


# Polygons made from the supplier table: a diamond for each, with a diamond-shaped hole where the
# balance is low, around a centre that depends on the key. Points are customers on the same square.
def supplier_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    corners = F.array(*[F.struct(F.lit(ring).alias("ring"), F.lit(seq).alias("seq"),
                                 F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                        for ring, seq, dx, dy in _CORNERS])
    return (table(spark, sf_dir, "supplier")
            .select(F.col("s_suppkey").alias("poly_id"), "s_acctbal", F.inline(corners))
            .filter((F.col("ring") == 0) | (F.col("s_acctbal") < 3000))
            .select("poly_id", "ring", "seq",
                    (F.col("poly_id") * 37 % 101 + F.col("dx")).cast("double").alias("x"),
                    (F.col("poly_id") * 53 % 97 + F.col("dy")).cast("double").alias("y")))


_CORNERS = [(0, 0, 4.0, 0.0), (0, 1, 0.0, 4.0), (0, 2, -4.0, 0.0), (0, 3, 0.0, -4.0),
            (1, 0, 1.0, 0.0), (1, 1, 0.0, 1.0), (1, 2, -1.0, 0.0), (1, 3, 0.0, -1.0)]


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("point_id"),
        ((F.col("c_custkey") * 7919 % 10007) / 100.0).alias("x"),
        ((F.col("c_custkey") * 104729 % 9973) / 100.0).alias("y"))


SHAPES_SQL = f"""
    shapes AS (
        SELECT s_suppkey AS poly_id, ring, seq,
               CAST(s_suppkey * 37 % 101 + dx AS DOUBLE) AS x,
               CAST(s_suppkey * 53 % 97 + dy AS DOUBLE) AS y
        FROM supplier, (VALUES {", ".join(str(c) for c in _CORNERS)}) AS c(ring, seq, dx, dy)
        WHERE ring = 0 OR s_acctbal < 3000),
    edges AS (
        SELECT a.poly_id, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
        FROM shapes a JOIN shapes b ON a.poly_id = b.poly_id AND a.ring = b.ring
         AND b.seq = (a.seq + 1) % 4),
    points AS (
        SELECT c_custkey AS point_id, (c_custkey * 7919 % 10007) / 100.0 AS x,
               (c_custkey * 104729 % 9973) / 100.0 AS y FROM customer),
    inside AS (
        SELECT p.point_id, e.poly_id FROM points p, edges e
        WHERE (e.y1 <= p.y) <> (e.y2 <= p.y)
          AND p.x < e.x1 + (p.y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
        GROUP BY p.point_id, e.poly_id HAVING count(*) % 2 = 1)"""
