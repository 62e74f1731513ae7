"""Connected components of a table of links, by contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayline.llm.text import stored

MOST_ROUNDS = 200


def components(links: DataFrame) -> DataFrame:
    """(node, label) for each node of ``links`` (a, b: long); nodes with equal labels are connected.

    Each round hashes the nodes anew and merges every node into its neighbour of least hash, unless
    its own is less; at least half of the nodes that still have links merge on average, so rounds
    grow with the logarithm of the largest component, whatever its shape. Every round is written.
    An empty table gives an empty result; a link of a node with itself gives the node alone.
    """
    open_links = links.select("a", "b").distinct()
    open_links = stored(open_links, "links")
    labels = stored(open_links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                    .withColumn("label", F.col("node")), "labels")
    open_links = open_links.where("a <> b")
    for turn in range(MOST_ROUNDS):
        if open_links.isEmpty():
            return labels
        both = open_links.unionByName(open_links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order, own = (F.struct(F.xxhash64(F.lit(turn), end).alias("hash"), F.col(end).alias("node")) for end in "ba")
        into = both.groupBy("a").agg(F.min(order).alias("least")).select(
            F.col("a").alias("from"), F.least("least", own).getField("node").alias("to")).where("from <> to")
        into = stored(into, "merges")
        labels = stored(labels.join(into, labels.label == into["from"], "left").select(
            "node", F.coalesce("to", "label").alias("label")), "labels")
        left, right = into.select(F.col("from").alias("a"), F.col("to").alias("a_to")), \
            into.select(F.col("from").alias("b"), F.col("to").alias("b_to"))
        open_links = stored(open_links.join(left, "a", "left").join(right, "b", "left").select(
            F.coalesce("a_to", "a").alias("a"), F.coalesce("b_to", "b").alias("b"))
            .where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    raise RuntimeError("links did not contract")
