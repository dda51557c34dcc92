"""Connected components of a table of links, by rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegauge.llm.tables import kept


def _centred(edges: DataFrame, inner: bool) -> DataFrame:
    """Move each node's neighbours to its smallest one.

    ``inner`` moves those that are smaller than the node, and the node itself; else
    those that are larger are moved.
    """
    if inner:
        around = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("next"))
    else:
        around = edges.select(F.col("a").alias("node"), F.col("b").alias("next")).union(
            edges.select(F.col("b").alias("node"), F.col("a").alias("next")))
    least = around.groupBy("node").agg(F.min("next").alias("least")).select(
        "node", F.least("node", "least").alias("least"))
    moved = around.join(least, "node")
    if inner:
        moved = moved.select(F.col("next").alias("a"), F.col("least").alias("b")).union(
            least.select(F.col("node").alias("a"), F.col("least").alias("b")))
    else:
        moved = moved.filter(F.col("next") > F.col("node")).select(
            F.col("next").alias("a"), F.col("least").alias("b"))
    return moved.filter("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in links (a, b); the component is its smallest node.

    Each round is written, so that the plan does not grow and a lost executor repeats
    one round. Rounds are few: about the logarithm of the longest chain.
    """
    edges = kept(links.filter("a <> b").select(F.greatest("a", "b").alias("a"),
                                               F.least("a", "b").alias("b")).distinct(), "links")
    before = _state(edges)
    while before[0]:
        edges = kept(_centred(_centred(edges, inner=False), inner=True), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
