"""Connected components of link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starpipe.llm.common import cut


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest node it reaches.

    Rounds of large-star and small-star steps: each node's neighbours are hung on the smallest of
    them, so a chain's length shrinks by a factor per round and the rounds grow with its logarithm.
    A hub's neighbours are never gathered: the minimum is a partial aggregate, joined back to the
    edges. Every round is written to the shared folder; only some numbers reach the driver.
    """
    current = cut(
        edges.select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
        ).where("u <> v").distinct(),
        label,
    )
    while not _settled(current):
        large = _star(current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v"))), True)
        current = cut(_star(large, False).distinct(), label)
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one other, which hangs on none."""
    counts = edges.agg(F.count("u").alias("rows"), F.count_distinct("u").alias("nodes")).first()
    if counts["rows"] != counts["nodes"]:
        return False
    return edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (or the smaller) neighbours of each node, and itself, on the smallest."""
    least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    joined = edges.join(least, "u")
    if large:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v")).where("u <> v"))
