"""Connected components over edges, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from webcapture.llm.common import saved


def _normal(edges: DataFrame) -> DataFrame:
    return edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Hangs the neighbours of each node (all, or only the larger ones) on its smallest neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not larger_only:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    hung = both.join(least, "a")
    if larger_only:
        return hung.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
    linked = hung.filter("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return linked.union(least.select("a", F.col("low").alias("b"))).filter("a != b").distinct()


def groups(edges: DataFrame) -> DataFrame:
    """``node, component`` after one round: nodes of one label are connected, but not all connected ones share it."""
    links = saved(_normal(edges), "links")
    hung = _star(_star(links, larger_only=True), larger_only=False)
    return saved(hung.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")), "groups")


def components(edges: DataFrame) -> DataFrame:
    """``a, b`` links to ``node, component``: the smallest node that each linked node can reach.

    Alternates hanging the larger and the smaller neighbours of each node on the smallest one until the
    links are a star per component; rounds grow with the logarithm of the number of nodes. Nodes without a
    link to another node are not returned. Every round is written to the shared folder.
    """
    links = saved(_normal(edges), "links")
    while True:
        after = saved(_star(_star(links, larger_only=True), larger_only=False), "links")
        state = [F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.sum(F.xxhash64("a", "b") % 1_000_003)]
        if links.agg(*state).first() == after.agg(*state).first():
            return after.select(F.col("a").alias("node"), F.col("b").alias("component"))
        links = after
