"""Connected components of links between documents, on DataFrames only.

Alternating steps over the edges: every node links its larger neighbours to its smallest neighbour (large star), then
its smaller neighbours to the smallest one (small star). The edges become stars around the smallest node of each
component within a number of rounds that grows with the logarithm of the longest path. A round's edges go to the
shared folder, so no plan grows and lost executors cost a round at most. A node with very many edges is fine: its
minimum is taken by partial aggregation and joined back, no list of neighbours is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a, b), a > b. Large: each node's larger neighbours; small: its smaller ones and itself, to the minimum."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.where("a > b")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in links (a, b); component is its smallest reachable node."""
    edges = materialize(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "links"
    )
    while True:
        moved = materialize(_star(_star(edges, True), False).distinct(), "links")
        # stars: no node is both a centre and a leaf, and no leaf has two centres
        ends = moved.select(F.col("a").alias("node"), F.lit(1).alias("leaf")).union(moved.select("b", F.lit(0)))
        if not ends.groupBy("node").agg(F.sum("leaf").alias("up"), F.min("leaf").alias("centre")).where("up > 1 OR (up = 1 AND centre = 0)").head(1):
            break
        edges = moved
    centres = moved.select(F.col("b").alias("node")).distinct()
    return moved.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        centres.select("node", F.col("node").alias("component"))
    )
