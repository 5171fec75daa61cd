"""Connected components by alternating large-star and small-star steps over an edge table.

Each step is a grouped minimum (combined before the shuffle) and an equi-join, so a node with very many neighbours
costs no single task its neighbourhood. The edge table is written to the shared folder between rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, shuffled, written

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a < b). large: every larger neighbour of a node moves to the node's smallest neighbour."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # a neighbour v > u is in a row (u, v) of `edges` as (a, b)
        moved = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).join(shuffled(least), "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(shuffled(least), "u").select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(
            least.select(F.col("m").alias("a"), F.col("u").alias("b"))
        )
    return moved.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``edges``: root is the smallest node reachable. Columns a and b share one type.

    Nulls: edges with a null end are dropped. Self loops and repeated edges do no harm. No edges give no rows.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        previous, edges = edges, written(_star(_star(edges, True), False), "edges")
        discard(previous)
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
