"""Connected components of an edge table, DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them.
    Takes edges with u > v."""
    least = cut(edges.groupBy("u").agg(F.min("v").alias("m")))
    pairs = edges.join(least, "u").select(
        F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                          F.struct("u", F.col("m").alias("v")))).alias("e"))
    return pairs.select("e.u", "e.v").filter("u <> v").distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns ``a``, ``b``) but the
    roots: root is the smallest node of its component.

    Alternating large-star and small-star rounds. A round is two grouped minima
    (combined before the shuffle) and two equi-joins on a node; the minima are
    checkpointed first, so that both sides of a join are plain shuffles, whose hot
    nodes Spark's skew join splits. Edges never grow in number. Every round is
    checkpointed; the loop ends when a round changes nothing (a checksum of the
    edges, one row to the driver). Nulls and loops are ignored; an empty edge
    table gives an empty result. Any orderable node type."""
    first = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    now, before = cut(first), None
    while True:
        mark = now.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
        now = cut(_small_star(_large_star(now)))
