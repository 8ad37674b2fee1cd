"""Connected components of a graph by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuelens.llm.tables import written

MAX_ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the smallest node reachable.

    Each round points every node at the smallest of its neighbours, so that paths shorten
    to stars. A node's minimum is one aggregated row, joined back to its edges: a hub with
    very many neighbours is split over tasks. Every round is a written table. Loops and
    repeated edges are allowed; edges with a null end are left out.
    """
    a, b = F.col("a"), F.col("b")
    now = written(
        edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "edges",
    )
    mark = _mark(now)
    for _ in range(MAX_ROUNDS):
        if mark[0] == 0:
            break
        now = _small_star(_large_star(now))
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(leaves.select(F.col("root").alias("node"), "root").distinct())


def _mark(edges: DataFrame) -> tuple:
    """Count and checksum of the edges, to see whether a round changed them."""
    return tuple(
        edges.agg(
            F.count("*"),
            F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)),
        ).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points at the smallest of that neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.min("v").alias("m")), "large")
    linked = both.join(least, "u").where(F.col("v") > F.col("u"))
    pointed = linked.select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    return written(pointed.distinct(), "large-star")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, point at the smallest of them."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "small")
    others = edges.join(least, "u").where(F.col("v") > F.col("m"))
    pointed = others.select(F.col("v").alias("u"), F.col("m").alias("v"))
    stars = least.select("u", F.col("m").alias("v"))
    return written(pointed.unionByName(stars).distinct(), "small-star")
