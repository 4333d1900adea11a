"""Connected components of an edge table, without gathering any component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.llm.base import partitions_for, staged, unstage

#: Edges that one task of a round is meant to take.
EDGES_PER_PARTITION = 500_000


def _least(edges: DataFrame) -> DataFrame:
    """(u, m): each node's least neighbour or itself."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to its least one."""
    both = _both(edges)
    return both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to its least one."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    moved = down.join(_least(down), "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(moved.select("u", F.col("m").alias("v")))


def _settled(edges: DataFrame) -> bool:
    """True if every component is a star: no node hangs on two others, and
    none on which others hang hangs itself."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    nodes = ends.groupBy("id").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return nodes.where("hangs > 1 OR (hangs = 1 AND holds = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the least node reachable from each node of the edges
    (long columns ``u`` and ``v``).  Alternates large and small stars until
    every node hangs on its component's least node; each round is written to
    the shared folder."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    most = partitions_for(edges.sparkSession, edges.count(), EDGES_PER_PARTITION)
    now = staged(down.where("u <> v").distinct(), "edges", most)
    while not _settled(now):
        stars = _large_star(now).where("u <> v").distinct()
        after = staged(_small_star(stars).where("u <> v").distinct(), "edges", most)
        unstage(now)
        now = after
    return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
