"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is an aggregation and a join, so a node with any number of edges
is pre-aggregated before its shuffle and its join can be split.  Both
directions of an edge come from one scan, and the steps end as soon as the
edges are stars around least nodes: every scan, shuffle and broadcast takes
buffers and threads of the driver, however few the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kempt.llm.common import materialise


def each(pairs: DataFrame, *ends: tuple[str, str]) -> DataFrame:
    """For every row, one (u, v) of each of the given pairs of columns."""
    return pairs.select(F.explode(F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in ends])).alias("_e")).select("_e.u", "_e.v")


def _star(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the least of u and all its v."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return pairs.join(least, "u")


def _are_stars(current: DataFrame) -> bool:
    """Whether every node has at most one lesser neighbour, and none where it is one itself."""
    ends = current.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")),
                                            F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("_e")).select("_e.*")
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return nodes.where("up > 1 or (up = 1 and least = 0)").isEmpty()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; the root is the component's least node.

    Edges may repeat, in either direction, and join a node to itself; NULL ends are dropped.
    """
    current = materialise(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges", few=True)
    while not _are_stars(current):
        large = _star(each(current, ("u", "v"), ("v", "u"))).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = each(_star(large.distinct()), ("v", "m"), ("u", "m")).where("u <> v").distinct()
        current = materialise(small, "edges", few=True)
    return materialise(each(current, ("u", "v"), ("v", "v")).distinct().toDF("node", "root"), "roots", few=True)
