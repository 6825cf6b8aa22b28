"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermocline.session import materialize


def _all_stars(e: DataFrame) -> bool:
    """Whether every node of ``e`` hangs on one smaller node, on which nothing but such nodes hang."""
    ends = e.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(e.select(F.col("lo").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 OR (up = 1 AND down > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (two columns of longs); root is the smallest node that
    it is connected with. Nodes without an edge to another node are not returned.

    Each round hangs all neighbours of a node on its smallest neighbour, first for the larger, then for
    the smaller neighbours, until every node hangs on its root: logarithmically many rounds, each of
    aggregates with map-side combining and of joins with a written table, whose hot keys can be split.
    """
    a, b = edges.columns
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    e = materialize(e, "edges")
    while not _all_stars(e):
        ends = e.select(F.col("hi").alias("node"), F.col("lo").alias("to")).unionByName(e.select(F.col("lo").alias("node"), F.col("hi").alias("to")))
        least = ends.groupBy("node").agg(F.min("to").alias("least"))
        # (lo, its smallest neighbour) for those that have a smaller one: the others are the roots of stars already
        moved = materialize(least.where("least < node").select(F.col("node").alias("lo"), "least"), "edges-moved")
        large = e.join(moved, "lo", "left").select("hi", F.coalesce("least", "lo").alias("lo")).distinct()
        large = materialize(large, "edges-large")
        nearest = materialize(large.groupBy("hi").agg(F.min("lo").alias("least")), "edges-nearest")
        rest = large.join(nearest, "hi").where("lo > least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
        e = materialize(rest.unionByName(nearest.select("hi", F.col("least").alias("lo"))).distinct(), "edges")
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
