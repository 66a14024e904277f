"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.session import materialise


def _order(node: str, turn: int) -> Column:
    """A fresh random order of the nodes in each round, so that no labelling of a path makes it slow."""
    return F.struct(F.xxhash64(F.col(node), F.lit(turn)).alias("h"), F.col(node).alias("root"))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b): two nodes have one root exactly if a path joins them.

    In each round every node points to the least of itself and its neighbours, and edges move to what their ends
    point to; edges whose ends meet are dropped. About half of the nodes go in a round, whatever the shape of the
    graph. Rounds are written tables, so lost executors cost a round at most and only row counts reach the driver.
    Repeated edges, loops and an empty table are fine; edges with a null end are left out.
    """
    live = materialise(edges.select("a", "b").dropna().filter("a <> b").distinct(), "edges")
    found: DataFrame | None = None
    turn = 0
    while not live.isEmpty():
        both = live.union(live.select("b", "a"))
        least = both.groupBy("a").agg(F.min(_order("b", turn)).alias("least"))
        points = materialise(least.select(F.col("a").alias("node"), F.least("least", _order("a", turn))["root"].alias("root")), "points")
        found = points if found is None else materialise(
            found.join(points.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left")
            .select("node", F.coalesce("next", "root").alias("root")), "roots"
        )
        ends = lambda end: points.select(F.col("node").alias(end), F.col("root").alias(f"_{end}"))
        moved = live.join(ends("a"), "a").join(ends("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        live = materialise(moved.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        turn += 1
    return live.select(F.col("a").alias("node"), F.col("b").alias("root")) if found is None else found
