"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.session import durable


def rank(column: str, turn: int):
    """Random order of vertices, another one in each turn; equal wherever it is computed."""
    return F.struct(F.xxhash64(F.col(column), F.lit(turn)).alias("order"), F.col(column).alias("vertex"))


def components(links: DataFrame) -> DataFrame:
    """``vertex, component`` for every vertex of ``links`` (two columns of ids): the smallest id that can be reached.

    Every vertex moves to its neighbour (or itself) that comes first in a random order, links follow, and the smaller graph goes through
    the same again until no link is left: a number of turns near the logarithm of the largest component's diameter, each a map-side
    aggregate by vertex and joins on the vertex. A vertex with a third of all links is pre-aggregated, and its join can be split. Links with a
    null, loops and repeated links add nothing. Turns are written to the shared folder.
    """
    edges = durable(links.toDF("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), "links")
    member = durable(edges.select(F.col("a").alias("vertex")).union(edges.select("b")).distinct().withColumn("now", F.col("vertex")), "members")
    turn = 0
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("a", "b")
        nearest = both.groupBy("a").agg(F.min(rank("b", turn)).alias("best"))
        target = durable(nearest.select("a", F.least("best", rank("a", turn)).getField("vertex").alias("goal")), "goals")
        left, right = target.toDF("a", "x"), target.toDF("b", "y")
        moved = edges.join(left, "a").join(right, "b").select(F.col("x").alias("a"), F.col("y").alias("b")).where("a <> b")
        edges = durable(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        goals = target.select(F.col("a").alias("now"), "goal")
        member = durable(member.join(goals, "now", "left").select("vertex", F.coalesce("goal", "now").alias("now")), "members")
        turn += 1
    smallest = member.groupBy("now").agg(F.min("vertex").alias("component"))
    return member.join(smallest, "now").select("vertex", "component")
