"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientincome.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); component is its smallest node.

    In each round a node moves to that of itself and its neighbours which has
    the smallest hash, and links between nodes that moved together vanish; the
    rest, contracted, is the next round's graph.  Hashes differ by round, so the
    number of nodes falls by a constant factor whatever the shape; minima
    aggregate map-side, so a hub costs a row for each task.
    """
    steps, edges, rounds = [], links.where("a <> b").select("a", "b"), 0
    edges = written(edges, "cc-edges")
    while not edges.isEmpty():
        rounds += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c, r=rounds: F.struct(F.xxhash64(F.lit(r), c).alias("h"), F.col(c).alias("n"))
        moves = written(
            both.groupBy(F.col("a").alias("node"))
            .agg(F.min(order("b")).alias("other"))
            .select("node", F.least(order("node"), "other")["n"].alias("to")),
            "cc-moves",
        )
        steps.append(moves)
        moved = edges
        for c in ("a", "b"):
            moved = moved.join(moves.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to")), c).drop(c).withColumnRenamed(f"{c}_to", c)
        edges = written(
            moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges"
        )
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)

    def follow(done: DataFrame, step: DataFrame) -> DataFrame:
        later = step.select(F.col("node").alias("to"), F.col("to").alias("next"))
        return done.join(later, "to", "left").select("node", F.coalesce("next", "to").alias("to"))

    roots = reduce(follow, steps)
    smallest = roots.groupBy("to").agg(F.min("node").alias("component"))
    return written(roots.join(smallest, "to").select("node", "component"), "cc-components")
