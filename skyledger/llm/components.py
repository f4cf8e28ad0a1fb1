"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import forget, stored
from skyledger.operators.keyed import join_totals


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Rows (node, component) for every node of ``edges`` (a, b), both long: the smallest node reachable.

    Each step joins the edges with the smallest neighbour of their nodes, a grouped minimum, so a node with any number
    of edges is pre-aggregated and its edges are spread by a salt. Every step is written to the shared folder. Loops
    and repeated edges do no harm; rows with a null end are ignored. The number of steps grows with the logarithm of
    the longest path, and is none for edges that are stars already; more than ``rounds`` raises an error.
    """
    a, b = F.col("a"), F.col("b")
    now = stored(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    for _ in range(rounds):
        if _settled(now):
            return now.select(a.alias("node"), b.alias("component")).unionByName(
                now.select(b.alias("node"), b.alias("component")).distinct()
            )
        step = stored(_small_star(_large_star(now)), "edges")
        forget(now)
        now = step
    raise RuntimeError("components did not settle")


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, and that one none."""
    roots = edges.select(F.col("b").alias("a")).distinct()
    return (
        edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).isEmpty()
        and edges.join(roots, "a", "left_semi").isEmpty()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("_least"))
    return join_totals(both, least, ["a"], grows=True).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("_least"))
    others = join_totals(down, least, ["a"], grows=True).where(F.col("b") != F.col("_least")).select(F.col("b").alias("a"), F.col("_least").alias("b"))
    return others.unionByName(least.select("a", F.col("_least").alias("b"))).distinct()
