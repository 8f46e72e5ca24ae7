"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.llm.columns import written


def _downward(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is tied to the smallest vertex of the neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _downward(both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are tied to the smallest of them."""
    lowest = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _downward(moved.union(lowest.select("a", F.col("m").alias("b"))))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every vertex of ``edges`` (a, b) that isn't the smallest of its component.

    The number of rounds grows with the logarithm of the longest chain. Minima are pre-aggregated, so that a
    vertex with very many neighbours costs each map task one row; its rows in the join are split by the
    planner's skew handling. Every round is a written table. Loops and repeated edges don't matter; no edges
    give no rows.
    """
    now, seen = written(_downward(edges)), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
        seen, now = state, written(_small_star(_large_star(now)))
