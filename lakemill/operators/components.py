"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.operators.storage import cut, discard


def components(edges: DataFrame, name: str, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edge list (a, b); the root is a component's least node.

    Alternates large-star and small-star steps. Edges stay distributed, minima are taken with
    map-side aggregation, and each round is written to the shared folder in place of the one before.
    Rounds grow with the logarithm of the longest chain. Nodes must not be null.
    """
    now = cut(_halves(edges.select("a", "b")), f"{name}-edges")
    before = _digest(now)
    for _ in range(most_rounds):
        last, now = now, cut(_small_star(_large_star(now)), f"{name}-edges")
        discard(last)
        after = _digest(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not converge")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())


def _halves(edges: DataFrame) -> DataFrame:
    """Each edge once, the greater node first, without loops."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is tied to the node's least neighbour (or itself)."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return _halves(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every lesser neighbour of a node, and the node, are tied to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return _halves(edges.join(least, "a").select("b", F.col("m")).toDF("a", "b").union(least))
