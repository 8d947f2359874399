"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step. Each vertex's least neighbour is an aggregate that combines before the exchange; the join back
    is one that AQE splits where a vertex has very many neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node of its component.

    Union-find without shared memory: each round hooks every vertex to its least neighbour and shortens the paths, so
    the number of rounds grows with the logarithm of the longest path. Each round is cut to the checkpoint folder.
    Loops and repeated edges don't matter; edges with a NULL end are left out.
    """
    now = cut(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b").distinct())
    seen = None
    for _ in range(rounds):
        now = cut(_star(_star(now, True), False))
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components didn't settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(now.select(F.col("b"), F.col("b")).distinct())
