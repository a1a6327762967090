"""Connected components of a large edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import stored

MAX_ROUNDS = 60


def with_least(rows: DataFrame, least: DataFrame, on: str) -> DataFrame:
    """``rows`` joined with one row per key of an aggregate. The join asks for the key's hash
    too, so that the aggregate is shuffled once more: a join in the aggregate's own stage could
    not be split, and a hub's rows would stay in one task."""
    hashed = F.xxhash64(on)
    return rows.withColumn("_h", hashed).join(least.withColumn("_h", hashed),
                                              [on, "_h"]).drop("_h")


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a vertex to the least vertex around it."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"),
                                                           F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (with_least(both, least, "a").where("b > a").where("b != m")
            .select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links every smaller neighbour, and the vertex itself, to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = with_least(edges, least, "a").where("b != m").select(F.col("b").alias("a"),
                                                                  F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every vertex of ``edges(a, b)``; root is the least vertex
    of its component. Self links and repeated links are allowed, nulls are dropped.

    Each round is two aggregations and two joins on the vertex; a hub's rows are
    pre-aggregated to one minimum, and the join with that minimum reads shuffles of its own
    on both sides, so that adaptive execution can split it. Every round is written to the
    shared folder. A fixed point is a forest of stars, so the loop ends when a round
    leaves the edges as they were (count and order-free checksum).
    """
    e = (edges.where("a is not null and b is not null and a != b")
         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e = stored(e, "edges")

    def mark(df):
        r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        return r[0], r[1]

    before = mark(e)
    for _ in range(MAX_ROUNDS):
        if before[0] == 0:
            break
        e = stored(_small_star(_large_star(e)), "edges")
        after = mark(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
    return (e.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
