"""Connected components of an edge table by large-star and small-star rounds.

Every round is two aggregations with map-side combination and two joins, written once; rounds
grow with the logarithm of the longest chain. Edges stay in tables; only their
count and a checksum reach the driver, to see that a round changed nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from airlens.llm.common import materialize


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest one: those above a node (large) or the node and those below it (small)."""
    if large:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return (both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                .where(F.col("a") != F.col("b")).distinct())
    down = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select("a", F.col("m").alias("b"))).where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b longs): the smallest id reachable from it."""
    pairs = materialize(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        row = pairs.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
        if not row.n or (row.n, row.h) == mark:
            break
        mark = (row.n, row.h)
        pairs = materialize(_star(_star(pairs, True), False), "stars")
    tops = pairs.select(F.col("b").alias("id")).distinct()
    return pairs.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(tops.select("id", F.col("id").alias("component")))
