"""Connected components of an edge table, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.session import durable

MOST_ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node with an edge.

    Alternates two steps until nothing changes: each node links its larger neighbours to its
    smallest one, then its smaller neighbours to it. Chains halve each round, and the number
    of edges never grows. Only two counts reach the driver. A node with very many
    neighbours is an aggregation with partial results and a join that can be split.
    """
    pairs = edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).filter("lo <> hi").distinct()
    pairs, stamp = durable(pairs), None
    for _ in range(MOST_ROUNDS):
        both = pairs.select(F.col("lo").alias("n"), F.col("hi").alias("m")).union(
            pairs.select(F.col("hi").alias("n"), F.col("lo").alias("m")))
        # Stored before the join, so that Spark can split a node with very many neighbours.
        least = durable(both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("least")))
        # Larger neighbours of n now hang on the smallest of its neighbourhood.
        large = (both.filter("m > n").join(least, "n")
                 .select(F.col("least").alias("lo"), F.col("m").alias("hi"))).distinct()
        # And the smaller neighbours of n, n itself included.
        large = durable(large)
        least = durable(large.groupBy("hi").agg(F.min("lo").alias("least")))
        small = (large.join(least, "hi")
                 .select(F.col("least").alias("lo"), F.explode(F.array("lo", "hi")).alias("hi"))
                 .filter("lo <> hi").distinct())
        pairs = durable(small)
        before, stamp = stamp, _stamp(pairs)
        if before == stamp:
            return _labels(pairs)
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")


def _stamp(pairs: DataFrame):
    hashed = [F.bit_xor(F.xxhash64("lo", "hi", F.lit(salt))) for salt in (1, 2)]
    return tuple(pairs.agg(F.count(F.lit(1)), *hashed).first())


def _labels(stars: DataFrame) -> DataFrame:
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        stars.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
