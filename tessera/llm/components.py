"""Connected components of a graph given as an edge table, by alternating large-star
and small-star rounds. Nothing is collected; each round is a few shuffles of the
edges and ends in a table in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged


def _state(edges: DataFrame):
    """Count and order-free fingerprint of an edge set."""
    return edges.agg(F.count("u"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u, 1))")).first()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge: the smallest node reachable.
    Edges may repeat, point either way or to the node itself; null ends are no edges.
    A node with many edges is pre-aggregated by the minimum (map-side) and its edges
    are split by the skew join."""
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), (F.col(a).isNotNull() & F.col(b).isNotNull()).alias("ok"))
    now = staged(now.filter("ok and u != v").select("u", "v").distinct(), "components")
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.distinct(), "components")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
        now = staged(small.filter("u != v").distinct(), "components")
        after = _state(now)
        if after == state:
            break
        state = after
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(roots)
