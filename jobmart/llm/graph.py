"""Connected components of a graph of any size, by alternating star operations on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the least node reached, for every node of an edge.

    In each round all larger neighbours of a node are tied to its least neighbour, then all smaller ones; both only
    need minima, which are combined before they are moved. Rounds end when no edge changes.
    """
    ends = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
    now, before = stored(ends.distinct(), "edges"), None
    while True:
        state = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("high", "low")).alias("hash")).first()
        if state["n"] == 0 or state == before:
            break
        before = state
        both = now.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(
            now.select(F.col("low").alias("u"), F.col("high").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("high"), F.col("m").alias("low")).distinct()
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(least, "high").where("low <> m").select(F.col("low").alias("high"), F.col("m").alias("low"))
        now = stored(small.unionByName(least.select("high", F.col("m").alias("low"))).distinct(), "edges")
    return now.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
        now.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    )
