"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_effects.llm.tables import materialise


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of the
    links ``a``, ``b`` (longs; loops are ignored).  Each round is checkpointed;
    minima are partial sums before the shuffle.  The minimum is joined back to a
    node's links, so those of a hub meet in one task unless AQE splits it."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    e = materialise(edges.where("a <> b").select(high.alias("u"), low.alias("v")).distinct())
    before = _mark(e)
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialise(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        now = _mark(e)
        if now == before:
            break
        before = now
    pairs = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return pairs.union(e.select("v", F.col("v").alias("component")).distinct())
