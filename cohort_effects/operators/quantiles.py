"""Quantiles without a buffer of the group's values: exact ones over ranges of
counted values, and mergeable sketches with a rank bound."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_effects.operators.ranges import matched, running

SKETCH_K = 400
RANK_BOUND = 0.02  # of a sketch with SKETCH_K, with a wide margin (its published single-sided error is under 0.7 %)


def exact(values: DataFrame, by: list[str], value: str, n: str, probs: Sequence[float], linear: bool = True) -> DataFrame:
    """``by`` and ``quantiles`` (an array, in the order of ``probs``) of values
    that stand ``n`` times each, one row a (group, value).

    The values lie in sorted ranges; a range's row count and the running counts
    inside it give every value the span of ranks it holds, and only the values
    that hold a wanted rank go on.  ``linear`` interpolates between the two
    neighbours (position p * (n - 1)); otherwise it is the least value with at
    least a share p of the rows up to it.
    """
    spans = running(values.where(F.col(value).isNotNull()).select(*by, value, n), by, [F.col(value).asc()], n, "_before")
    total, first, end = F.col("_before_of"), F.col("_before"), F.col("_before") + F.col(n)

    def at(rank):
        return F.max(F.when((first <= rank) & (rank < end), F.col(value)))

    picks, held = [], F.lit(False)
    for k, p in enumerate(probs):
        place = F.lit(float(p)) * (total - 1)
        low = F.floor(place) if linear else F.greatest(F.ceil(F.lit(float(p)) * total) - 1, F.lit(0))
        high = F.ceil(place) if linear else low
        held = held | ((first <= high) & (low < end))
        picks += [at(low).alias(f"_l{k}"), at(high).alias(f"_h{k}"), F.max(place - F.floor(place)).alias(f"_f{k}")]
    got = spans.where(held).groupBy(*by).agg(*picks)

    def one(k: int):
        low, high, part = F.col(f"_l{k}"), F.col(f"_h{k}"), F.col(f"_f{k}")
        return ((1 - part) * low + part * high if linear else low).cast("double")

    return got.select(*by, F.array(*[one(k) for k in range(len(probs))]).alias("quantiles"))


def sketch(df: DataFrame, by: list[str], col: str) -> DataFrame:
    """A KLL sketch of a fixed size per group, to be stored and merged."""
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(col).cast("double"), F.lit(SKETCH_K)).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, by: list[str], probs: Sequence[float]) -> DataFrame:
    """Quantiles of the merged sketches of each group."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select(*by, F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in probs]).alias("quantiles"))


def rank_check(df: DataFrame, quantiles: DataFrame, by: list[str], col: str, bound: float) -> DataFrame:
    """``by``, ``prob``, ``n`` and whether the share of rows below the quantile,
    or at it, comes within ``bound`` of ``prob``."""
    rows = matched(df.where(F.col(col).isNotNull()), quantiles, by)
    ranks = rows.groupBy(*by, "prob").agg(
        F.count("*").alias("n"), F.avg((F.col(col) < F.col("value")).cast("double")).alias("_below"), F.avg((F.col(col) <= F.col("value")).cast("double")).alias("_upto")
    )
    within = (F.col("_below") <= F.col("prob") + bound) & (F.col("_upto") >= F.col("prob") - bound)
    return ranks.select(*by, "prob", "n", within.alias("within_bound"))
