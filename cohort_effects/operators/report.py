"""Mart reports (X1-X9): distributions, top lists, profiles, cross tables
and shortlists.  Inputs are mart-sized (one row per school, subject, year);
top lists reduce before their shuffle, longer orders are dealt to ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohort_effects.functions import round_half_up
from cohort_effects.params import Params
from cohort_effects.operators.profile import counts_by_value
from cohort_effects.operators import quantiles
from cohort_effects.operators.ranges import matched, pinned, positions
from cohort_effects.operators.reshape import pivot_wide

DESCRIBE = ("count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_by(df: DataFrame, by: Sequence[str], col: str, digits: int = 3) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear), max per group,
    rounded for display.  The quartiles are exact and found over ranges of the
    counted values (``quantiles.exact``), not in a buffer of the group."""
    df = pinned(df.select(*by, col))
    agg = df.groupBy(*by).agg(
        F.count(col).alias("count"),
        F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("std"),
        F.min(col).alias("min"),
        F.max(col).alias("max"),
    )
    q = quantiles.exact(counts_by_value(df, col, by), list(by), "v", "n", [0.25, 0.5, 0.75])
    out = matched(agg, q, list(by), "left").select(
        *by, "count", "mean", "std", "min", *[F.col("quantiles")[k].alias(c) for k, c in enumerate(("q25", "q50", "q75"))], "max")
    return out.select(*by, "count", *[round_half_up(c, digits).alias(c) for c in DESCRIBE[1:]])


def top_n_per(df: DataFrame, by: Sequence[str], rank: str, n: int, tie: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """X2/T-1: the first n rows per group by ``rank`` then ``tie`` -- cut at
    exactly n even inside a tie (the tie key makes the cut repeatable)."""
    w = Window.partitionBy(*by).orderBy(F.col(rank).asc(), *[F.col(t).asc() for t in tie])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).select(*by, *cols)


def extreme_profiles(
    mart: DataFrame, a: str, b: str, strong: float = 0.30, weak: float = 0.10, index: Sequence[str] = ("school_id", "year")
) -> DataFrame:
    """Schools strong in one subject and weak in the other.

    (a >= strong and b <= -weak) or (a <= -strong and b >= weak), over
    schools with both subjects present.
    """
    wide = pivot_wide(mart, list(index), "subject", "adj_effect", [a, b]).select(
        *index, F.col(a).alias("a_effect"), F.col(b).alias("b_effect")
    )
    A, B = F.col("a_effect"), F.col("b_effect")
    cond = ((A >= strong) & (B <= -weak)) | ((A <= -strong) & (B >= weak))
    return wide.withColumn("extreme", cond)


def extreme_share(profiles: DataFrame) -> DataFrame:
    return profiles.agg(
        F.count(F.lit(1)).alias("n_complete"),
        F.count_if("extreme").alias("n_extreme"),
    ).withColumn("pct_extreme", F.try_divide(F.col("n_extreme") * F.lit(100.0), F.col("n_complete").cast("double")))


def symmetric_limits(mart: DataFrame, by: Sequence[str] = ("subject",), margin: float = 1.05) -> DataFrame:
    """Per group, the range of raw and adjusted effects, and one symmetric
    axis limit for all: max(|min|, |max|) x margin of the raw effect over the
    whole mart, so that the groups' panels share their axes."""
    agg = mart.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("raw_effect").alias("raw_min"),
        F.max("raw_effect").alias("raw_max"),
        F.min("adj_effect").alias("adj_min"),
        F.max("adj_effect").alias("adj_max"),
        F.sum("n_obs").cast("bigint").alias("n_obs_total"),
    )
    whole = agg.agg((F.greatest(F.max(F.abs("raw_min")), F.max(F.abs("raw_max"))) * F.lit(margin)).alias("limit"))
    return agg.join(F.broadcast(whole))  # one row


def box_stats(df: DataFrame, by: Sequence[str], col: str, threshold: float = 0.10, digits: int = 3) -> DataFrame:
    """Quartiles (linear), 1.5 IQR whiskers (most extreme values
    inside the fences), outliers, median/mean/max and the share above a
    threshold, per group.  Values are counted once (and checkpointed); quartiles
    and fences both read those counts, so a value cannot differ between the two."""
    vals = pinned(counts_by_value(df, col, by))
    q = quantiles.exact(vals, list(by), "v", "n", [0.25, 0.5, 0.75])
    q = q.select(*by, *[F.col("quantiles")[k].alias(c) for k, c in enumerate(("q1", "median", "q3"))])
    j = matched(vals, q, list(by))
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    v, n = F.col("v"), F.col("n")
    total = F.sum(n)
    out = j.groupBy(*by, "q1", "median", "q3").agg(
        total.alias("n"),
        F.min(F.when(v >= lo_f, v)).alias("whisker_low"),
        F.max(F.when(v <= hi_f, v)).alias("whisker_high"),
        F.sum(F.when((v < lo_f) | (v > hi_f), n).otherwise(0)).alias("n_outliers"),
        (F.sum(v * n) / total).alias("mean"),
        F.max(v).alias("max"),
        (F.sum(F.when(v > F.lit(threshold), n).otherwise(0)) / total).alias("share_above"),
    )
    dbl = ["q1", "median", "q3", "whisker_low", "whisker_high", "mean", "max", "share_above"]
    return out.select(*by, "n", "n_outliers", *[round_half_up(c, digits).alias(c) for c in dbl])


def crosstab(df: DataFrame, row: str, col: str, row_order: Sequence[str], col_values: Sequence[str], total: str = "total") -> DataFrame:
    """Counts of row x col with row and column totals, rows in a
    fixed order (absent rows left out, like a reindex over present labels)."""
    cube = df.cube(row, col).agg(F.count(F.lit(1)).alias("n"), F.grouping(row).alias("_gr"), F.grouping(col).alias("_gc"))
    cube = cube.select(
        F.when(F.col("_gr") == 1, F.lit(total)).otherwise(F.col(row)).alias(row),
        F.when(F.col("_gc") == 1, F.lit(total)).otherwise(F.col(col)).alias("_c"),
        "n",
    )
    wide = cube.groupBy(row).pivot("_c", [*col_values, total]).agg(F.first("n"))
    order = F.create_map(*[x for i, r in enumerate([*row_order, total]) for x in (F.lit(r), F.lit(i))])
    return wide.select(
        row,
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in [*col_values, total]],
        order[F.col(row)].cast("bigint").alias("row_order"),
    ).orderBy("row_order")


def dashboard_list(mart: DataFrame, classes: Sequence[str], confidences: Sequence[str]) -> DataFrame:
    """Rank list filtered by magnitude class and confidence."""
    return mart.filter(F.col("effect_class").isin(list(classes)) & F.col("confidence").isin(list(confidences))).orderBy(
        "subject", "year", "rank_in_subject", "school_id"
    )


def study_shortlist(mart: DataFrame, p: Params = Params(), signs: Sequence[str] = ("positive", "negative")) -> DataFrame:
    """Strong and significant schools, prioritised by weight (signal share)
    then rank within (subject, year).  ``signs`` picks strong+ and/or strong-."""
    labels = [p.effect_labels[0]] * ("positive" in signs) + [p.effect_labels[4]] * ("negative" in signs)
    sel = mart.filter(F.col("effect_class").isin(labels) & (F.col("confidence") == p.confidence_labels[0]))
    order = [F.col("weight").desc(), F.col("rank_in_subject").asc(), F.col("school_id").asc()]
    numbered = positions(sel, ["subject", "year"], order, "_before")
    return numbered.withColumn("priority", F.col("_before") + 1).drop("_before", "_before_of")


def monitoring_list(mart: DataFrame, p: Params = Params()) -> DataFrame:
    """Strong effects whose interval still crosses zero."""
    strong = [p.effect_labels[0], p.effect_labels[4]]
    return mart.filter(F.col("effect_class").isin(strong) & (F.col("confidence") == p.confidence_labels[1]))
