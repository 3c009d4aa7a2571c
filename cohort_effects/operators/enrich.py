"""Bridges and score enrichment (M5-M7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohort_effects.operators.dedup import min_per_key
from cohort_effects.operators.effects import plain_keys
from cohort_effects.operators.ranges import written
from cohort_effects.operators.reshape import melt_measures


def class_school_bridge(att: DataFrame, class_col: str = "class_id", school_col: str = "school_id") -> DataFrame:
    """M5: distinct non-null (class, school) pairs.

    Deliberately *not* forced to one school per class: a class seen in two
    schools fans the later left join out, exactly as the unique test expects
    to catch.  ``distinct`` aggregates map-side first, so the shuffle carries
    at most one row per pair per task.
    """
    return (
        att.select(class_col, school_col)
        .filter(F.col(class_col).isNotNull() & F.col(school_col).isNotNull())
        .distinct()
    )


def class_year(classes: DataFrame, class_col: str = "class_id", year_col: str = "year") -> DataFrame:
    """M6: lowest year per class (same result as keep-first by year)."""
    return min_per_key(
        classes.filter(F.col(class_col).isNotNull() & F.col(year_col).isNotNull()), class_col, year_col
    )


def attach_context(
    scores: DataFrame,
    bridge: DataFrame,
    years: DataFrame,
    subject_map: Mapping[str, str],
    ids: Sequence[str] = ("student_id", "class_id", "term"),
    statistics: bool = False,
    deal: Sequence[str] = (),
) -> DataFrame:
    """Add school and year to clean scores (left joins keep orphans), then
    unpivot to one row per (student, term, subject) grade.

    The joins run on the wide rows -- one per (student, term) -- before the
    unpivot multiplies them by the number of subjects, so the join probes a
    third as many rows (a bridge fan-out is carried through the unpivot
    unchanged).  Join strategy is left to the optimizer: AQE broadcasts a
    side only after measuring it at run time, and splits skewed class
    partitions otherwise.

    ``statistics`` adds each (student, year)'s ``STATISTICS`` on the way, from the wide
    rows too (``with_statistics``).  The wide rows are written with them: readers unpivot
    what they read.

    ``deal`` names ids by which the wide rows are dealt; the long ones stay where they
    are, so a grouping by these ids and others moves no long row.
    """
    missing = [m for m in subject_map if m not in scores.columns]
    if missing:
        raise ValueError(f"score columns declared but not there: {missing}")
    measures = dict(subject_map)
    wide = scores.select(*ids, *measures).join(bridge, "class_id", "left").join(years, "class_id", "left")
    if statistics:
        wide = written(with_statistics(wide, measures), "context")
    if deal:
        wide = wide.repartition(*deal)
    found = STATISTICS if statistics else ()
    long = melt_measures(wide, [*ids, "school_id", "year", *found], measures, "subject", "grade", stay=bool(deal))
    return long.select(*ids, "subject", "grade", "school_id", "year", *found)


STATISTICS = ("student_mean", "n_obs_student", "n_groups", "multi_school")


def with_statistics(
    wide: DataFrame, measures: Mapping[str, str], entity: Sequence[str] = ("student_id", "year"), target: str = "school_id"
) -> DataFrame:
    """What ``multi_flag_stats`` and ``effects.demean`` say of an entity's melted rows,
    from the rows before the unpivot, a fraction of them: mean and number of the grades,
    number of distinct subjects, and whether there is more than one ``target``.  Rows
    without any grade are none after the unpivot; they count for nothing and go.

    A null in ``entity`` is a group.  The rows are dealt by the entity once and the
    statistics made where they lie: an entity has few of these rows, one a term and
    school.  They are sorted by a hash of it first: sorts compare a number instead of ids
    that begin alike.
    """
    there = {m: F.col(m).isNotNull() for m in measures}
    names = sorted(set(measures.values()))
    src = wide.where(reduce(lambda a, b: a | b, there.values())).repartition(*entity).withColumn("_key_hash", F.xxhash64(*entity))
    n = F.sum(reduce(lambda a, b: a + b, [t.cast("bigint") for t in there.values()]))
    total = F.sum(reduce(lambda a, b: a + b, [F.coalesce(F.col(m).cast("double"), F.lit(0.0)) for m in measures]))
    has = [F.max(reduce(lambda a, b: a | b, [there[m] for m in measures if measures[m] == name]).cast("int")) for name in names]
    mine = Window.partitionBy("_key_hash", *entity)
    return src.select(
        "*",
        (total.over(mine) / n.over(mine)).alias("student_mean"),
        n.over(mine).alias("n_obs_student"),
        reduce(lambda a, b: a + b, [h.over(mine) for h in has]).alias("n_groups"),
        F.coalesce(F.min(target).over(mine) != F.max(target).over(mine), F.lit(False)).alias("multi_school"),
    ).drop("_key_hash")


def multi_flag_stats(df: DataFrame, entity: Sequence[str], target: str, flag: str) -> DataFrame:
    """Per-entity flag "more than one distinct non-null ``target``".

    Spark has no DISTINCT window; with a grouping aggregate ``min != max``
    answers ">1 distinct" exactly, carries constant state, and aggregates
    partially before the shuffle, so a hot entity is pre-reduced map-side.
    """
    return df.groupBy(*entity).agg(
        F.coalesce(F.min(target) != F.max(target), F.lit(False)).alias(flag)
    )


def enrich_scores(
    scores: DataFrame,
    bridge: DataFrame | None,
    years: DataFrame | None,
    subject_map: Mapping[str, str],
    attached: bool = False,
) -> DataFrame:
    """M7: (student, term, subject) grades with school, year and the
    multi-school flag (student in 2+ schools in the same year; NULL year is
    its own group, as in a window partition).  With ``attached=True``,
    ``scores`` is already the output of ``attach_context``; the flag is taken from its
    statistics, if it has them."""
    ctx = scores if attached else attach_context(scores, bridge, years, subject_map)
    columns = ["student_id", "term", "subject", "class_id", "school_id", "year", "grade", "multi_school"]
    if "multi_school" in ctx.columns:
        return ctx.select(*columns)
    # NULL student or year is its own group, as in a window partition; joined on plain
    # equality with one row a group, the flag costs readers nothing that do not read it
    ctx, keys = plain_keys(ctx, ["student_id", "year"])
    out = ctx.join(multi_flag_stats(ctx, keys, "school_id", "multi_school"), keys, "left")
    return out.select(*columns)


def flag_unknown(df: DataFrame, roster: DataFrame, key: str = "class_id", flag: str = "unknown_class") -> DataFrame:
    """Mark rows whose key is absent from the roster (left join against
    the roster's distinct keys, so no fan-out)."""
    keys = roster.select(F.col(key).alias("_k")).filter(F.col("_k").isNotNull()).distinct().withColumn("_m", F.lit(True))
    j = df.join(keys, df[key] == F.col("_k"), "left")
    return j.withColumn(flag, F.col("_m").isNull()).drop("_k", "_m")
