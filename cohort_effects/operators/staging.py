"""Staging cleaners M1-M4: typed, renamed, de-duplicated source tables.

Raw column names are parameters; the defaults are the names used by the
fixture adapters in ``cohort_effects.plans.fixtures``.  Cleaning happens before
de-duplication so the dedup keys are the cleaned columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_effects.functions import hex_id, parse_date, round_double, safe_int, trim_ws
from cohort_effects.operators.dedup import keep_first

SCORE_MEASURES = ("subject_1", "subject_2", "subject_3", "subject_4")


def clean_students(
    raw: DataFrame,
    student: str = "student_key",
    age_band: str = "age_band",
    district: str = "district",
    class_id: str | None = None,
) -> DataFrame:
    """M1: one row per student; no de-duplication."""
    cols = [hex_id(student).alias("student_id")]
    if class_id:
        cols.append(safe_int(class_id).alias("class_id"))
    cols += [trim_ws(age_band).alias("age_band"), safe_int(district).alias("district")]
    return raw.select(*cols)


def clean_scores(
    raw: DataFrame,
    student: str = "student_key",
    term: str = "term",
    class_id: str = "class_id",
    measures: Sequence[str] = SCORE_MEASURES,
) -> DataFrame:
    """M2: one row per (student_id, term).

    Collisions keep the row with the lowest class, then lowest measures in
    column order, NULLs last.
    """
    typed = raw.select(
        hex_id(student).alias("student_id"),
        safe_int(term).alias("term"),
        safe_int(class_id).alias("class_id"),
        *[round_double(m, 2).alias(m) for m in measures],
    )
    return keep_first(typed, ["student_id", "term"], ["class_id", *measures], deal=True)


def clean_attendance(
    raw: DataFrame,
    student: str = "student_key",
    class_id: str = "class_id",
    subject: str = "subject",
    start: str = "start",
    school: str = "school_id",
    end: str = "end",
    pct: str = "pct",
) -> DataFrame:
    """M3: one row per (student_id, class_id, subject, start_date).

    Collisions keep the lowest attendance, then earliest end, then lowest
    school, NULLs last.
    """
    typed = raw.select(
        hex_id(student).alias("student_id"),
        safe_int(class_id).alias("class_id"),
        trim_ws(subject).alias("subject"),
        parse_date(start).alias("start_date"),
        safe_int(school).alias("school_id"),
        parse_date(end).alias("end_date"),
        round_double(pct, 2).alias("pct"),
    )
    return keep_first(
        typed, ["student_id", "class_id", "subject", "start_date"], ["pct", "end_date", "school_id"], deal=True
    )


def clean_classes(
    raw: DataFrame, student: str = "student_key", class_id: str = "class_id", year: str = "year"
) -> DataFrame:
    """M4: class roster, one row per (student_id, class_id)."""
    return raw.select(
        hex_id(student).alias("student_id"),
        safe_int(class_id).alias("class_id"),
        safe_int(year).alias("year"),
    )

