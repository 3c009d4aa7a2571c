"""Adapters that derive school-shaped raw tables from the driver's tables.

One observation is one ``lineitem`` row: student = order, class = (supplier,
ship year), school = supplier, term = ship quarter.  The modulo rules below
do not thin the data; they plant the gaps real sources have (missing
grades, classes without a school, roster rows without a class) so the orphan, NULL and
fan-out logic is exercised.  Every row of the source table flows through.
The same formulas appear in ``cohort_effects.plans.oracle`` as DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _key(col: str):
    # binary id, like the source tables' salted-hash ids
    return F.encode(F.col(col).cast("string"), "UTF-8")


def raw_score(lineitem: DataFrame) -> DataFrame:
    q = F.quarter("l_shipdate")
    return lineitem.select(
        _key("l_orderkey").alias("student_key"),
        q.cast("string").alias("term"),
        (F.col("l_suppkey") * 10000 + F.year("l_shipdate")).alias("class_id"),
        F.when((F.col("l_orderkey") + q) % 17 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("l_quantity") / 5.0)
        .alias("subject_1"),
        (F.col("l_discount") * 100).alias("subject_2"),
        F.lit(None).cast("double").alias("subject_3"),
        (F.col("l_tax") * 100).alias("subject_4"),
    )


def raw_attendance(lineitem: DataFrame) -> DataFrame:
    d = F.to_date("l_shipdate")
    return lineitem.select(
        F.when(F.col("l_suppkey") % 20 == 0, F.lit(None).cast("bigint"))
        .otherwise(F.col("l_suppkey"))
        .alias("school_id"),
        _key("l_orderkey").alias("student_key"),
        (F.col("l_suppkey") * 10000 + F.year("l_shipdate")).alias("class_id"),
        F.trunc(d, "month").cast("string").alias("start"),
        F.last_day(d).cast("string").alias("end"),
        F.concat(F.lit("subject_"), (F.col("l_linenumber") % 4 + 1).cast("string")).alias("subject"),
        (F.lit(100.0) - F.col("l_discount") * 10).alias("pct"),
    )


def raw_class(lineitem: DataFrame) -> DataFrame:
    return (
        lineitem.select(
            F.year("l_shipdate").cast("bigint").alias("year"),
            F.when(F.col("l_suppkey") % 33 != 0, F.col("l_suppkey") * 10000 + F.year("l_shipdate")).alias("class_id"),
            _key("l_orderkey").alias("student_key"),
        )
        .distinct()
    )


def raw_student(orders: DataFrame, customer: DataFrame) -> DataFrame:
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "inner").select(
        _key("o_orderkey").alias("student_key"),
        F.col("o_orderpriority").alias("age_band"),
        F.col("c_nationkey").alias("district"),
    )
