"""Order over all rows without one task for all of them.

Rows are dealt to ranges of the wanted order (``repartitionByRange``) and
sorted within each; the result is pinned by a checkpoint, because the bounds of
the ranges come from a sample.  What a row needs from outside its range travels
in a table with one row per (range, group): counts for positions, last rows for
neighbours.  A group that holds most rows is spread over many ranges, and it
has at most one row per range in that table, so the windows over it stay small.

Null groups are groups; the caller says where null order keys go.  Rows alike
in all order keys share a range: add a tie-breaker where many can be alike.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohort_effects.session import ensure_checkpoint_dir, shuffles_freed, work_path

RANGE, AT = "_range", "_at"


def pinned(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder of ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The rows as a Parquet table under ``spark.checkpoint.dir``, read back: later
    readers take the columns they need, and its size is known to the optimizer.  The
    write's shuffle files go at once.  Who names the ``path`` can discard the table."""
    path = path or work_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_ranges(df: DataFrame, order: list[Column], ranges: int | None = None) -> DataFrame:
    """The rows in ranges of ``order``, sorted, with the number of the range and
    a number that grows by one from row to row of a range."""
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    return pinned(
        dealt.sortWithinPartitions(*order)
        .withColumn(RANGE, F.spark_partition_id())
        .withColumn(AT, F.monotonically_increasing_id())
    )


def matched(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``, null equal to null; the right side's keys are dropped."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def _grouped(group: list[str], order: list[Column]) -> list[Column]:
    return [F.col(g).asc_nulls_first() for g in group] + order


def positions(df: DataFrame, group: list[str], order: list[Column], name: str = "position", ranges: int | None = None) -> DataFrame:
    """Adds the row's number (from 0, gapless) within its group in ``order`` and
    the group's rows as ``<name>_of``."""
    rows = in_ranges(df, _grouped(group, order), ranges)
    before = Window.partitionBy(*group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    counts = (
        rows.groupBy(*group, RANGE)
        .agg(F.count("*").alias("_n"), F.min(AT).alias("_first"))
        .withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
        .withColumn(f"{name}_of", F.sum("_n").over(whole))
        .drop("_n", "_first")
    )
    return (
        matched(rows, counts, [*group, RANGE])
        .withColumn(name, F.col(AT) + F.col("_from"))
        .drop(RANGE, AT, "_from")
    )


def running(df: DataFrame, group: list[str], order: list[Column], weight: str, name: str, ranges: int | None = None) -> DataFrame:
    """Adds the sum of ``weight`` over the rows before (in ``order``, within the
    group) and over the whole group as ``<name>_of``."""
    rows = in_ranges(df, _grouped(group, order), ranges)
    inside = Window.partitionBy(*group, RANGE).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    sums = (
        rows.groupBy(*group, RANGE).agg(F.sum(weight).alias("_n"))
        .withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn(f"{name}_of", F.sum("_n").over(whole)).drop("_n")
    )
    own = rows.withColumn("_own", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return matched(own, sums, [*group, RANGE]).withColumn(name, F.col("_own") + F.col("_from")).drop(RANGE, AT, "_own", "_from")


def dense_ranks(
    df: DataFrame, group: list[str], value: str, name: str, descending: bool = True, step: float = 1e-3
) -> DataFrame:
    """Adds the dense rank (from 1) of the number ``value`` within its group,
    null values last.

    The rows are checkpointed first: their values are read twice, and a value
    computed twice may differ in its last bit.  What is numbered are the distinct values (reduced before their shuffle), so a
    value that holds most rows is one row.  They are dealt to slots ``step`` wide;
    a value's rank is its number within (group, slot) plus the values of the slots
    before.  With values rounded to d digits a slot holds at most step * 10 ** d
    of them, however large the group is; the slots of a group are as many as its
    range of values is wide.
    """
    def ordered(c: str) -> Column:
        return F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last()

    df = pinned(df)
    plain = F.col(value).cast("double")
    slot = F.floor(plain / F.lit(step))  # null stays null: the last slot
    values = df.select(*group, value).distinct().withColumn("_slot", slot)
    inside = Window.partitionBy(*group, "_slot").orderBy(ordered(value))
    before = Window.partitionBy(*group).orderBy(ordered("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    slots = (
        values.groupBy(*group, "_slot").agg(F.count("*").alias("_n"))
        .withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    )
    ranks = matched(values.withColumn("_in", F.row_number().over(inside)), slots, [*group, "_slot"])
    ranks = ranks.select(*group, value, (F.col("_from") + F.col("_in")).cast("bigint").alias(name))
    return matched(df, ranks, [*group, value])


def with_previous(
    df: DataFrame, group: list[str], order: list[Column], previous: dict[str, str], ranges: int | None = None
) -> DataFrame:
    """Adds, for each new column of ``previous``, the named column's value in
    the row before (null in a group's first row).  The last row of a range is
    carried to the next range that has rows of the group."""
    rows = in_ranges(df, _grouped(group, order), ranges)
    inside = Window.partitionBy(*group, RANGE).orderBy(AT)
    across = Window.partitionBy(*group).orderBy(RANGE)
    held = F.struct(*[F.col(c).alias(new) for new, c in previous.items()])
    carried = (
        rows.groupBy(*group, RANGE)
        .agg(F.max_by(held, F.col(AT)).alias("_last"), F.min(AT).alias(AT))
        .withColumn("_carried", F.lag("_last").over(across))
        .drop("_last")
    )
    return (
        matched(rows.withColumn("_own", F.lag(held).over(inside)), carried, [*group, RANGE, AT], "left")
        .withColumn("_prev", F.coalesce("_own", "_carried"))
        .select(*df.columns, *[F.col(f"_prev.{new}").alias(new) for new in previous])
    )
