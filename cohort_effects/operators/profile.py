"""Profiling operators (E1-E12, A11-A15, T-2..T-5).

Each table is scanned once per report: per-column statistics are built as
one aggregate (or one unpivot + grouping), never a loop of per-column jobs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_effects.operators import quantiles
from cohort_effects.operators.ranges import matched, pinned


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _stack(agg: DataFrame, items: Sequence[tuple[str, str]], names: str, carry: Sequence[str] = ()) -> DataFrame:
    """Turn one wide row into rows: items are (label, column-in-agg);
    ``carry`` columns are repeated on every row."""
    body = ", ".join(f"'{lab}', `{col}`" for lab, col in items)
    return agg.selectExpr(*[f"`{c}`" for c in carry], f"stack({len(items)}, {body}) as ({names})")


def column_profile(df: DataFrame, table: str, nulls_as_value: bool = False, with_dtype: bool = False) -> DataFrame:
    """Per column null share, distinct count and share of the mode.

    One pass: the table is unpivoted to (column, value-as-string) and grouped
    by (column, value) -- a partial aggregate, so the shuffle carries one row
    per distinct value per task.  ``nulls_as_value`` counts NULL as a value in
    the distinct count and the mode (the two conventions found in practice).
    """
    cols = df.columns

    def as_text(f):
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = c + F.lit(0.0)  # -0.0 and 0.0 are one value
        c = c.cast("string")
        if isinstance(f.dataType, (T.StringType, T.ArrayType)):  # long values group by their digest
            c = F.when(F.length(c) > 32, F.md5(c)).otherwise(c)
        return c

    texts = df.select(*[as_text(f).alias(f.name) for f in df.schema.fields])
    long = texts.unpivot([], cols, "column_name", "v")  # one Expand, no per-row arrays
    per_value = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    counted = per_value if nulls_as_value else per_value.filter(F.col("v").isNotNull())
    stats = per_value.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
    )
    modes = counted.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("nunique"), F.max("n").alias("n_mode")
    )
    out = stats.join(modes, "column_name", "left").select(
        F.lit(table).alias("table_name"),
        "column_name",
        F.col("n_rows").cast("bigint").alias("n_rows"),
        F.try_divide(F.col("n_null").cast("double"), F.col("n_rows").cast("double")).alias("pct_null"),
        F.coalesce("nunique", F.lit(0)).cast("bigint").alias("nunique"),
        F.coalesce(F.try_divide(F.col("n_mode").cast("double"), F.col("n_rows").cast("double")), F.lit(0.0)).alias("pct_mode"),
    )
    if with_dtype:
        types = df.sparkSession.createDataFrame(
            [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column_name string, dtype string"
        )
        out = out.join(F.broadcast(types), "column_name")  # one row per column
    return out


def grain_report(grains: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows, distinct keys and duplicates per declared grain (NULL keys
    count as a value, like DISTINCT).  One grouping per grain: rows per key,
    then the number of keys and the sum of rows."""
    parts = []
    for label, df, keys in grains:
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
        parts.append(
            per_key.agg(F.sum("_c").cast("bigint").alias("total"), F.count(F.lit(1)).alias("n_distinct")).select(
                F.lit(label).alias("grain"), "total", "n_distinct", (F.col("total") - F.col("n_distinct")).alias("duplicates")
            )
        )
    return _union(parts)


def distinct_sorted(df: DataFrame, col: Column | str, name: str = "period") -> DataFrame:
    """Distinct values, sorted."""
    c = F.col(col) if isinstance(col, str) else col
    return df.select(c.alias(name)).distinct().orderBy(name)


def fk_match_report(fks: Sequence[tuple[str, DataFrame, str, str, DataFrame, str]]) -> DataFrame:
    """For each (child, col) -> (parent, col): child rows, rows without
    a parent (a NULL key never matches) and their share.

    A child is scanned once for all its keys, a parent once for all its children:
    each row becomes one (foreign key, value) per key it takes part in, and one
    grouping, with partial sums before its shuffle, counts the child rows of a
    value and notes whether a parent has it.  A value that most rows hold is one
    row a task, and no join multiplies or skews.  Keys are compared as text, so
    child and parent column should be of one kind.
    """
    children, parents = {}, {}
    for k, (cname, child, ccol, pname, parent, pcol) in enumerate(fks):
        children.setdefault(cname, (child, []))[1].append((k, ccol))
        parents.setdefault((pname, pcol), (parent, []))[1].append((k, pcol))

    def stacked(df: DataFrame, keys: list[tuple[int, str]], there: bool) -> DataFrame:
        each = F.array(*[F.struct(F.lit(k).alias("fk"), F.col(c).cast("string").alias("key")) for k, c in keys])
        return df.select(F.inline(each)).select("fk", "key", F.lit(int(not there)).cast("bigint").alias("n"), F.lit(there).alias("there"))

    rows = _union([stacked(df, keys, False) for df, keys in children.values()] + [stacked(df, keys, True) for df, keys in parents.values()])
    values = rows.groupBy("fk", "key").agg(F.sum("n").alias("n"), F.bool_or("there").alias("there"))
    orphan = F.col("key").isNull() | ~F.col("there")
    counts = values.groupBy("fk").agg(F.sum("n").alias("n_child"), F.sum(F.when(orphan, F.col("n")).otherwise(0)).alias("n_orphans"))
    names = rows.sparkSession.range(len(fks)).select(F.col("id").cast("int").alias("fk"))  # also those without a row
    named = [F.element_at(F.array(*[F.lit(f[j]) for f in fks]), F.col("fk") + 1) for j in (0, 2, 3)]
    n, lost = F.coalesce("n_child", F.lit(0)).cast("bigint"), F.coalesce("n_orphans", F.lit(0)).cast("bigint")
    return names.join(counts, "fk", "left").select(
        *[c.alias(a) for c, a in zip(named, ("child", "fk", "parent"), strict=True)], n.alias("n_child"), lost.alias("n_orphans"),
        F.try_divide(lost.cast("double"), n.cast("double")).alias("orphan_rate"),
    )


def rule_report(tables: Sequence[tuple[str, DataFrame, Sequence[tuple[str, Column]]]]) -> DataFrame:
    """Violations per rule, all rules of a table in one pass."""
    parts = []
    for tname, df, rules in tables:
        agg = df.agg(
            F.count(F.lit(1)).alias("_total"),
            *[F.count_if(pred).alias(f"r{i}") for i, (_, pred) in enumerate(rules)],
        )
        long = _stack(agg, [(name, f"r{i}") for i, (name, _) in enumerate(rules)], "rule, violations", ["_total"])
        parts.append(
            long.select(
                F.lit(tname).alias("table_name"),
                "rule",
                F.col("violations").cast("bigint").alias("violations"),
                F.col("_total").alias("total"),
                F.try_divide(F.col("violations").cast("double"), F.col("_total").cast("double")).alias("pct"),
            )
        )
    return _union(parts)


def out_of_range(col: str, lo, hi) -> Column:
    """(c < lo) or (c > hi); NULL is not a violation."""
    c = F.col(col)
    return c.isNotNull() & ((c < F.lit(lo)) | (c > F.lit(hi)))


def period_counts(df: DataFrame, ts: Column, unit: str = "month", name: str = "period") -> DataFrame:
    """Rows per truncated period."""
    return df.groupBy(F.date_trunc(unit, ts).cast("date").alias(name)).agg(F.count(F.lit(1)).alias("n_rows"))


def count_multi(df: DataFrame, group: str, target: str) -> DataFrame:
    """Number of ``group`` values seen with more than one distinct
    ``target``; pairs are de-duplicated map-side first."""
    return (
        df.select(group, target)
        .distinct()
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .agg(F.count(F.lit(1)).alias("n_entities"))
    )


def pointer_coherence(df: DataFrame, roster: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key tuple is missing from the roster (left join with
    a match indicator)."""
    r = roster.select(*keys).distinct().withColumn("_m", F.lit(1))
    j = df.select(*keys).join(r, list(keys), "left")
    return j.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("_m").isNull()).alias("n_unmatched"))


def distinct_count(df: DataFrame, cols: Sequence[Column | str], label: str) -> DataFrame:
    """One (grain, n_rows) row: distinct tuples of ``cols``."""
    return df.select(*cols).distinct().agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(label).alias("grain"), "n_rows"
    )


def counts_by_value(df: DataFrame, col: str, by: Sequence[str] = (), digits: int = 9) -> DataFrame:
    """Rows per (``by``, value ``v``).  Values are snapped to ``digits`` so that
    sums added in another order are still the same value; what reads this twice
    shares its exchange."""
    kind = df.schema[col].dataType
    snap = F.round(F.col(col), digits) + F.lit(0.0) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.col(col)
    return df.where(F.col(col).isNotNull()).groupBy(*by, snap.alias("v")).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, col: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between each group's min and max.

    The bin is ``floor((v - min) / (max - min) * bins) + 1`` with the maximum
    folded into the last bin (what ``width_bucket`` would put in bins + 1).
    The values are counted first; range and bins both come from those counts,
    one row per distinct value, joined without a hint.
    """
    keys = list(by) or ["_all"]
    src = df if by else df.withColumn("_all", F.lit(0))
    vals = counts_by_value(src, col, keys)
    rng = vals.groupBy(*keys).agg(F.min("v").alias("_lo"), F.max("v").alias("_hi"))
    j = vals.join(rng, keys)
    width = F.col("_hi") - F.col("_lo")
    raw = F.floor((F.col("v") - F.col("_lo")) / width * F.lit(float(bins))) + F.lit(1)
    b = F.when(width == 0, F.lit(1)).otherwise(F.greatest(F.lit(1), F.least(raw, F.lit(bins)))).cast("bigint")
    out = j.groupBy(*by, b.alias("bin"), "_lo", "_hi").agg(F.sum("n").cast("bigint").alias("n"))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return out.select(
        *by,
        "bin",
        (F.col("_lo") + (F.col("bin") - 1) * w).alias("bin_low"),
        (F.col("_lo") + F.col("bin") * w).alias("bin_high"),
        "n",
    )


def null_shares(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Long (table_name, column_name, pct_null): one aggregate per table."""
    parts = []
    for tname, df in tables.items():
        agg = df.agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)],
        )
        long = _stack(agg, [(c, f"c{i}") for i, c in enumerate(df.columns)], "column_name, n_null", ["_n"])
        parts.append(
            long.select(
                F.lit(tname).alias("table_name"),
                "column_name",
                F.try_divide(F.col("n_null").cast("double"), F.col("_n").cast("double")).alias("pct_null"),
            )
        )
    return _union(parts)


def null_heat(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Null share pivoted to column x table (the table list is known,
    so the pivot needs no extra distinct pass)."""
    long = null_shares(tables)
    return long.groupBy("column_name").pivot("table_name", list(tables)).agg(F.first("pct_null"))


def top_null_columns(tables: Mapping[str, DataFrame], n: int = 10) -> DataFrame:
    """T-2: the n columns with the highest null share (ties by name)."""
    return null_shares(tables).orderBy(F.desc("pct_null"), "table_name", "column_name").limit(n)


def id_overlap(left: DataFrame, lcol: str, right: DataFrame, rcol: str) -> DataFrame:
    """Sizes of two id sets and of their intersection, from one full
    outer join of the two distinct sets."""
    a = left.select(F.col(lcol).alias("id")).filter(F.col("id").isNotNull()).distinct().withColumn("_a", F.lit(True))
    b = right.select(F.col(rcol).alias("id")).filter(F.col("id").isNotNull()).distinct().withColumn("_b", F.lit(True))
    j = a.join(b, "id", "full_outer")
    return j.agg(
        F.count_if(F.col("_a").isNotNull()).alias("n_left"),
        F.count_if(F.col("_b").isNotNull()).alias("n_right"),
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("n_overlap"),
    )


def value_counts(df: DataFrame, col: Column | str, name: str = "value") -> DataFrame:
    """Frequency table (NULL kept as a value)."""
    c = F.col(col) if isinstance(col, str) else col
    return df.groupBy(c.alias(name)).agg(F.count(F.lit(1)).alias("n_rows"))


def mode(df: DataFrame, col: str) -> DataFrame:
    """T-5: most frequent non-null value (ties: smallest value).  The top-1
    is taken per partition and merged, never in one task."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.desc("n_rows"), F.asc(col))
        .limit(1)
    )


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """T-4: keep about ``fraction`` of the rows, each row decided by a hash of
    its values and the seed.  Unlike a per-partition random sampler the
    choice does not depend on row order, so a retried task (after a lost
    executor) keeps exactly the same rows.  No shuffle."""
    scale = 1 << 30
    h = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns], F.lit(seed)), F.lit(scale))
    return df.filter(h < F.lit(int(fraction * scale)))


def sample_files(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """T-4 as a system sample: keep all rows of about ``fraction`` of the files of
    a scan, each file decided by a hash of its name and the seed.  The condition
    holds for a whole file, so the scan leaves the others out before it opens
    them; the choice is the same in every run and retry."""
    scale = 1 << 30
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return df.where(F.pmod(F.xxhash64(name, F.lit(seed)), F.lit(scale)) < F.lit(int(fraction * scale)))


def sample_per_group(df: DataFrame, by: Sequence[str], key: str, n: int) -> DataFrame:
    """T-4: a repeatable sample of exactly n rows per group (all, if fewer): those
    with the smallest md5 of ``key``.  Every task keeps its n smallest per group
    before the shuffle, so a group that holds most rows is cut where it is read."""
    w = Window.partitionBy(*by).orderBy(F.md5(F.col(key).cast("string")), F.col(key))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def sample_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """T-4: a repeatable sample of n rows, ordered by md5 of the key (top-n
    per partition, then merged)."""
    return df.orderBy(F.md5(F.col(key).cast("string")), F.col(key)).limit(n)


def numeric_summary(df: DataFrame, col: str, probs: Sequence[float] = (0.01, 0.5, 0.99), sketch: int | None = None) -> DataFrame:
    """Min, quantiles (values of the column), mean, max, sample stddev.

    The quantiles are exact, found over ranges of the counted values; with
    ``sketch`` (an accuracy) they come from ``percentile_approx`` in the same
    pass, with a rank error of 1 / sketch.
    """
    plain = [F.count(col).alias("n"), F.min(col).alias("min"), F.avg(col).alias("mean"), F.max(col).alias("max"), F.stddev_samp(col).alias("std")]
    if sketch:
        agg = df.agg(*plain, F.percentile_approx(col, list(probs), sketch).alias("_q"))
    else:
        df = pinned(df.select(col))
        counts = counts_by_value(df, col, digits=15).withColumn("_all", F.lit(0))
        q = quantiles.exact(counts, ["_all"], "v", "n", list(probs), linear=False).withColumnRenamed("quantiles", "_q")
        agg = matched(df.agg(*plain).withColumn("_all", F.lit(0)), q, ["_all"], "left")  # one row each
    names = [f"p{int(round(p * 100)):02d}" for p in probs]
    return agg.select("n", "min", *[F.col("_q")[i].alias(nm) for i, nm in enumerate(names)], "mean", "max", "std")
