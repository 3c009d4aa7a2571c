"""Data-quality operators (Q1-Q19).

A check is a query that returns failing rows: zero rows means pass.  The
operators below return those rows; ``run_checks`` turns a list of checks
into one result table (check, kind, severity, failures, status).  Row-level
checks on the same table (not-null, between, mean/stdev) are fused into a
single aggregate pass over that table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_effects.operators.ranges import with_previous, written

# ---------------------------------------------------------------------------
# Failing-row operators
# ---------------------------------------------------------------------------


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Q1."""
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Q2: duplicated non-null values (one row per value)."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q3: duplicated key combinations; NULL equals NULL (grouping semantics)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Q4: distinct values outside the set; NULL passes."""
    return (
        df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationships(child: DataFrame, ccol: str, parent: DataFrame, pcol: str, counted: bool = False) -> DataFrame:
    """Child rows whose non-null key has no parent (anti join).

    The parent side is reduced to its distinct keys first; the optimizer
    broadcasts it only if its measured size is under the threshold.

    ``counted`` gives a row a key with its number of child rows, ``n_records``: both
    sides' keys are stacked and grouped, reduced where they are read, not sorted or joined.
    """
    if counted:
        stacked = child.select(F.col(ccol).alias(ccol), F.lit(1).cast("bigint").alias("_rows"))
        if child.schema[ccol].dataType != parent.schema[pcol].dataType:  # compared as the join would
            return relationships(child, ccol, parent, pcol).groupBy(ccol).agg(F.count(F.lit(1)).alias("n_records"))
        stacked = stacked.unionAll(parent.select(F.col(pcol).alias(ccol), F.lit(0).cast("bigint").alias("_rows")))
        sums = stacked.where(F.col(ccol).isNotNull()).groupBy(ccol).agg(
            F.sum("_rows").alias("n_records"), F.min("_rows").alias("_parentless")
        )
        return sums.where("_parentless = 1").drop("_parentless")
    keys = parent.select(F.col(pcol).alias("_pk")).filter(F.col("_pk").isNotNull()).distinct()
    return child.filter(F.col(ccol).isNotNull()).join(keys, F.col(ccol) == F.col("_pk"), "left_anti")


def _outside(col: str, lo=None, hi=None):
    c = F.col(col)
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < F.lit(lo))
    if hi is not None:
        cond = cond | (c > F.lit(hi))
    return c.isNotNull() & cond


def between(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Q6: values outside [lo, hi] (inclusive; open ends; NULL passes)."""
    return df.filter(_outside(col, lo, hi))


def _stat_outside(stat, lo, hi):
    return ~((stat >= F.lit(lo)) & (stat <= F.lit(hi)))


def mean_between(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Q7: one failing row when the mean is outside [lo, hi]."""
    return df.agg(F.avg(col).alias("value")).filter(_stat_outside(F.col("value"), lo, hi))


def stdev_between(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Q8: same with the sample standard deviation."""
    return df.agg(F.stddev_samp(col).alias("value")).filter(_stat_outside(F.col("value"), lo, hi))


def zero_sum(df: DataFrame, entity: Sequence[str], col: str, tol: float = 1e-6) -> DataFrame:
    """Q9: entities whose demeaned values do not average to zero."""
    return (
        df.groupBy(*entity)
        .agg(F.avg(col).alias("avg_value"))
        .filter(F.abs(F.col("avg_value")) > F.lit(tol))
    )


def drops(df: DataFrame, by: Sequence[str], order: Sequence[str], col: str, tol: float = 1e-6) -> DataFrame:
    """Every row's ``by``, ``order`` and ``col`` with ``prev_value``, the ``col``
    of the row before in ``order`` within ``by`` (null first), and whether it
    ``dropped`` below that minus ``tol``.  The order is dealt to ranges
    (``ranges.with_previous``); a range's last row is carried to the next."""
    rows = with_previous(
        df.select(*by, *order, col), list(by), [F.col(o).asc_nulls_first() for o in order], {"prev_value": col}
    )
    return rows.withColumn("dropped", F.coalesce(F.col(col) < F.col("prev_value") - F.lit(tol), F.lit(False)))


def monotone(
    df: DataFrame, by: Sequence[str], order: Sequence[str], col: str, tol: float = 1e-6
) -> DataFrame:
    """Q10: rows where ``col`` drops below the previous row's value (minus
    ``tol``) in ``order`` within ``by``."""
    return drops(df, by, order, col, tol).where("dropped").drop("dropped")


def row_conservation(
    mart: DataFrame, detail: DataFrame, by: Sequence[str] = ("subject", "year"), group_col: str = "school_id"
) -> DataFrame:
    """Per group, the observations the mart claims against the detail
    rows that have a ``group_col``.  Both sides are stacked and summed in one
    grouping; a group that one side lacks keeps NULL there and is a mismatch."""
    none = F.lit(None).cast("bigint")
    claimed = mart.select(*by, F.col("n_obs").cast("bigint").alias("n_obs_mart"), none.alias("n_obs_int"))
    there = detail.where(F.col(group_col).isNotNull()).select(*by, none.alias("n_obs_mart"), F.lit(1).cast("bigint").alias("n_obs_int"))
    sums = claimed.unionByName(there).groupBy(*by).agg(F.sum("n_obs_mart").alias("n_obs_mart"), F.sum("n_obs_int").alias("n_obs_int"))
    return sums.withColumn("mismatch", ~F.col("n_obs_mart").eqNullSafe(F.col("n_obs_int")))


def term_gaps(
    df: DataFrame, by: Sequence[str] = ("student_id", "year", "subject"), term: str = "term", deal: bool = False
) -> DataFrame:
    """Q14/A10: groups whose observed terms are not 1..max (distinct count
    differs from the maximum).

    Terms of 1 to 62 are counted as bits, in one shuffle and with constant state; the
    others, if any, are made distinct as rows.  A group's two parts are then added up,
    where they already lie together.

    ``deal`` sends the rows by the first of ``by`` alone: rows that follow each other in a
    written table stay together and are packed to a fraction in the shuffle.  Right where
    one value has few rows (a student).  The number of parts is given: merged by their
    packed size, they would be too large to group in memory.
    """
    t = F.col(term)
    if deal:
        df = df.select(*by, term).repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), by[0])
    if not isinstance(df.schema[term].dataType, T.IntegralType):
        per = df.filter(t.isNotNull()).groupBy(*by).agg(F.countDistinct(t).alias("n_terms"), F.max(t).alias("max_term"))
        return per.filter(F.col("n_terms") != F.col("max_term"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (t - 1).cast("int"))
    near = df.filter(t.between(1, 62)).groupBy(*by).agg(F.bit_count(F.bit_or(bit)).cast("bigint").alias("n_terms"), F.max(t).alias("max_term"))
    far = df.filter((t < 1) | (t > 62)).groupBy(*by).agg(F.countDistinct(t).alias("n_terms"), F.max(t).alias("max_term"))
    per = near.unionByName(far).groupBy(*by).agg(F.sum("n_terms").alias("n_terms"), F.max("max_term").alias("max_term"))
    return per.filter(F.col("n_terms") != F.col("max_term"))


def one_value_per_key(df: DataFrame, key: str = "class_id", value: str = "year") -> DataFrame:
    """Keys with more than one distinct non-null value."""
    return (
        df.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
        .groupBy(key)
        .agg(F.countDistinct(value).alias("n_values"))
        .filter(F.col("n_values") > 1)
    )


def orphan_share_rows(df: DataFrame, col: str) -> DataFrame:
    """Rows with NULL ``col``, total rows and their share (one row)."""
    return df.agg(
        F.count_if(F.col(col).isNull()).alias("n_orphans"),
        F.count(F.lit(1)).alias("n_total"),
    ).withColumn("pct_orphans", F.try_divide(F.col("n_orphans").cast("double"), F.col("n_total").cast("double")))


def orphan_share_groups(df: DataFrame, group: str, col: str) -> DataFrame:
    """Groups whose ``col`` is NULL on every row, over all groups."""
    per = df.filter(F.col(group).isNotNull()).groupBy(group).agg(
        F.max(F.col(col).isNotNull().cast("int")).alias("has_value")
    )
    return per.agg(
        F.count_if(F.col("has_value") == 0).alias("n_orphans"),
        F.count(F.lit(1)).alias("n_total"),
    ).withColumn("pct_orphans", F.try_divide(F.col("n_orphans").cast("double"), F.col("n_total").cast("double")))


def over_share(stat: DataFrame, max_share: float) -> DataFrame:
    return stat.filter(F.col("pct_orphans") > F.lit(max_share))


# ---------------------------------------------------------------------------
# Contracts (Q12, Q13)
# ---------------------------------------------------------------------------


class ContractError(ValueError):
    pass


def enforce_contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Q12: names, types and order must match exactly.

    ``DataFrame.to`` would silently up-cast (e.g. bigint -> string), so types
    are compared here first; then ``to`` applies the declared nullability
    and field metadata (descriptions, sensitivity tags).
    """
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in schema.fields]
    if [n for n, _ in got] != [n for n, _ in want]:
        raise ContractError(f"column names/order differ: {[n for n, _ in got]} != {[n for n, _ in want]}")
    for (n, a), (_, b) in zip(got, want):
        if a != b:
            raise ContractError(f"column {n}: type {a.simpleString()} != contract {b.simpleString()}")
    relaxed = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])
    return df.to(relaxed)


def source_drift(df: DataFrame, schema: T.StructType) -> list[tuple[str, str, str]]:
    """S3: compare a source's schema to its declared input contract.

    Returns (column, issue, detail) for missing, retyped and undeclared
    columns -- schema metadata only, nothing is scanned.
    """
    got = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    out = []
    for name, dtype in want.items():
        if name not in got:
            out.append((name, "missing", dtype.simpleString()))
        elif got[name] != dtype:
            out.append((name, "type", f"{got[name].simpleString()} != {dtype.simpleString()}"))
    out += [(n, "undeclared", got[n].simpleString()) for n in got if n not in want]
    return out


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q13: NULL count per column in one pass, as (column_name, n_null)."""
    cols = list(cols or df.columns)
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, n_null)")


def assert_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q13 at materialisation: fail the write itself if a NOT NULL column
    holds a NULL (``assert_true`` raises inside the task, before commit)."""
    checks = [F.assert_true(F.col(c).isNotNull(), f"NOT NULL violated: {c}") for c in cols]
    if not checks:
        return df
    # assert_true yields NULL when the row passes; used as a predicate it is
    # always evaluated (a dropped helper column would be pruned away).
    return df.filter(F.coalesce(*checks).isNull())


# ---------------------------------------------------------------------------
# Sensitive-column masking driven by column tags (Q18)
# ---------------------------------------------------------------------------

# Placeholder fragments a real tag must not contain (fixed values).
TAG_PLACEHOLDERS = ("PROJECT_ID", "TAXONOMY_ID")


def tag_columns(df: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Attach a sensitivity tag to columns (kept in ``StructField.metadata``)."""
    return df.select(
        *[
            F.col(c).alias(c, metadata={"sensitivity": tags[c]}) if c in tags else F.col(c)
            for c in df.columns
        ]
    )


def tag_sentinel(tags: Mapping[str, str]) -> list[tuple[str, str]]:
    """Config sentinel: tags that are empty or still hold a placeholder."""
    return [(c, t) for c, t in tags.items() if t == "" or any(p in (t or "") for p in TAG_PLACEHOLDERS)]


def tag_failures(tags: DataFrame, col: str = "tag", placeholder: str = "PROJECT_ID|TAXONOMY_ID") -> DataFrame:
    """P12 on a table of tags: rows whose tag is empty or matches ``placeholder``
    (a null tag is no tag and passes)."""
    return tags.where((F.col(col) == "") | F.col(col).rlike(placeholder))


def regex_failures(df: DataFrame, col: str, pattern: str, wanted: bool = True) -> DataFrame:
    """Rows whose ``col`` does not match ``pattern`` (or does, where it is
    not ``wanted``); null passes."""
    found = F.col(col).rlike(pattern)
    return df.where(~found if wanted else found)


PSEUDONYM_KEY, PSEUDONYM_VERSION = "spark.cohort_effects.pseudonym.key", "spark.cohort_effects.pseudonym.version"


def pseudonym(value: Column, key: str, version: str) -> Column:
    """Keyed digest of a value: sha-256 over the key and an inner sha-256 over the
    key and the value, with the key's version before it.  Ids of few possible
    values cannot be found by trying them all without the key, and two keys give
    unlinkable ids.  Null stays null."""
    inner = F.sha2(F.concat(F.lit(f"{key}|in|"), value.cast("string")).cast("binary"), 256)
    return F.concat(F.lit(f"{version}:"), F.sha2(F.concat(F.lit(f"{key}|out|"), inner).cast("binary"), 256))


def session_key(spark) -> tuple[str, str]:
    """(key, version) of the session; without a key nothing is masked."""
    key, version = spark.conf.get(PSEUDONYM_KEY, None), spark.conf.get(PSEUDONYM_VERSION, "v1")
    if not key:
        raise ContractError(f"hash masking needs the session's {PSEUDONYM_KEY}")
    return key, version


def mask_sensitive(
    df: DataFrame, actions: Mapping[str, str], enabled: bool = True, key: tuple[str, str] | None = None
) -> DataFrame:
    """Q18: mask columns by their sensitivity tag.

    ``actions`` maps a tag to ``hash`` (a keyed pseudonym; ``key`` is (key,
    version), by default the session's), ``null`` or ``drop``.  Refuses to run
    when a tag is empty or a placeholder, or when there is no key to hash with.
    """
    if not enabled:
        return df
    tags = {f.name: f.metadata.get("sensitivity") for f in df.schema.fields if f.metadata.get("sensitivity") is not None}
    bad = tag_sentinel(tags)
    if bad:
        raise ContractError(f"placeholder or empty sensitivity tags: {bad}")
    cols = []
    for f in df.schema.fields:
        act = actions.get(tags.get(f.name, ""), "keep")
        if act == "drop":
            continue
        if act == "hash":
            key = key or session_key(df.sparkSession)
            cols.append(pseudonym(F.col(f.name), *key).alias(f.name))
        elif act == "null":
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------------------
# Suite runner (Q19)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """A declarative check.

    kind: not_null | unique | unique_combination | accepted_values |
          relationships | between | mean_between | stdev_between | custom
    severity: "error", "warn", or "prod_error" (error only on target prod).
    """

    name: str
    kind: str
    table: str
    cols: tuple = ()
    args: dict = field(default_factory=dict)
    severity: str = "error"
    custom: Callable[[], DataFrame] | None = None


ROW_KINDS = ("not_null", "between", "mean_between", "stdev_between")


def effective_severity(sev: str, target: str) -> str:
    if sev == "prod_error":
        return "error" if target == "prod" else "warn"
    return sev


def _row_level_exprs(check: Check):
    c = check.cols[0]
    a = check.args
    if check.kind == "not_null":
        return F.count_if(F.col(c).isNull())
    if check.kind == "between":
        return F.count_if(_outside(c, a.get("min"), a.get("max")))
    stat = F.avg(c) if check.kind == "mean_between" else F.stddev_samp(c)
    return F.when(_stat_outside(stat, a["min"], a["max"]), F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def failing_rows(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The failing rows of one check."""
    t = tables.get(check.table)
    a = check.args
    if check.kind == "not_null":
        return not_null(t, check.cols[0])
    if check.kind == "unique":
        return unique(t, check.cols[0])
    if check.kind == "unique_combination":
        return unique_combination(t, list(check.cols))
    if check.kind == "accepted_values":
        return accepted_values(t, check.cols[0], a["values"])
    if check.kind == "relationships":
        return relationships(t, check.cols[0], tables[a["to"]], a["field"])
    if check.kind == "between":
        return between(t, check.cols[0], a.get("min"), a.get("max"))
    if check.kind == "mean_between":
        return mean_between(t, check.cols[0], a["min"], a["max"])
    if check.kind == "stdev_between":
        return stdev_between(t, check.cols[0], a["min"], a["max"])
    if check.kind == "custom":
        return check.custom()
    raise ValueError(check.kind)


def row_level_metrics(checks: Sequence[Check], table: str) -> list[Column]:
    """Failures of a table's row-level checks as aggregates, named by check: what a
    write can observe of the rows it writes."""
    return [_row_level_exprs(ch).cast("bigint").alias(ch.name) for ch in checks if ch.kind in ROW_KINDS and ch.table == table]


KEY_KINDS = ("unique", "unique_combination")


FEW = 1 << 20  # repeated hashes of a check whose rows are looked up instead of grouping all rows


def _hashed(check: Check, table: DataFrame) -> DataFrame:
    known = table.where(F.col(check.cols[0]).isNotNull()) if check.kind == "unique" else table
    return known.withColumn("_hash", F.xxhash64(*check.cols))


def narrowed(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> dict[str, DataFrame | None]:
    """Per key check the rows among which its repeats are: those whose 64-bit hash of the
    key is not theirs alone, None if there are none.  Equal keys have equal hashes, so no
    repeat is missed, and rows that agree by chance are still told apart by their keys.

    A number is moved and compared where grouping by the keys moves and compares whole
    keys, and a check's hashes are off the disk before the next one's are moved.  A check
    with many repeated hashes (over ``FEW``) keeps all its rows."""
    out = {}
    for ch in checks:
        if ch.kind not in KEY_KINDS:
            continue
        t = tables[ch.table]
        hashes = _hashed(ch, t).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
        repeated = written(hashes.where("_n > 1").select("_hash"), "hashes")
        many = repeated.count()
        if many <= FEW:
            out[ch.name] = _hashed(ch, t).join(repeated, "_hash", "left_semi").drop("_hash") if many else None
        else:
            out[ch.name] = t
    return out


def check_counts(
    checks: Sequence[Check], tables: Mapping[str, DataFrame], measured: Mapping[str, int] | None = None, by_hash: bool = False
) -> DataFrame:
    """(check_name, failures) for every check.  Those in ``measured`` (by name)
    were counted while their table was written and are not counted again.

    Row-level checks on one table share one aggregate (one scan).  The other
    checks tag their failing rows with the check name; the tagged rows of all
    checks are counted by a single grouped aggregate (one shuffle for all of
    them, partially aggregated per task), and checks without failing rows
    get 0 from the list of names.  All branches form one plan, so identical
    sub-plans are computed once (exchange reuse).  References are counted per key.
    ``by_hash``, for written tables: key checks group the rows that hashes leave them
    (``narrowed``); lazy ones may lie by their keys already.  The other checks are then
    counted one after the other (in one row each), so that one check's shuffled rows lie
    on disk at a time.
    """
    spark = next(iter(tables.values())).sparkSession
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    measured = {ch.name: int(measured[ch.name]) for ch in checks if ch.name in (measured or {})}
    checks = [ch for ch in checks if ch.name not in measured]
    among = narrowed(checks, tables) if by_hash else {}
    measured |= {name: 0 for name, rows in among.items() if rows is None}
    checks = [ch for ch in checks if ch.name not in measured]
    if measured:
        parts.append(spark.createDataFrame(sorted(measured.items()), "check_name string, failures bigint"))
    for ch in checks:
        if ch.kind in ROW_KINDS:
            by_table.setdefault(ch.table, []).append(ch)
    for tname, group in by_table.items():
        agg = tables[tname].agg(*[_row_level_exprs(ch).cast("bigint").alias(f"c{i}") for i, ch in enumerate(group)])
        stack = ", ".join(f"'{ch.name}', c{i}" for i, ch in enumerate(group))
        parts.append(agg.selectExpr(f"stack({len(group)}, {stack}) as (check_name, failures)"))
    tagged = []
    for ch in checks:
        if ch.kind == "relationships":
            found = relationships(tables[ch.table], ch.cols[0], tables[ch.args["to"]], ch.args["field"], counted=True)
            tagged.append(found.select(F.lit(ch.name).alias("check_name"), F.col("n_records").alias("n")))
        elif ch.kind not in ROW_KINDS:
            rows = failing_rows(ch, {**tables, ch.table: among.get(ch.name, tables.get(ch.table))})
            tagged.append(rows.select(F.lit(ch.name).alias("check_name"), F.lit(1).cast("bigint").alias("n")))
    if by_hash:
        tagged = [written(t.groupBy("check_name").agg(F.sum("n").alias("n")), "counts") for t in tagged]
    if tagged:
        rows = tagged[0]
        for t in tagged[1:]:
            rows = rows.unionByName(t)
        counted = rows.groupBy("check_name").agg(F.sum("n").alias("failures"))
        names = spark.createDataFrame([(ch.name,) for ch in checks if ch.kind not in ROW_KINDS], "check_name string")
        # one row per check: bounded by the suite size
        parts.append(
            F.broadcast(names).join(counted, "check_name", "left")
            .select("check_name", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"))
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_checks(
    checks: Sequence[Check], tables: Mapping[str, DataFrame], target: str = "dev", measured: Mapping[str, int] | None = None
) -> DataFrame:
    """Q19: result table with severity and status (pass / warn / fail)."""
    spark = next(iter(tables.values())).sparkSession
    meta = spark.createDataFrame(
        [(c.name, c.kind, c.table, effective_severity(c.severity, target)) for c in checks],
        "check_name string, kind string, table_name string, severity string",
    )
    counts = check_counts(checks, tables, measured, by_hash=True)
    j = F.broadcast(meta).join(counts, "check_name")  # one row per check: bounded by the suite size
    status = (
        F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "error", "fail").otherwise("warn")
    )
    return j.select("check_name", "kind", "table_name", "severity", F.col("failures").cast("bigint"), status.alias("status"))


def gate(results: DataFrame) -> None:
    """Raise when any error-severity check failed (stops downstream builds)."""
    failed = results.filter(F.col("status") == "fail").select("check_name").collect()  # at most one row per check
    if failed:
        raise ContractError(f"failed checks: {[r[0] for r in failed]}")


def domain_rules(attendance: DataFrame, scores: DataFrame) -> DataFrame:
    """Z3: (rule, violations, total).

    * period start before its end, per attendance row (both known);
    * every scored student has some attendance (distinct students, anti join).
    """
    s, e = F.col("start_date"), F.col("end_date")
    r1 = attendance.agg(
        F.count_if(s.isNotNull() & e.isNotNull() & ~(s < e)).alias("violations"),
        F.count(F.lit(1)).alias("total"),
    ).select(F.lit("start_before_end").alias("rule"), "violations", "total")
    scored = scores.select("student_id").filter(F.col("student_id").isNotNull()).distinct()
    seen = attendance.select(F.col("student_id").alias("_s")).distinct().withColumn("_m", F.lit(True))
    j = scored.join(seen, F.col("student_id") == F.col("_s"), "left")
    r2 = j.agg(F.count_if(F.col("_m").isNull()).alias("violations"), F.count(F.lit(1)).alias("total")).select(
        F.lit("scored_student_has_attendance").alias("rule"), "violations", "total"
    )
    return r1.unionByName(r2)
