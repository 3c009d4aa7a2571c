"""The effect model: demeaning, raw effects, variance components, shrinkage,
standard errors, labels and ranks (M8-M15)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cohort_effects.functions import band, clamp_nonneg
from cohort_effects.operators.ranges import dense_ranks
from cohort_effects.params import Params


def _distinct_at_least(col: str, k: int, numeric: bool, values: Sequence[str] = ()) -> Column:
    """``count(distinct col) >= k`` as an aggregate expression with a buffer of
    constant size: for known ``values`` (62 at most) a bit set, for k == 2 on a
    fixed-width column ``min != max``.  Only for other strings is it the set of
    distinct values, an object hash aggregate."""
    if k <= 1:
        return F.count(col) >= F.lit(k)
    if 0 < len(values) <= 62:
        bit = F.lit(0).cast("long")
        for j, v in enumerate(values):
            bit = F.when(F.col(col) == F.lit(v), F.lit(1 << j).cast("long")).otherwise(bit)
        return F.bit_count(F.bit_or(bit)) >= F.lit(k)
    if k == 2 and numeric:
        return F.coalesce(F.min(col) != F.max(col), F.lit(False))
    return F.size(F.collect_set(col)) >= F.lit(k)


def _is_numeric(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, NumericType)


def plain_keys(df: DataFrame, keys: Sequence[str], known: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """A null key is a group: each of ``keys`` but the ``known`` (never null) gets a
    value and a mark, so that a join on them is on plain equality and an aggregate's
    own exchange serves it.  Returns the frame and the columns to join on."""
    plain = []
    for k in keys:
        if k in known:
            plain.append(k)
            continue
        blank = F.lit(0 if _is_numeric(df, k) else "").cast(df.schema[k].dataType)
        df = df.withColumn(f"_key_{k}", F.coalesce(F.col(k), blank)).withColumn(f"_null_{k}", F.col(k).isNull())
        plain += [f"_key_{k}", f"_null_{k}"]
    return df, plain


def demean(
    df: DataFrame,
    entity: Sequence[str] = ("student_id", "year"),
    value: str = "grade",
    group: str = "subject",
    min_obs: int = 4,
    min_groups: int = 2,
    required: Sequence[str] = ("year",),
    flag_target: str | None = None,
    flag_col: str = "multi_school",
    mean_col: str = "student_mean",
    out_col: str = "grade_dm",
    n_col: str = "n_obs_student",
    group_values: Sequence[str] = (),
    deal: bool = False,
) -> DataFrame:
    """M8: subtract each entity's own mean; keep entities with at least
    ``min_obs`` rows and ``min_groups`` distinct ``group`` values.

    The filter applies *after* the statistics, so means use every row.  The
    statistics come from one grouping aggregate joined back on the entity
    (instead of unbounded windows): it is reduced map-side before the shuffle,
    and with AQE a hot entity's detail partition is split by the skew-join
    handler instead of being sorted in a single task.  ``flag_target`` adds
    the multi-target flag (W4) from the same aggregate.  ``group_values``, if
    all values of ``group`` are known, keeps the aggregate's state constant.
    ``deal`` sends the rows to their entity's task once, for the statistics and
    for the join: right where an entity has few rows (de-duplicated ones).
    Rows that hold the statistics already (``enrich.attach_context``), over at least the
    ``required`` entities, with the number of distinct groups as ``n_groups``, are only
    filtered and centred.
    """
    src = df
    for r in required:
        src = src.filter(F.col(r).isNotNull())
    if {mean_col, n_col, "n_groups"} <= set(df.columns):
        enough = src.filter((F.col(n_col) >= F.lit(min_obs)) & (F.col("n_groups") >= F.lit(min_groups)))
        return enough.drop("n_groups").withColumn(out_col, F.col(value) - F.col(mean_col))
    src, keys = plain_keys(src, entity, required)
    if deal:  # the same columns for both uses, so that one exchange serves them
        src = src.repartition(*keys)
    aggs = [
        F.avg(value).alias(mean_col),
        F.count(F.lit(1)).alias(n_col),
        _distinct_at_least(group, min_groups, _is_numeric(src, group), group_values).alias("_enough_groups"),
    ]
    if flag_target:
        aggs.append(F.coalesce(F.min(flag_target) != F.max(flag_target), F.lit(False)).alias(flag_col))
    stats = src.groupBy(*keys).agg(*aggs).filter(
        (F.col(n_col) >= F.lit(min_obs)) & F.col("_enough_groups")
    ).drop("_enough_groups")
    out = src.join(stats, keys).drop(*[k for k in keys if k not in df.columns])
    return out.select(*df.columns, *[c for c in stats.columns if c not in keys]).withColumn(out_col, F.col(value) - F.col(mean_col))


def group_moments(
    dm: DataFrame,
    by: Sequence[str] = ("school_id", "subject", "year"),
    value: str = "grade_dm",
    flag: str | None = "multi_school",
    with_m2: bool = True,
) -> DataFrame:
    """M9 (+ the level-1 moments of M10): per group mean, count, flagged share
    and the within sum of squares ``m2``.  Rows with a NULL in ``by[0]``
    (the group, e.g. school) are dropped, as groups: their filter stays above the
    aggregate, so the detail below is the same rows as its statistics are made of
    and one exchange serves both."""
    aggs = [F.count(by[0]).alias("_known"), F.avg(value).alias("raw_effect"), F.count(F.lit(1)).alias("n_obs")]
    if flag:
        aggs.append(F.avg(F.col(flag).cast("double")).alias("pct_multi_school"))
    if with_m2:
        aggs.append((F.var_pop(value) * F.count(value)).alias("m2"))
    return dm.groupBy(*by).agg(*aggs).filter("_known > 0").drop("_known")


def raw_effects(dm: DataFrame, by: Sequence[str] = ("school_id", "subject", "year"), value: str = "grade_dm") -> DataFrame:
    """M9: raw effect, n_obs and multi-school share per (school, subject, year)."""
    return group_moments(dm, by, value, with_m2=False).select(
        *by, "n_obs", "pct_multi_school", "raw_effect"
    )


def variance_components(moments: DataFrame, by: Sequence[str] = ("subject", "year")) -> DataFrame:
    """M10 from the level-1 moments (n, mean, m2): one grouping aggregate, with
    partial sums before the shuffle.

    SSW         = sum m2
    SSB         = sum n mean^2 - (sum n mean)^2 / N   (means of demeaned values, near 0)
    var_total   = (SSW + SSB) / (N - 1), the sample variance of all detail values
    var_within  = SSW / (N - k)
    var_between = var_samp(group means) - var_within / n_eff   (may be < 0)
    n_eff       = (N - sum n^2 / N) / (k - 1)
    Divisions by zero give NULL.
    """
    n, mean = F.col("n_obs").cast("double"), F.col("raw_effect")
    sums = moments.groupBy(*by).agg(
        F.sum(n).alias("_n"),
        F.count(F.lit(1)).cast("double").alias("_k"),
        F.sum(n * n).alias("_nn"),
        F.sum("m2").alias("_ssw"),
        F.sum(n * mean).alias("_s"),
        F.sum(n * mean * mean).alias("_ss"),
        F.var_samp(mean).alias("_between"),
    )

    def over(a: Column, b: Column) -> Column:
        return F.try_divide(a, F.when(b != 0, b))

    N, k, ssw = F.col("_n"), F.col("_k"), F.col("_ssw")
    within = over(ssw, N - k)
    n_eff = over(N - over(F.col("_nn"), N), k - 1)
    ssb = F.greatest(F.lit(0.0), F.col("_ss") - over(F.col("_s") * F.col("_s"), N))
    return sums.select(
        *by,
        over(ssw + ssb, N - 1).alias("var_total"),
        within.alias("var_within"),
        (F.col("_between") - over(within, n_eff)).alias("var_between"),
        n_eff.alias("n_eff"),
    )


def shrink(effects: DataFrame, variances: DataFrame | None = None, by: Sequence[str] = ("subject", "year")) -> DataFrame:
    """Clamp var_between at 0 (NULL stays NULL) and shrink the raw effect.

    ``variances`` has one row per ``by`` group; it is joined without a hint, so
    AQE broadcasts it only after measuring it and splits a hot group otherwise.
    With ``variances=None`` they are made from the level-1 moments in
    ``effects``; both uses share the moments' exchange.
    """
    if variances is None:
        variances = variance_components(effects, by)
    j = effects.join(variances.select(*by, "var_within", "var_between"), list(by), "left")
    vb = clamp_nonneg("var_between")
    denom = vb + F.try_divide(F.col("var_within"), F.col("n_obs").cast("double"))
    weight = F.try_divide(vb, F.when(denom != 0, denom))
    keep = [c for c in effects.columns if c not in ("m2", "var_within", "var_between")]
    return j.select(
        *keep,
        "var_within",
        vb.alias("var_between_clamped"),
        weight.alias("weight"),
        (weight * F.col("raw_effect")).alias("adj_effect"),
    )


def std_error_ci(df: DataFrame, z: float = 1.96) -> DataFrame:
    """se = sqrt((1 - w) * vb); 95% interval adj +- z * se."""
    se = F.sqrt((F.lit(1.0) - F.col("weight")) * F.col("var_between_clamped"))
    return (
        df.withColumn("std_err", se)
        .withColumn("ci_low", F.col("adj_effect") - F.lit(z) * F.col("std_err"))
        .withColumn("ci_high", F.col("adj_effect") + F.lit(z) * F.col("std_err"))
    )


def classify(df: DataFrame, params: Params = Params(), col: str = "adj_effect", out: str = "effect_class") -> DataFrame:
    """Magnitude bands; a NULL effect falls to the last label."""
    s, w = params.strong_cut, params.weak_cut
    L = params.effect_labels
    cuts = [(">=", s, L[0]), (">", w, L[1]), (">=", -w, L[2]), (">", -s, L[3])]
    return df.withColumn(out, band(col, cuts, L[4]))


def confidence(df: DataFrame, params: Params = Params(), out: str = "confidence") -> DataFrame:
    """Significant when the interval excludes zero."""
    sig, inc = params.confidence_labels
    cond = (F.col("ci_low") > 0) | (F.col("ci_high") < 0)
    return df.withColumn(out, F.when(cond, F.lit(sig)).otherwise(F.lit(inc)))


def rank_in_group(
    df: DataFrame,
    by: Sequence[str] = ("subject", "year"),
    col: str = "adj_effect",
    out: str = "rank_in_subject",
    round_digits: int | None = None,
) -> DataFrame:
    """Dense rank, highest first, NULLs last, within (subject, year).

    The group's distinct values are ranked slot by slot (``ranges.dense_ranks``),
    so a (subject, year) that holds most rows is not sorted by one task.
    """
    key = F.col(col) if round_digits is None else F.round(F.col(col), round_digits)
    return dense_ranks(df.withColumn("_ranked", key), list(by), "_ranked", out).drop("_ranked")


MART_COLUMNS = (
    "school_id",
    "subject",
    "year",
    "n_obs",
    "pct_multi_school",
    "raw_effect",
    "weight",
    "adj_effect",
    "std_err",
    "ci_low",
    "ci_high",
    "effect_class",
    "confidence",
    "rank_in_subject",
)


def score_effects(moments: DataFrame, variances: DataFrame | None = None, params: Params = Params()) -> DataFrame:
    """M11-M15 on top of level-1 moments.

    Without ``variances`` they come from the moments themselves.
    """
    out = shrink(moments, variances)
    out = std_error_ci(out, params.z)
    out = classify(out, params)
    out = confidence(out, params)
    out = rank_in_group(out, round_digits=params.rank_round_digits)
    return out.select(*MART_COLUMNS)


def _poisson1(u: Column) -> Column:
    """Inverse CDF of Poisson(1) at a uniform ``u`` of 30 bits, carried on
    until the tail is below one step of ``u``."""
    cdf, term, k, expr = 0.0, math.exp(-1.0), 0, None
    while True:
        cdf += term
        if 1.0 - cdf < 2.0**-30:
            return expr.otherwise(F.lit(k))
        expr = F.when(u < F.lit(cdf), F.lit(k)) if expr is None else expr.when(u < F.lit(cdf), F.lit(k))
        k += 1
        term /= k


def replicate_weights(
    dm: DataFrame,
    replicates: int,
    by: Sequence[str] = ("school_id", "subject", "year"),
    row_key: Sequence[str] = ("student_id", "term", "subject"),
    value: str = "grade_dm",
    seed: int = 42,
) -> DataFrame:
    """One row per (detail row, replicate ``_b``) with its Poisson(1) weight
    ``_wt`` drawn from a hash of (row key, replicate, seed)."""
    src = dm.filter(F.col(by[0]).isNotNull())
    reps = F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("_b")
    long = src.select(*by, *[c for c in row_key if c not in by], value, reps)
    h = F.xxhash64(*[F.col(c) for c in row_key], F.col("_b"), F.lit(seed))
    u = F.pmod(h, F.lit(1 << 30)).cast("double") / F.lit(float(1 << 30))
    return long.withColumn("_wt", _poisson1(u).cast("double"))


def bootstrap_se(
    dm: DataFrame,
    replicates: int = 20,
    by: Sequence[str] = ("school_id", "subject", "year"),
    row_key: Sequence[str] = ("student_id", "term", "subject"),
    value: str = "grade_dm",
    seed: int = 42,
) -> DataFrame:
    """Poisson bootstrap standard error of the raw effect per group.

    Each detail row gets an independent Poisson(1) weight per replicate from
    a hash of (row key, replicate, seed), all of them in one array beside the
    row: no row is copied, and the replicates' sums are columns of one grouping
    aggregate with partial sums.
    """
    src = dm.filter(F.col(by[0]).isNotNull())
    src = src.select(*by, F.col(value).alias("_v"), weight_array(row_key, replicates, seed).alias("_wts"))
    per = src.groupBy(*by).agg(
        *[F.sum(F.col("_wts")[b] * F.col("_v")).alias(f"_s{b}") for b in range(replicates)],
        *[F.sum(F.col("_wts")[b]).alias(f"_w{b}") for b in range(replicates)],
    )
    means = F.array(*[F.try_divide(F.col(f"_s{b}"), F.col(f"_w{b}")) for b in range(replicates)])
    return per.select(*by, F.filter(means, lambda m: m.isNotNull()).alias("_m")).select(
        *by, _stddev("_m").alias("boot_se"), F.size("_m").cast("bigint").alias("n_replicates")
    )


def weight_array(key: Sequence[str], replicates: int, seed: int) -> Column:
    """Poisson(1) weights of a row's replicates, from a hash of (key, replicate,
    seed)."""

    def one(b: Column) -> Column:
        h = F.xxhash64(*[F.col(c) for c in key], b, F.lit(seed))
        return _poisson1(F.pmod(h, F.lit(1 << 30)).cast("double") / F.lit(float(1 << 30))).cast("double")

    return F.transform(F.sequence(F.lit(0), F.lit(replicates - 1)), one)


def _stddev(col: str) -> Column:
    """Sample standard deviation of an array; null for fewer than two values."""
    n = F.size(col)
    total = F.aggregate(col, F.lit(0.0), lambda a, x: a + x)
    mean = F.try_divide(total, n.cast("double"))
    squares = F.aggregate(F.transform(col, lambda x: (x - mean) * (x - mean)), F.lit(0.0), lambda a, x: a + x)
    return F.when(n > 1, F.sqrt(squares / (n - 1)))


def bootstrap_effects(
    dm: DataFrame,
    replicates: int = 200,
    unit: str = "student_id",
    by: Sequence[str] = ("school_id", "subject", "year"),
    value: str = "grade_dm",
    seed: int = 42,
    interval: tuple[float, float] = (0.025, 0.975),
) -> DataFrame:
    """Z2 by unit, through the whole model: a replicate draws students, a student's
    rows keep or leave together (so their own mean stays), and each replicate gets
    its own variance components and shrinkage.

    The detail is reduced to sums per (student, group) first; a student's weights
    stand in one array beside them, and the replicates' sums are columns of one
    aggregate.  Only those sums, a row a group, are turned into a row a (group,
    replicate) for the model.  Returns the spread and the percentile interval of
    the adjusted effects, and how many replicates have the group at all.
    """
    v = F.col(value)
    cells = dm.filter(F.col(by[0]).isNotNull()).groupBy(unit, *by).agg(
        F.count(v).cast("double").alias("_n"), F.sum(v).alias("_d"), F.sum(v * v).alias("_q")
    )
    # a group's cells come together before their sums are made: 3 * replicates sums a
    # group and task would be far more than the cells; a large group stays in parts
    cells = cells.hint("rebalance", *by).withColumn("_wts", weight_array([unit], replicates, seed))
    sums = cells.groupBy(*by).agg(
        *[F.sum(F.col("_wts")[b] * F.col(c)).alias(f"{c}{b}") for b in range(replicates) for c in ("_n", "_d", "_q")]
    )
    drawn = F.array(*[F.struct(F.lit(b).alias("_b"), *[F.col(f"{c}{b}").alias(c) for c in ("_n", "_d", "_q")]) for b in range(replicates)])
    rows = sums.select(*by, F.inline(drawn)).where("_n > 0")
    moments = rows.select(
        *by, "_b", F.col("_n").cast("bigint").alias("n_obs"), (F.col("_d") / F.col("_n")).alias("raw_effect"),
        F.greatest(F.lit(0.0), F.col("_q") - F.col("_d") * F.col("_d") / F.col("_n")).alias("m2"),
    )
    adjusted = shrink(moments, None, [*by[1:], "_b"])
    low, high = interval
    out = adjusted.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_replicates"), F.stddev_samp("adj_effect").alias("boot_se"),
        F.percentile("adj_effect", [low, high]).alias("_q"),  # the group's replicates
    )
    return out.select(*by, "n_replicates", "boot_se", F.col("_q")[0].alias("boot_low"), F.col("_q")[1].alias("boot_high"))
