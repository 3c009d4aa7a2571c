"""Query catalogue: every implemented operator as (Spark plan, oracle SQL).

Each Spark entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the given tables; the SQL twin runs in DuckDB on the same Parquet views.
Doubles are rounded to 6 digits (and -0.0 folded to 0.0) on both sides so
results compare by value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_effects.params import Params
from cohort_effects.plans import oracle as O
from cohort_effects.plans.build import Layers, fixture_layers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Ranks compare round(adj_effect, 9) so engines that differ in the last ulp
# agree on ties; everything else is the library default.
QP = Params(rank_round_digits=9)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def round6(c):
    """Engine-independent 6-digit rounding for comparisons.

    Engines differ in the last ulp (summation order) and in how ``round``
    breaks exact halves, so values are first snapped to 9 digits and then
    rounded half-up with plain IEEE arithmetic, which both engines share.
    NaN/inf and huge values pass through; -0.0 becomes +0.0.
    """
    y = F.round(c, 9)
    r = (F.floor(y * F.lit(1e6) + F.lit(0.5)).cast("double") / F.lit(1e6))
    return F.when(F.isnan(y) | (F.abs(y) >= F.lit(1e12)), y).otherwise(r) + F.lit(0.0)


def normalize(df: DataFrame) -> DataFrame:
    """Apply ``round6`` to every double column."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round6(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _doubles(df_cols: str) -> list[str]:
    return [c.strip() for c in df_cols.split(",") if c.strip()]


_LAYER_CACHE: dict[tuple, Layers] = {}


def layers(spark: SparkSession, base: str) -> Layers:
    """Lazy fixture layers, built once per (session, application, folder)."""
    key = (id(spark), spark.sparkContext.applicationId, base)
    if key not in _LAYER_CACHE:
        _LAYER_CACHE[key] = fixture_layers(spark, base, QP)
    return _LAYER_CACHE[key]


def sql(names, select, doubles="", extra=None) -> str:
    return O.norm(O.with_ctes(names, select, extra), _doubles(doubles))


# --------------------------------------------------------------------------
# Staging (M1-M4), bridges (M5-M6), reshape and enrichment
# --------------------------------------------------------------------------


@register("clean_students", sql(["stg_students"], "SELECT * FROM stg_students"))
def q_clean_students(spark, base):
    return layers(spark, base).students


@register(
    "clean_scores",
    sql(["stg_scores"], "SELECT * FROM stg_scores", "subject_1, subject_2, subject_3, subject_4"),
)
def q_clean_scores(spark, base):
    return normalize(layers(spark, base).scores)


@register("clean_attendance", sql(["stg_attendance"], "SELECT * FROM stg_attendance", "pct"))
def q_clean_attendance(spark, base):
    return normalize(layers(spark, base).attendance)


@register("clean_classes", sql(["stg_classes"], "SELECT * FROM stg_classes"))
def q_clean_classes(spark, base):
    return layers(spark, base).classes


@register("class_school_bridge", sql(["bridge"], "SELECT * FROM bridge"))
def q_bridge(spark, base):
    return layers(spark, base).bridge


@register("class_year", sql(["class_year"], "SELECT * FROM class_year"))
def q_class_year(spark, base):
    return layers(spark, base).years


@register("melt_scores", sql(["melted"], "SELECT * FROM melted", "grade"))
def q_melt(spark, base):
    from cohort_effects.operators.reshape import melt_measures

    s = layers(spark, base).scores
    return normalize(melt_measures(s, ["student_id", "class_id", "term"], QP.subject_map, "subject", "grade"))


@register("enrich_scores", sql(["enriched"], "SELECT * FROM enriched", "grade"))
def q_enrich(spark, base):
    return normalize(layers(spark, base).enriched)


# --------------------------------------------------------------------------
# The effect model
# --------------------------------------------------------------------------


@register("demean_grades", sql(["demeaned"], "SELECT * FROM demeaned", "grade, student_mean, grade_dm"))
def q_demean(spark, base):
    return normalize(layers(spark, base).demeaned)


@register("raw_effects", sql(["effects"], "SELECT * FROM effects", "pct_multi_school, raw_effect"))
def q_raw_effects(spark, base):
    return normalize(layers(spark, base).effects)


@register(
    "variance_components",
    sql(["variances"], "SELECT * FROM variances", "var_total, var_within, var_between, n_eff"),
)
def q_variances(spark, base):
    return normalize(layers(spark, base).variances)


_SHRUNK_D = "pct_multi_school, raw_effect, var_within, var_between_clamped, weight, adj_effect"


@register("shrunk_effects", sql(["shrunk"], "SELECT * FROM shrunk", _SHRUNK_D))
def q_shrunk(spark, base):
    from cohort_effects.operators.effects import shrink

    L = layers(spark, base)
    return normalize(shrink(L.effects, L.variances))


@register(
    "effect_ci",
    sql(
        ["with_ci"],
        "SELECT school_id, subject, year, weight, adj_effect, std_err, ci_low, ci_high FROM with_ci",
        "weight, adj_effect, std_err, ci_low, ci_high",
    ),
)
def q_ci(spark, base):
    from cohort_effects.operators.effects import shrink, std_error_ci

    L = layers(spark, base)
    out = std_error_ci(shrink(L.effects, L.variances), QP.z)
    return normalize(out.select("school_id", "subject", "year", "weight", "adj_effect", "std_err", "ci_low", "ci_high"))


@register(
    "effect_classes",
    sql(
        ["classified"],
        "SELECT school_id, subject, year, adj_effect, effect_class, confidence FROM classified",
        "adj_effect",
    ),
)
def q_classes(spark, base):
    from cohort_effects.operators.effects import classify, confidence, shrink, std_error_ci

    L = layers(spark, base)
    out = confidence(classify(std_error_ci(shrink(L.effects, L.variances), QP.z), QP), QP)
    return normalize(out.select("school_id", "subject", "year", "adj_effect", "effect_class", "confidence"))


@register(
    "rank_in_subject",
    sql(["mart"], "SELECT school_id, subject, year, adj_effect, rank_in_subject FROM mart", "adj_effect"),
)
def q_rank(spark, base):
    return normalize(layers(spark, base).mart.select("school_id", "subject", "year", "adj_effect", "rank_in_subject"))


MART_D = "pct_multi_school, raw_effect, weight, adj_effect, std_err, ci_low, ci_high"


@register("effect_mart", sql(["mart"], "SELECT * FROM mart", MART_D))
def q_mart(spark, base):
    return normalize(layers(spark, base).mart)


# --------------------------------------------------------------------------
# Data quality (Q1-Q19)
# --------------------------------------------------------------------------

from cohort_effects.operators import quality as Qm  # noqa: E402
from cohort_effects.operators import quantiles as QN  # noqa: E402
from cohort_effects.plans import suite as SU  # noqa: E402

_DQ_ALL = SU.ALL_SQL_TABLES


def _dq_kind(*kinds):
    checks = [c for c in SU.generic_checks(QP) if c.kind in kinds]

    def spark_fn(spark, base):
        L = layers(spark, base)
        return Qm.check_counts(checks, SU.tables_of(L, checks))

    return spark_fn, sql(_DQ_ALL, SU.counts_sql(checks, QP))


for _name, _kinds in [
    ("dq_not_null", ("not_null",)),
    ("dq_unique", ("unique",)),
    ("dq_unique_combo", ("unique_combination",)),
    ("dq_accepted_values", ("accepted_values",)),
    ("dq_relationships", ("relationships",)),
    ("dq_between", ("between",)),
    ("dq_mean_stdev", ("mean_between", "stdev_between")),
]:
    _fn, _sql = _dq_kind(*_kinds)
    register(_name, _sql)(_fn)


_RAW_CHECKS = SU.raw_checks()


@register("dq_raw_layers", O.with_ctes(SU.RAW_TABLES, SU.counts_sql(_RAW_CHECKS, QP)))
def q_dq_raw(spark, base):
    """Every kind of generic check on the raw layers, where each one fails."""
    return Qm.check_counts(_RAW_CHECKS, {t: df for t, df in _raw(spark, base).items() if t in SU.RAW_TABLES})


@register(
    "spanning_classes",
    """SELECT l_suppkey % 7 AS class_id, count(DISTINCT l_suppkey) AS n_schools, min(year(l_shipdate)) AS year,
        CASE WHEN count(DISTINCT year(l_shipdate)) > 1 THEN count(DISTINCT year(l_shipdate)) END AS n_years
        FROM lineitem WHERE l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL GROUP BY ALL""",
)
def q_spanning(spark, base):
    """Bridge fan-out, lowest year and year conflicts where classes span
    schools and years."""
    from cohort_effects.operators.enrich import class_school_bridge, class_year

    rows = _t(spark, base, "lineitem").select(
        (F.col("l_suppkey") % 7).alias("class_id"), F.col("l_suppkey").alias("school_id"),
        F.year("l_shipdate").cast("bigint").alias("year"),
    )
    schools = class_school_bridge(rows).groupBy("class_id").agg(F.count("*").alias("n_schools"))
    years = Qm.one_value_per_key(rows, "class_id", "year").withColumnRenamed("n_values", "n_years")
    return schools.join(class_year(rows), "class_id").join(years, "class_id", "left")


@register(
    "dq_zero_sum",
    sql(["demeaned"], f"""SELECT count(*) AS n_groups, CAST(sum(off) AS BIGINT) AS failures FROM (
        SELECT CAST(abs(avg(grade_dm)) > {QP.zero_sum_tol!r} AS BIGINT) AS off FROM demeaned GROUP BY student_id, year)"""),
)
def q_zero_sum(spark, base):
    dm = layers(spark, base).demeaned
    per = dm.groupBy("student_id", "year").agg(F.avg("grade_dm").alias("m"))
    return per.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.count_if(F.abs("m") > F.lit(QP.zero_sum_tol)).alias("failures"),
    )


@register(
    "dq_monotone_weight",
    sql(["mart"], f"SELECT count(*) AS n_rows, count_if(drops) AS failures FROM ({SU.DROPS.format(tol=QP.monotone_tol)})"),
)
def q_monotone(spark, base):
    m = layers(spark, base).mart
    flagged = Qm.drops(m, ["subject", "year"], ["n_obs", "school_id"], "weight", QP.monotone_tol)
    return flagged.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("dropped").alias("failures"))


@register(
    "dq_row_conservation",
    sql(["mart", "demeaned"], f"SELECT *, n_obs_mart IS DISTINCT FROM n_obs_int AS mismatch FROM ({SU.BALANCE})"),
)
def q_row_conservation(spark, base):
    L = layers(spark, base)
    return Qm.row_conservation(L.mart, L.demeaned)


@register("dq_term_gaps", sql(["enriched"], SU.GAPS))
def q_term_gaps(spark, base):
    return Qm.term_gaps(layers(spark, base).enriched)


@register(
    "dq_class_one_year",
    sql(["stg_classes"], """SELECT class_id, count(DISTINCT year) AS n_values FROM stg_classes
        WHERE class_id IS NOT NULL AND year IS NOT NULL GROUP BY class_id HAVING min(year) < max(year)"""),
)
def q_class_one_year(spark, base):
    return Qm.one_value_per_key(layers(spark, base).classes, "class_id", "year")


def _share_sql(flag: str, table: str, limit: float) -> str:
    return f"""SELECT *, pct_orphans > {limit!r} AS failed FROM (SELECT count_if({flag}) AS n_orphans, count(*) AS n_total,
        avg(CAST({flag} AS DOUBLE)) AS pct_orphans FROM {table})"""


@register(
    "dq_orphan_share_scores",
    sql(["enriched"], _share_sql("school_id IS NULL", "enriched", QP.max_orphan_share_scores), "pct_orphans"),
)
def q_orphan_scores(spark, base):
    st = Qm.orphan_share_rows(layers(spark, base).enriched, "school_id")
    return normalize(st.withColumn("failed", F.col("pct_orphans") > F.lit(QP.max_orphan_share_scores)))


@register(
    "dq_orphan_share_classes",
    sql(["stg_attendance"], _share_sql("orphan", f"({SU.NO_SCHOOL})", QP.max_orphan_share_classes), "pct_orphans"),
)
def q_orphan_classes(spark, base):
    st = Qm.orphan_share_groups(layers(spark, base).attendance, "class_id", "school_id")
    return normalize(st.withColumn("failed", F.col("pct_orphans") > F.lit(QP.max_orphan_share_classes)))


@register(
    "mask_sensitive",
    sql(["stg_students"], """SELECT 'v1:' || sha256('fixture key|out|' || sha256('fixture key|in|' || student_id)) AS student_id,
        CAST(NULL AS VARCHAR) AS age_band, district FROM stg_students"""),
)
def q_mask(spark, base):
    from cohort_effects.sources.schemas import DEMOGRAPHIC, DIRECT_ID, STUDENT_TAGS

    st = Qm.tag_columns(layers(spark, base).students, STUDENT_TAGS)
    return Qm.mask_sensitive(st, {DIRECT_ID: "hash", DEMOGRAPHIC: "null"}, key=("fixture key", "v1"))


_REGEX_RULES = [  # table, column, pattern, whether it is wanted
    ("part", "p_brand", "^Brand#[0-9]$", True),
    ("orders", "o_orderpriority", "^[1-5]-[A-Z]+$", True),
    ("customer", "c_name", "^Customer#[0-9]{9}$", True),
    ("documents", "text", "[A-Za-z0-9]+@[A-Za-z0-9]+", False),
]


@register("dq_regex", " UNION ALL ".join(
    f"SELECT '{t}.{c}' AS rule, count_if({'NOT ' * w}regexp_matches({c}, '{x}')) AS failures FROM {t}" for t, c, x, w in _REGEX_RULES
))
def q_regex(spark, base):
    """Rows that break a pattern, per rule."""
    parts = [
        Qm.regex_failures(_t(spark, base, t), c, x, w).agg(F.count(F.lit(1)).alias("failures")).select(F.lit(f"{t}.{c}").alias("rule"), "failures")
        for t, c, x, w in _REGEX_RULES
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _contract_sql():
    from cohort_effects.sources.schemas import MART_SCHEMA

    rows = " UNION ALL ".join(
        f"SELECT '{f.name}' AS column_name, count_if({f.name} IS NULL) AS n_null FROM mart"
        for f in MART_SCHEMA.fields
    )
    return sql(["mart"], rows)


@register("mart_contract_nulls", _contract_sql())
def q_contract(spark, base):
    from cohort_effects.sources.schemas import MART_SCHEMA

    m = Qm.enforce_contract(layers(spark, base).mart, MART_SCHEMA)
    return Qm.null_counts(m)


@register("dq_suite", sql(_DQ_ALL, SU.results_sql(SU.generic_checks(QP) + SU.singular_meta(QP), QP)))
def q_suite(spark, base):
    # 41 checks read the layers many times: run them on checkpointed layers
    # (the project materialises its layers as tables too).
    from cohort_effects.plans.build import checkpointed

    L = fixture_layers(spark, base, QP, materialize=checkpointed)
    return Qm.run_checks(SU.suite(L, QP), SU.tables_of(L), QP.target)


# --------------------------------------------------------------------------
# Profiling (E1-E12, A11-A15, T-2..T-5) and table metadata
# --------------------------------------------------------------------------

import datetime as _dt  # noqa: E402

from cohort_effects.operators import profile as Pm  # noqa: E402
from cohort_effects.plans import fixtures as FX  # noqa: E402
from cohort_effects.sources import io as IO  # noqa: E402

# A fixed "today" keeps rule and freshness reports repeatable.
NOW = _dt.datetime(2024, 3, 1, 0, 0, 0)


def _t(spark, base, name):
    return IO.read_table(spark, base, name)


# Profiles of all tables, every column, stacked into one result.
# The driver's tables as TESTDATA.md describes them.
_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _profile_sql():
    rows = []
    for t, columns in _COLUMNS.items():
        for c, dtype in (x.split(" ") for x in columns.split(", ")):
            rows.append(
                f"""SELECT '{t}' AS table_name, '{c}' AS column_name, '{dtype}' AS dtype, CAST(sum(n) AS BIGINT) AS n_rows,
                CAST(coalesce(sum(n) FILTER (v IS NULL), 0) AS DOUBLE) / sum(n) AS pct_null, count(v) AS nunique,
                coalesce(CAST(max(n) FILTER (v IS NOT NULL) AS DOUBLE) / sum(n), 0.0) AS pct_mode
                FROM (SELECT {c} AS v, count(*) AS n FROM {t} GROUP BY {c})"""
            )
    return O.norm(" UNION ALL ".join(rows), ["pct_null", "pct_mode"])


@register("column_profile", _profile_sql())
def q_profile(spark, base):
    parts = [Pm.column_profile(_t(spark, base, t), t, with_dtype=True) for t in _COLUMNS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return normalize(out)


def _raw(spark, base):
    li = _t(spark, base, "lineitem")
    return {
        "raw_score": FX.raw_score(li),
        "raw_attendance": FX.raw_attendance(li),
        "raw_class": FX.raw_class(li),
        "raw_student": FX.raw_student(_t(spark, base, "orders"), _t(spark, base, "customer")),
    }


_GRAINS = [
    ("lineitem (l_orderkey, l_linenumber)", "lineitem", ["l_orderkey", "l_linenumber"]),
    ("orders (o_orderkey)", "orders", ["o_orderkey"]),
    ("customer (c_custkey)", "customer", ["c_custkey"]),
    ("raw_score (student_key, term)", "raw_score", ["student_key", "term"]),
    ("raw_attendance (student_key, class_id, start, end, subject)", "raw_attendance",
     ["student_key", "class_id", "start", "end", "subject"]),
    ("raw_class (student_key, class_id, year)", "raw_class", ["student_key", "class_id", "year"]),
]


def _q(c):
    return f'"{c}"'


def _grain_sql():
    parts = [
        f"""SELECT '{label}' AS grain, CAST(sum(c) AS BIGINT) AS total, count(*) AS n_distinct,
            CAST(sum(c) AS BIGINT) - count(*) AS duplicates
            FROM (SELECT count(*) AS c FROM {t} GROUP BY {', '.join(_q(k) for k in keys)})"""
        for label, t, keys in _GRAINS
    ]
    return O.with_ctes(["raw_score", "raw_attendance", "raw_class"], " UNION ALL ".join(parts))


@register("grain_report", _grain_sql())
def q_grain(spark, base):
    tabs = {**_raw(spark, base), **{n: _t(spark, base, n) for n in ("lineitem", "orders", "customer")}}
    return Pm.grain_report([(label, tabs[t], keys) for label, t, keys in _GRAINS])


_FKS = [
    ("documents", "doc_id", "labels", "doc_id"),
    ("labels", "doc_id", "documents", "doc_id"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("stg_attendance", "class_id", "stg_classes", "class_id"),
    ("stg_scores", "class_id", "stg_classes", "class_id"),
    ("stg_attendance", "student_id", "stg_students", "student_id"),
    ("stg_scores", "student_id", "stg_students", "student_id"),
    ("stg_classes", "student_id", "stg_students", "student_id"),
    ("stg_attendance", "school_id", "supplier", "s_suppkey"),
]


def _fk_sql():
    parts = [
        f"""SELECT '{c}' AS child, '{cc}' AS fk, '{p}' AS parent, count(*) AS n_child,
            count_if(pk._m IS NULL) AS n_orphans,
            CAST(count_if(pk._m IS NULL) AS DOUBLE) / nullif(count(*), 0) AS orphan_rate
            FROM {c} ch LEFT JOIN (SELECT DISTINCT {pc} AS _pk, true AS _m FROM {p}) pk ON ch.{cc} = pk._pk"""
        for c, cc, p, pc in _FKS
    ]
    return O.norm(O.with_ctes(["stg_attendance", "stg_classes", "stg_scores", "stg_students"], " UNION ALL ".join(parts)),
                  ["orphan_rate"])


@register("fk_match_report", _fk_sql())
def q_fk(spark, base):
    L = layers(spark, base)
    stg = {"stg_attendance": L.attendance, "stg_classes": L.classes, "stg_scores": L.scores, "stg_students": L.students}

    def tab(n):
        return stg[n] if n in stg else _t(spark, base, n)

    return normalize(Pm.fk_match_report([(c, tab(c), cc, p, tab(p), pc) for c, cc, p, pc in _FKS]))


def _rules(p: Params = QP):
    from cohort_effects.functions import parse_date

    lo, hi = p.eda_grade_range
    start, end = parse_date("start"), parse_date("end")
    att = [
        ("start_date > today", start > F.lit(NOW.date())),
        ("start_date > end_date", start > end),
        ("pct outside range", Pm.out_of_range("pct", *p.pct_range)),
    ]
    sco = [("term not in valid set", ~F.col("term").isin([str(t) for t in p.valid_terms]))]
    sco += [(f"{m} outside range", Pm.out_of_range(m, lo, hi)) for m in p.subject_map]
    return att, sco


def _rules_sql(p: Params = QP):
    lo, hi = p.eda_grade_range
    s = "CAST(try_strptime(\"start\", '%Y-%m-%d') AS DATE)"
    e = "CAST(try_strptime(\"end\", '%Y-%m-%d') AS DATE)"
    terms = ", ".join(f"'{t}'" for t in p.valid_terms)
    att = [
        ("start_date > today", f"{s} > DATE '{NOW.date()}'"),
        ("start_date > end_date", f"{s} > {e}"),
        ("pct outside range", f"pct IS NOT NULL AND (pct < {p.pct_range[0]!r} OR pct > {p.pct_range[1]!r})"),
    ]
    sco = [("term not in valid set", f"NOT (term IN ({terms}))")]
    sco += [(f"{m} outside range", f"{m} IS NOT NULL AND ({m} < {lo!r} OR {m} > {hi!r})") for m in p.subject_map]
    parts = []
    for tname, rules in (("raw_attendance", att), ("raw_score", sco)):
        for name, pred in rules:
            parts.append(
                f"""SELECT '{tname}' AS table_name, '{name}' AS rule, count_if({pred}) AS violations,
                count(*) AS total, CAST(count_if({pred}) AS DOUBLE) / count(*) AS pct FROM {tname}"""
            )
    return O.norm(O.with_ctes(["raw_attendance", "raw_score"], " UNION ALL ".join(parts)), ["pct"])


@register("rule_report", _rules_sql())
def q_rules(spark, base):
    raw = _raw(spark, base)
    att, sco = _rules()
    return normalize(Pm.rule_report([("raw_attendance", raw["raw_attendance"], att), ("raw_score", raw["raw_score"], sco)]))


@register(
    "monthly_counts",
    O.with_ctes(["stg_attendance"], """
        SELECT 'events.ts' AS series, CAST(date_trunc('month', ts) AS DATE) AS period, count(*) AS n_rows
        FROM events GROUP BY 1, 2
        UNION ALL
        SELECT 'attendance.start_date', CAST(date_trunc('month', start_date) AS DATE), count(*)
        FROM stg_attendance GROUP BY 1, 2"""),
)
def q_monthly(spark, base):
    ev = Pm.period_counts(_t(spark, base, "events"), F.col("ts")).select(F.lit("events.ts").alias("series"), "*")
    at = Pm.period_counts(layers(spark, base).attendance, F.col("start_date")).select(
        F.lit("attendance.start_date").alias("series"), "*"
    )
    return ev.unionByName(at)


@register(
    "period_list",
    O.with_ctes(["stg_attendance"], """SELECT DISTINCT CAST(date_trunc('month', start_date) AS DATE) AS period
        FROM stg_attendance ORDER BY period"""),
)
def q_periods(spark, base):
    return Pm.distinct_sorted(layers(spark, base).attendance, F.trunc("start_date", "month"), "period")


@register("value_counts", "SELECT o_orderpriority AS value, count(*) AS n_rows FROM orders GROUP BY 1 ORDER BY n_rows DESC, value")
def q_value_counts(spark, base):
    return Pm.value_counts(_t(spark, base, "orders"), "o_orderpriority").orderBy(F.desc("n_rows"), "value")


@register(
    "term_counts",
    O.with_ctes(["stg_scores"], """SELECT term, 'B' || CAST(term AS VARCHAR) AS label, count(*) AS n_rows
        FROM stg_scores GROUP BY term ORDER BY term"""),
)
def q_term_counts(spark, base):
    s = layers(spark, base).scores
    return (
        s.groupBy("term").agg(F.count(F.lit(1)).alias("n_rows"))
        .select("term", F.concat(F.lit("B"), F.col("term").cast("string")).alias("label"), "n_rows")
        .orderBy("term")
    )


@register(
    "multi_target_counts",
    O.with_ctes(["stg_attendance"], """
        SELECT 'students in 2+ classes' AS check_name, count(*) AS n_entities FROM (
            SELECT student_id FROM (SELECT DISTINCT student_id, class_id FROM stg_attendance)
            GROUP BY student_id HAVING count(*) > 1)
        UNION ALL
        SELECT 'classes in 2+ schools', count(*) FROM (
            SELECT class_id FROM (SELECT DISTINCT class_id, school_id FROM stg_attendance)
            GROUP BY class_id HAVING count(*) > 1)"""),
)
def q_multi(spark, base):
    a = layers(spark, base).attendance
    return (
        Pm.count_multi(a, "student_id", "class_id").select(F.lit("students in 2+ classes").alias("check_name"), "n_entities")
        .unionByName(
            Pm.count_multi(a, "class_id", "school_id").select(F.lit("classes in 2+ schools").alias("check_name"), "n_entities")
        )
    )


@register(
    "pointer_coherence",
    O.with_ctes(["stg_scores", "stg_classes"], """SELECT count(*) AS n_rows, count_if(r._m IS NULL) AS n_unmatched
        FROM stg_scores s LEFT JOIN (SELECT DISTINCT student_id, class_id, true AS _m FROM stg_classes) r
        ON s.student_id = r.student_id AND s.class_id = r.class_id"""),
)
def q_pointer(spark, base):
    L = layers(spark, base)
    return Pm.pointer_coherence(L.scores, L.classes, ["student_id", "class_id"])


@register(
    "grain_volumes",
    O.with_ctes(["stg_attendance", "stg_scores"], """
        SELECT 'school x month' AS grain, count(*) AS n_rows FROM
          (SELECT DISTINCT school_id, date_trunc('month', start_date) FROM stg_attendance)
        UNION ALL SELECT 'student x month', count(*) FROM
          (SELECT DISTINCT student_id, date_trunc('month', start_date) FROM stg_attendance)
        UNION ALL SELECT 'student x subject x month', count(*) FROM
          (SELECT DISTINCT student_id, subject, date_trunc('month', start_date) FROM stg_attendance)
        UNION ALL SELECT 'student x term', count(*) FROM (SELECT DISTINCT student_id, term FROM stg_scores)
        UNION ALL SELECT 'class x term', count(*) FROM (SELECT DISTINCT class_id, term FROM stg_scores)
        UNION ALL SELECT 'school x term', count(*) FROM (SELECT DISTINCT a.school_id, b.term FROM
          (SELECT DISTINCT school_id, class_id FROM stg_attendance) a
          JOIN (SELECT DISTINCT class_id, term FROM stg_scores) b ON a.class_id = b.class_id)"""),
)
def q_grain_volumes(spark, base):
    L = layers(spark, base)
    a, s = L.attendance, L.scores
    month = F.trunc("start_date", "month")
    pairs = a.select("school_id", "class_id").distinct().join(s.select("class_id", "term").distinct(), "class_id")
    parts = [
        Pm.distinct_count(a, ["school_id", month], "school x month"),
        Pm.distinct_count(a, ["student_id", month], "student x month"),
        Pm.distinct_count(a, ["student_id", "subject", month], "student x subject x month"),
        Pm.distinct_count(s, ["student_id", "term"], "student x term"),
        Pm.distinct_count(s, ["class_id", "term"], "class x term"),
        Pm.distinct_count(pairs, ["school_id", "term"], "school x term"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("n_rows")


def _hist_sql(table: str, col: str, by: str, bins: int, ctes) -> str:
    body = f"""SELECT {by}, bin, lo + (bin - 1) * ((hi - lo) / {float(bins)!r}) AS bin_low,
        lo + bin * ((hi - lo) / {float(bins)!r}) AS bin_high, count(*) AS n
        FROM (SELECT t.{by}, r.lo, r.hi,
              CAST(CASE WHEN r.hi - r.lo = 0 THEN 1
                   ELSE least(floor((t.{col} - r.lo) / (r.hi - r.lo) * {float(bins)!r}) + 1, {bins}) END AS BIGINT) AS bin
              FROM {table} t JOIN (SELECT {by}, min({col}) AS lo, max({col}) AS hi FROM {table}
                                   WHERE {col} IS NOT NULL GROUP BY {by}) r ON t.{by} = r.{by}
              WHERE t.{col} IS NOT NULL)
        GROUP BY {by}, bin, lo, hi"""
    return O.norm(O.with_ctes(ctes, body), ["bin_low", "bin_high"])


@register("grade_histogram", _hist_sql("enriched", "grade", "subject", 60, ["enriched"]))
def q_hist(spark, base):
    return normalize(Pm.histogram(layers(spark, base).enriched, "grade", 60, ["subject"]))


_NULL_TABLES = ["raw_score", "raw_attendance", "raw_class", "raw_student"]
_RAW_COLS = {
    "raw_score": ["student_key", "term", "class_id", "subject_1", "subject_2", "subject_3", "subject_4"],
    "raw_attendance": ["school_id", "student_key", "class_id", "start", "end", "subject", "pct"],
    "raw_class": ["year", "class_id", "student_key"],
    "raw_student": ["student_key", "age_band", "district"],
}


def _null_long_sql():
    parts = []
    for t in _NULL_TABLES:
        for c in _RAW_COLS[t]:
            parts.append(
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                f"CAST(count_if({_q(c)} IS NULL) AS DOUBLE) / count(*) AS pct_null FROM {t}"
            )
    return " UNION ALL ".join(parts)


def _null_heat_sql():
    pivot = ", ".join(f"max(CASE WHEN table_name = '{t}' THEN pct_null END) AS {t}" for t in _NULL_TABLES)
    body = f"SELECT column_name, {pivot} FROM ({_null_long_sql()}) GROUP BY column_name"
    return O.norm(O.with_ctes(_NULL_TABLES, body), _NULL_TABLES)


@register("null_heat", _null_heat_sql())
def q_null_heat(spark, base):
    return normalize(Pm.null_heat(_raw(spark, base)))


@register(
    "top_null_columns",
    O.norm(O.with_ctes(_NULL_TABLES, f"""SELECT * FROM ({_null_long_sql()})
        ORDER BY pct_null DESC, table_name, column_name LIMIT 10"""), ["pct_null"]),
)
def q_top_null(spark, base):
    return normalize(Pm.top_null_columns(_raw(spark, base), 10))


@register(
    "id_overlap",
    """SELECT count_if(a.id IS NOT NULL) AS n_left, count_if(b.id IS NOT NULL) AS n_right,
        count_if(a.id IS NOT NULL AND b.id IS NOT NULL) AS n_overlap
        FROM (SELECT DISTINCT doc_id AS id FROM labels WHERE doc_id IS NOT NULL) a
        FULL OUTER JOIN (SELECT DISTINCT doc_id AS id FROM documents WHERE doc_id IS NOT NULL) b ON a.id = b.id""",
)
def q_overlap(spark, base):
    return Pm.id_overlap(_t(spark, base, "labels"), "doc_id", _t(spark, base, "documents"), "doc_id")


_SUBJ = list(QP.subject_map)


def _score_stats_sql():
    cols = [
        "count(*) AS n_rows",
        "count(DISTINCT student_key) AS n_students",
        "count_if(term IS NOT NULL AND TRY_CAST(term AS BIGINT) IS NULL) AS n_term_cast_fail",
        "min(class_id) AS min_class_id",
        "max(class_id) AS max_class_id",
    ]
    for m in _SUBJ:
        cols += [
            f"count_if({m} IS NULL) AS {m}_nulls",
            f"min({m}) AS {m}_min",
            f"max({m}) AS {m}_max",
            f"avg({m}) AS {m}_mean",
            f"stddev_samp({m}) AS {m}_std",
        ]
    dbl = [f"{m}_{s}" for m in _SUBJ for s in ("min", "max", "mean", "std")]
    return O.norm(O.with_ctes(["raw_score"], f"SELECT {', '.join(cols)} FROM raw_score"), dbl)


@register("score_stats", _score_stats_sql())
def q_score_stats(spark, base):
    r = _raw(spark, base)["raw_score"]
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("student_key").alias("n_students"),
        F.count_if(F.col("term").isNotNull() & F.col("term").try_cast("bigint").isNull()).alias("n_term_cast_fail"),
        F.min("class_id").alias("min_class_id"),
        F.max("class_id").alias("max_class_id"),
    ]
    for m in _SUBJ:
        aggs += [
            F.count_if(F.col(m).isNull()).alias(f"{m}_nulls"),
            F.min(m).alias(f"{m}_min"),
            F.max(m).alias(f"{m}_max"),
            F.avg(m).alias(f"{m}_mean"),
            F.stddev_samp(m).alias(f"{m}_std"),
        ]
    return normalize(r.agg(*aggs))


@register(
    "attendance_stats",
    O.norm(O.with_ctes(["stg_attendance"], """SELECT count(pct) AS n, min(pct) AS min,
        quantile_disc(pct, 0.01) AS p01, quantile_disc(pct, 0.5) AS p50, avg(pct) AS mean,
        quantile_disc(pct, 0.99) AS p99, max(pct) AS max, stddev_samp(pct) AS std FROM stg_attendance"""),
        ["min", "p01", "p50", "mean", "p99", "max", "std"]),
)
def q_att_stats(spark, base):
    return normalize(Pm.numeric_summary(layers(spark, base).attendance, "pct"))


@register(
    "mode_value",
    """SELECT o_orderpriority, count(*) AS n_rows FROM orders WHERE o_orderpriority IS NOT NULL
        GROUP BY o_orderpriority ORDER BY n_rows DESC, o_orderpriority ASC LIMIT 1""",
)
def q_mode(spark, base):
    return Pm.mode(_t(spark, base, "orders"), "o_orderpriority")


@register(
    "sample_rows",
    O.norm("""SELECT * FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 10""", ["o_totalprice"]),
)
def q_sample(spark, base):
    return normalize(Pm.sample_rows(_t(spark, base, "orders"), "o_orderkey", 10))


@register(
    "sample_per_group",
    O.norm("""SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority
        ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS k FROM orders) WHERE k <= 20""", ["o_totalprice"]),
)
def q_sample_per_group(spark, base):
    got = Pm.sample_per_group(_t(spark, base, "orders"), ["o_orderpriority"], "o_orderkey", 20)
    return normalize(got.select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"))


@register("schema_catalog")
def q_schema(spark, base):
    return IO.describe_schema(IO.read_tables(spark, base))


@register("table_volumes")
def q_volumes(spark, base):
    return normalize(IO.table_volumes(IO.read_tables(spark, base)))


@register(
    "freshness_events",
    O.norm(O.with_ctes(["stg_attendance"], f"""
        SELECT source, max_loaded_at, age_days,
          CASE WHEN max_loaded_at IS NULL THEN 'error' WHEN age_days > err THEN 'error'
               WHEN age_days > warn THEN 'warn' ELSE 'pass' END AS status
        FROM (
          SELECT 'events' AS source, max(ts) AS max_loaded_at,
                 (epoch_us(TIMESTAMP '{NOW}') - epoch_us(max(ts))) / 86400e6 AS age_days, 7.0 AS warn, 30.0 AS err
          FROM events
          UNION ALL
          SELECT 'attendance', CAST(max(start_date) AS TIMESTAMP),
                 (epoch_us(TIMESTAMP '{NOW}') - epoch_us(CAST(max(start_date) AS TIMESTAMP))) / 86400e6,
                 10950.0, 18250.0
          FROM stg_attendance)"""), ["age_days"]),
)
def q_fresh(spark, base):
    ev = IO.freshness(_t(spark, base, "events"), "events", "ts", 7, 30, NOW)
    at = IO.freshness(layers(spark, base).attendance, "attendance", F.col("start_date"), 10950, 18250, NOW)
    return normalize(ev.unionByName(at))


# --------------------------------------------------------------------------
# Mart reports
# --------------------------------------------------------------------------

from cohort_effects.operators import report as Rm  # noqa: E402

_MART_COLS = "school_id, subject, year, n_obs, pct_multi_school, raw_effect, weight, adj_effect, std_err, ci_low, ci_high, effect_class, confidence, rank_in_subject"


def _mart(spark, base):
    return layers(spark, base).mart


@register(
    "effect_distribution",
    O.with_ctes(["mart"], f"""SELECT subject, count(adj_effect) AS count,
        {O.rhu('avg(adj_effect)', 3)} AS mean, {O.rhu('stddev_samp(adj_effect)', 3)} AS std,
        {O.rhu('min(adj_effect)', 3)} AS min, {O.rhu('quantile_cont(adj_effect, 0.25)', 3)} AS q25,
        {O.rhu('quantile_cont(adj_effect, 0.5)', 3)} AS q50, {O.rhu('quantile_cont(adj_effect, 0.75)', 3)} AS q75,
        {O.rhu('max(adj_effect)', 3)} AS max
        FROM mart GROUP BY subject"""),
)
def q_effect_dist(spark, base):
    return Rm.describe_by(_mart(spark, base), ["subject"], "adj_effect", 3)


_PROBS = (0.01, 0.25, 0.5, 0.75, 0.99)


@register(
    "effect_quantile_sketches",
    sql(["demeaned"], " UNION ALL ".join(
        f"SELECT subject, CAST({p!r} AS DOUBLE) AS prob, count(grade_dm) AS n, true AS within_bound FROM demeaned GROUP BY subject" for p in _PROBS
    )),
)
def q_sketches(spark, base):
    """Sketches kept per (subject, year), merged over years, and each merged
    quantile's true rank in the detail against the sketch's bound."""
    dm = layers(spark, base).demeaned.select("subject", "year", "grade_dm")
    kept = QN.sketch(dm, ["subject", "year"], "grade_dm")
    est = QN.sketch_quantiles(kept, ["subject"], _PROBS)
    probs = est.select("subject", F.explode(F.arrays_zip(F.array(*[F.lit(p) for p in _PROBS]).alias("prob"), F.col("quantiles").alias("value"))).alias("x"))
    return QN.rank_check(dm, probs.select("subject", "x.prob", "x.value"), ["subject"], "grade_dm", QN.RANK_BOUND)


@register("effect_histogram", _hist_sql("mart", "adj_effect", "subject", 30, ["mart"]))
def q_effect_hist(spark, base):
    return normalize(Pm.histogram(_mart(spark, base), "adj_effect", 30, ["subject"]))


_TOP_COLS = ["rank_in_subject", "school_id", "n_obs", "adj_effect", "ci_low", "ci_high", "effect_class", "confidence"]
_TOP_SQL = O.norm(O.with_ctes(["mart"], f"""SELECT subject, year, {', '.join(_TOP_COLS)} FROM (
        SELECT *, row_number() OVER (PARTITION BY subject, year ORDER BY rank_in_subject, school_id) AS rn FROM mart)
        WHERE rn <= 10"""), ["adj_effect", "ci_low", "ci_high"])


def _top10(spark, base):
    return Rm.top_n_per(_mart(spark, base), ["subject", "year"], "rank_in_subject", 10, ["school_id"], _TOP_COLS)


@register("top10_by_subject", _TOP_SQL)
def q_top10(spark, base):
    return normalize(_top10(spark, base))


# Reference pair: "math" vs "language" -> subject_4 vs subject_1 in the fixture.
_A, _B = "subject_4", "subject_1"
_EXTREME_SQL_BODY = f"""SELECT school_id, year, a_effect, b_effect,
        (a_effect >= {QP.strong_cut!r} AND b_effect <= -{QP.weak_cut!r})
        OR (a_effect <= -{QP.strong_cut!r} AND b_effect >= {QP.weak_cut!r}) AS extreme
        FROM (SELECT school_id, year,
              max(CASE WHEN subject = '{_A}' THEN adj_effect END) AS a_effect,
              max(CASE WHEN subject = '{_B}' THEN adj_effect END) AS b_effect
              FROM mart GROUP BY school_id, year)
        WHERE a_effect IS NOT NULL AND b_effect IS NOT NULL"""


@register("extreme_profiles", O.norm(O.with_ctes(["mart"], _EXTREME_SQL_BODY), ["a_effect", "b_effect"]))
def q_extreme(spark, base):
    return normalize(Rm.extreme_profiles(_mart(spark, base), _A, _B, QP.strong_cut, QP.weak_cut))


@register(
    "extreme_share",
    O.norm(O.with_ctes(["mart"], f"""SELECT count(*) AS n_complete, count_if(extreme) AS n_extreme,
        count_if(extreme) * 100.0 / count(*) AS pct_extreme FROM ({_EXTREME_SQL_BODY})"""), ["pct_extreme"]),
)
def q_extreme_share(spark, base):
    return normalize(Rm.extreme_share(Rm.extreme_profiles(_mart(spark, base), _A, _B, QP.strong_cut, QP.weak_cut)))


@register(
    "shrink_limits",
    O.norm(O.with_ctes(["mart"], """SELECT subject, count(*) AS n, min(raw_effect) AS raw_min, max(raw_effect) AS raw_max,
        min(adj_effect) AS adj_min, max(adj_effect) AS adj_max, CAST(sum(n_obs) AS BIGINT) AS n_obs_total,
        (SELECT max(abs(raw_effect)) * 1.05 FROM mart) AS "limit"
        FROM mart GROUP BY subject"""), ["raw_min", "raw_max", "adj_min", "adj_max", '"limit"']),
)
def q_limits(spark, base):
    return normalize(Rm.symmetric_limits(_mart(spark, base)))


def _box_sql():
    c = "pct_multi_school"
    body = f"""SELECT subject, count({c}) AS n,
        count_if({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers,
        {O.rhu('q1', 3)} AS q1, {O.rhu('median', 3)} AS median, {O.rhu('q3', 3)} AS q3,
        {O.rhu(f'min(CASE WHEN {c} >= q1 - 1.5 * (q3 - q1) THEN {c} END)', 3)} AS whisker_low,
        {O.rhu(f'max(CASE WHEN {c} <= q3 + 1.5 * (q3 - q1) THEN {c} END)', 3)} AS whisker_high,
        {O.rhu(f'avg({c})', 3)} AS mean, {O.rhu(f'max({c})', 3)} AS max,
        {O.rhu(f'avg(CASE WHEN {c} > 0.1 THEN 1.0 ELSE 0.0 END)', 3)} AS share_above
        FROM mart JOIN (SELECT subject AS s, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
                        quantile_cont({c}, 0.75) AS q3 FROM mart GROUP BY subject) q ON mart.subject = q.s
        GROUP BY subject, q1, median, q3"""
    return O.with_ctes(["mart"], body)


@register("mobility_box", _box_sql())
def q_box(spark, base):
    return Rm.box_stats(_mart(spark, base), ["subject"], "pct_multi_school", 0.10, 3)


_ROW_ORDER = [QP.effect_labels[4], QP.effect_labels[3], QP.effect_labels[2], QP.effect_labels[1], QP.effect_labels[0]]


def _crosstab_sql():
    sig, inc = QP.confidence_labels
    order = " ".join(f"WHEN '{r}' THEN {i}" for i, r in enumerate([*_ROW_ORDER, "total"]))
    body = f"""SELECT effect_class,
        CAST(coalesce(max(CASE WHEN c = '{sig}' THEN n END), 0) AS BIGINT) AS {sig},
        CAST(coalesce(max(CASE WHEN c = '{inc}' THEN n END), 0) AS BIGINT) AS {inc},
        CAST(coalesce(max(CASE WHEN c = 'total' THEN n END), 0) AS BIGINT) AS total,
        CAST(CASE effect_class {order} END AS BIGINT) AS row_order
        FROM (SELECT CASE WHEN grouping(effect_class) = 1 THEN 'total' ELSE effect_class END AS effect_class,
                     CASE WHEN grouping(confidence) = 1 THEN 'total' ELSE confidence END AS c, count(*) AS n
              FROM mart GROUP BY CUBE (effect_class, confidence))
        GROUP BY effect_class ORDER BY row_order"""
    return O.with_ctes(["mart"], body)


@register("class_confidence_crosstab", _crosstab_sql())
def q_crosstab(spark, base):
    return Rm.crosstab(_mart(spark, base), "effect_class", "confidence", _ROW_ORDER, list(QP.confidence_labels))


_DASH_CLASSES = [QP.effect_labels[0], QP.effect_labels[1]]


@register(
    "dashboard_list",
    O.norm(O.with_ctes(["mart"], f"""SELECT * FROM mart WHERE effect_class IN ({', '.join(repr(c) for c in _DASH_CLASSES)})
        AND confidence IN ({', '.join(repr(c) for c in QP.confidence_labels)})
        ORDER BY subject, year, rank_in_subject, school_id"""), MART_D.split(", ")),
)
def q_dashboard(spark, base):
    return normalize(Rm.dashboard_list(_mart(spark, base), _DASH_CLASSES, QP.confidence_labels))


@register(
    "study_shortlist",
    O.norm(O.with_ctes(["mart"], f"""SELECT *, row_number() OVER (PARTITION BY subject, year
            ORDER BY weight DESC, rank_in_subject ASC, school_id ASC) AS priority
        FROM mart WHERE effect_class IN ('{QP.effect_labels[0]}', '{QP.effect_labels[4]}')
        AND confidence = '{QP.confidence_labels[0]}'"""), MART_D.split(", ")),
)
def q_shortlist(spark, base):
    return normalize(Rm.study_shortlist(_mart(spark, base), QP))


@register(
    "monitoring_list",
    O.norm(O.with_ctes(["mart"], f"""SELECT * FROM mart WHERE effect_class IN ('{QP.effect_labels[0]}', '{QP.effect_labels[4]}')
        AND confidence = '{QP.confidence_labels[1]}'"""), MART_D.split(", ")),
)
def q_monitoring(spark, base):
    return normalize(Rm.monitoring_list(_mart(spark, base), QP))


# --------------------------------------------------------------------------
# Sinks: partitioned mart, per-subject CSV, single-year overwrite
# --------------------------------------------------------------------------

from cohort_effects.operators.ranges import written  # noqa: E402
from cohort_effects.plans.build import DETAIL_CLUSTER, MART_CLUSTER  # noqa: E402
from cohort_effects.session import work_path  # noqa: E402
from cohort_effects.sources.clustered import read_clustered, write_clustered  # noqa: E402
from cohort_effects.sources.schemas import MART_SCHEMA  # noqa: E402

_SLICE_YEAR = 1998


@register("mart_year_slice", O.norm(O.with_ctes(["mart"], f"SELECT * FROM mart WHERE year = {_SLICE_YEAR}"), MART_D.split(", ")))
def q_year_slice(spark, base):
    path = work_path(spark, "mart")
    write_clustered(_mart(spark, base), path, MART_CLUSTER)
    back = read_clustered(spark, path, {"year": _SLICE_YEAR}, MART_SCHEMA)
    return normalize(back.select(*_MART_COLS.split(", ")))


@register(
    "detail_subject_slice",
    sql(["demeaned"], f"SELECT student_id, school_id, term, grade_dm FROM demeaned WHERE year = {_SLICE_YEAR} AND subject = 'subject_1'", "grade_dm"),
)
def q_subject_slice(spark, base):
    """S6/S7 on the detail: one subject of one year, read from the files whose
    index range holds it."""
    path = work_path(spark, "detail")
    L = layers(spark, base)
    counts = L.context.where(F.col("year").isNotNull()).groupBy("year", *DETAIL_CLUSTER).agg(F.count("*").alias("n"))
    write_clustered(L.demeaned, path, DETAIL_CLUSTER, sort_by=["student_id", "term"], rows_per_file=1000, counts=counts)
    back = read_clustered(spark, path, {"year": _SLICE_YEAR, "subject": "subject_1"}, L.demeaned.schema)
    return normalize(back.select("student_id", "school_id", "term", "grade_dm"))


@register("replace_load", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def q_replace(spark, base):
    """A load of half the rows, then the full one twice; the last is read."""
    target = work_path(spark, "replaced")
    rows = _t(spark, base, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    for part in (rows.where("c_custkey % 2 = 0"), rows, rows):
        IO.replace_table(part, target)
    return IO.read_current(spark, target, rows.schema)


@register("top10_csv", _TOP_SQL)
def q_top10_csv(spark, base):
    path = work_path(spark, "top10_csv")
    IO.write_csv_by(_top10(spark, base), path, "subject")
    schema = (
        "year bigint, rank_in_subject bigint, school_id bigint, n_obs bigint, adj_effect double, "
        "ci_low double, ci_high double, effect_class string, confidence string, subject string"
    )
    back = spark.read.schema(schema).option("header", True).csv(path)
    return normalize(back.select("subject", "year", *_TOP_COLS))


@register("mart_overwrite_year", O.norm(O.with_ctes(["mart"], "SELECT * FROM mart"), MART_D.split(", ")))
def q_overwrite(spark, base):
    path = work_path(spark, "mart_rw")
    m = _mart(spark, base)
    write_clustered(m, path, MART_CLUSTER)
    # Rebuild only one year: with dynamic overwrite the other years stay.
    write_clustered(m.filter(F.col("year") == _SLICE_YEAR), path, MART_CLUSTER, dynamic=True)
    return normalize(spark.read.schema(m.schema).parquet(path).select(*_MART_COLS.split(", ")))


# --------------------------------------------------------------------------
# Declared-but-unbuilt ideas of the project
# --------------------------------------------------------------------------


@register(
    "unknown_class_flag",
    O.norm(O.with_ctes(["stg_attendance", "stg_classes"], """SELECT count(*) AS n_rows,
        count_if(r._m IS NULL) AS n_unknown_class,
        CAST(count_if(r._m IS NULL) AS DOUBLE) / count(*) AS pct_unknown_class
        FROM stg_attendance a LEFT JOIN (SELECT DISTINCT class_id AS _k, true AS _m FROM stg_classes
                                         WHERE class_id IS NOT NULL) r ON a.class_id = r._k"""),
        ["pct_unknown_class"]),
)
def q_unknown(spark, base):
    from cohort_effects.operators.enrich import flag_unknown

    L = layers(spark, base)
    f = flag_unknown(L.attendance, L.classes)
    return normalize(
        f.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("unknown_class").alias("n_unknown_class")).withColumn(
            "pct_unknown_class", F.try_divide(F.col("n_unknown_class").cast("double"), F.col("n_rows").cast("double"))
        )
    )


@register(
    "domain_rules",
    O.with_ctes(["stg_attendance", "stg_scores"], """
        SELECT 'start_before_end' AS rule,
               count_if(start_date IS NOT NULL AND end_date IS NOT NULL AND NOT (start_date < end_date)) AS violations,
               count(*) AS total FROM stg_attendance
        UNION ALL
        SELECT 'scored_student_has_attendance', count_if(a._m IS NULL), count(*)
        FROM (SELECT DISTINCT student_id FROM stg_scores WHERE student_id IS NOT NULL) s
        LEFT JOIN (SELECT DISTINCT student_id AS _s, true AS _m FROM stg_attendance) a ON s.student_id = a._s"""),
)
def q_domain(spark, base):
    L = layers(spark, base)
    return Qm.domain_rules(L.attendance, L.scores)


@register("bootstrap_effects")
def q_bootstrap_effects(spark, base):
    """Z2 by student, through the shrinkage (hash-seeded: rows-only check)."""
    from cohort_effects.operators.effects import bootstrap_effects

    return normalize(bootstrap_effects(layers(spark, base).demeaned, replicates=20))


@register("bootstrap_se")
def q_bootstrap(spark, base):
    from cohort_effects.operators.effects import bootstrap_se

    return normalize(bootstrap_se(layers(spark, base).demeaned, replicates=20))


@register("mart_stream_refresh", O.norm(O.with_ctes(["mart"], "SELECT * FROM mart"), MART_D.split(", ")))
def q_stream_refresh(spark, base):
    """Score files arrive in two drops; after each drop the refresh stream
    runs (available-now trigger, one shared checkpoint, so the second run
    sees only the new files) and rebuilds the touched years.  Attendance and
    roster stay the same, so their bridges are made once for both.  The mart is
    then read back whole."""
    from dataclasses import replace

    from cohort_effects.plans.build import build_layers
    from cohort_effects.streaming import start_year_refresh

    li = _t(spark, base, "lineitem")
    raw_att, raw_cls = FX.raw_attendance(li), FX.raw_class(li)
    inbox, mart_path, ckpt = work_path(spark, "inbox"), work_path(spark, "mart_stream"), work_path(spark, "stream_ckpt")
    schema = FX.raw_score(li).schema

    both = build_layers(FX.raw_score(li), raw_att, raw_cls, None, QP)

    def build_mart(scores, years):
        L = build_layers(scores, raw_att, raw_cls, None, QP)
        return replace(L, make_bridge=lambda: both.bridge, make_years=lambda: both.years).mart_of(years)

    first = F.coalesce(F.year("l_shipdate") < 1998, F.lit(False))  # every row lands in one of the two drops
    for drop in (li.filter(first), li.filter(~first)):
        FX.raw_score(drop).write.mode("append").parquet(inbox)
        start_year_refresh(spark, inbox, schema, build_mart, raw_cls, mart_path, ckpt).awaitTermination()
    return normalize(spark.read.schema(MART_SCHEMA).parquet(mart_path).select(*_MART_COLS.split(", ")))


@register("mart_delta_refresh", O.norm(O.with_ctes(["mart"], "SELECT * FROM mart"), MART_D.split(", ")))
def q_delta_refresh(spark, base):
    """The same two drops; the second is taken in as changes of the students'
    and the groups' sums, and no file of the first is read again."""
    from cohort_effects.operators import enrich, staging
    from cohort_effects.streaming.deltas import State, start_delta_refresh

    li = _t(spark, base, "lineitem")
    bridge = enrich.class_school_bridge(staging.clean_attendance(FX.raw_attendance(li)))
    years = enrich.class_year(staging.clean_classes(FX.raw_class(li)))
    bridge, years = written(bridge, "bridge"), written(years, "years")
    inbox, mart_path, ckpt = work_path(spark, "inbox"), work_path(spark, "mart_delta"), work_path(spark, "delta_ckpt")
    state, schema = State(spark, work_path(spark, "delta_state"), 16), FX.raw_score(li).schema
    first = F.coalesce(F.year("l_shipdate") < 1998, F.lit(False))
    for drop in (li.filter(first), li.filter(~first)):
        FX.raw_score(drop).write.mode("append").parquet(inbox)
        start_delta_refresh(spark, inbox, schema, bridge, years, state, mart_path, ckpt, QP).awaitTermination()
    return normalize(spark.read.schema(MART_SCHEMA).parquet(mart_path).select(*_MART_COLS.split(", ")))


@register("build_and_test", sql(_DQ_ALL, SU.results_sql(SU.generic_checks(QP) + SU.singular_meta(QP), QP)))
def q_build(spark, base):
    """M16 end to end: write the table layers (contract + NOT NULL guard),
    then run the suite on what was written."""
    from cohort_effects.plans.build import checkpointed, run_build

    L = fixture_layers(spark, base, QP, materialize=checkpointed, materialize_model=False)
    return run_build(L, work_path(spark, "build"), QP, gate_on_errors=False)



@register("sample_fraction")
def q_sample_fraction(spark, base):
    """T-4: about 10% of lineitem, Bernoulli per row (rows-only check)."""
    return normalize(Pm.sample_fraction(_t(spark, base, "lineitem"), 0.10, seed=42))
