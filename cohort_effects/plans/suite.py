"""The project's check suite over the build layers (33 generic + 8
singular checks), and its SQL rendering for the DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohort_effects.operators import quality as Q
from cohort_effects.params import Params
from cohort_effects.plans.build import Layers

# Layer name -> oracle CTE name
SQL_TABLE = {
    "students": "stg_students",
    "scores": "stg_scores",
    "attendance": "stg_attendance",
    "classes": "stg_classes",
    "bridge": "bridge",
    "enriched": "enriched",
    "demeaned": "demeaned",
    "effects": "effects",
    "variances": "variances",
    "mart": "mart",
}


def generic_checks(p: Params) -> list[Q.Check]:
    C = Q.Check
    # Which rule holds for which column of the project's layers.
    return [
        # Q1 not_null x10
        C("nn_students_student_id", "not_null", "students", ("student_id",)),
        C("nn_bridge_class_id", "not_null", "bridge", ("class_id",)),
        C("nn_bridge_school_id", "not_null", "bridge", ("school_id",)),
        C("nn_enriched_class_id", "not_null", "enriched", ("class_id",)),
        C("nn_enriched_grade", "not_null", "enriched", ("grade",)),
        C("nn_effects_school_id", "not_null", "effects", ("school_id",)),
        C("nn_effects_pct_multi_school", "not_null", "effects", ("pct_multi_school",)),
        C("nn_variances_var_within", "not_null", "variances", ("var_within",)),
        C("nn_variances_var_between", "not_null", "variances", ("var_between",)),
        C("nn_variances_n_eff", "not_null", "variances", ("n_eff",)),
        # Q2 unique x2
        C("uq_students_student_id", "unique", "students", ("student_id",)),
        C("uq_bridge_class_id", "unique", "bridge", ("class_id",)),
        # Q3 unique combination x8
        C("uc_classes", "unique_combination", "classes", ("student_id", "class_id")),
        C("uc_attendance", "unique_combination", "attendance", ("student_id", "class_id", "subject", "start_date")),
        C("uc_scores", "unique_combination", "scores", ("student_id", "term")),
        C("uc_enriched", "unique_combination", "enriched", ("student_id", "term", "subject")),
        C("uc_demeaned", "unique_combination", "demeaned", ("student_id", "class_id", "year", "term", "subject")),
        C("uc_effects", "unique_combination", "effects", ("school_id", "subject", "year")),
        C("uc_variances", "unique_combination", "variances", ("subject", "year")),
        C("uc_mart", "unique_combination", "mart", ("school_id", "subject", "year")),
        # Q4 accepted values x4
        C("av_scores_term", "accepted_values", "scores", ("term",), {"values": list(p.valid_terms)}),
        C("av_mart_subject", "accepted_values", "mart", ("subject",), {"values": p.subjects}),
        C("av_mart_effect_class", "accepted_values", "mart", ("effect_class",), {"values": list(p.effect_labels)}),
        C("av_mart_confidence", "accepted_values", "mart", ("confidence",), {"values": list(p.confidence_labels)}),
        # Q5 relationships x2
        C("rel_attendance_student", "relationships", "attendance", ("student_id",),
          {"to": "students", "field": "student_id"}),
        C("rel_attendance_class", "relationships", "attendance", ("class_id",),
          {"to": "classes", "field": "class_id"}, severity="prod_error"),
        # Q6 between x5
        C("bt_enriched_grade", "between", "enriched", ("grade",), {"min": p.grade_range[0], "max": p.grade_range[1]}),
        C("bt_effects_n_obs", "between", "effects", ("n_obs",), {"min": 1}),
        C("bt_effects_pct_multi_school", "between", "effects", ("pct_multi_school",), {"min": 0.0, "max": 1.0}),
        C("bt_mart_weight", "between", "mart", ("weight",), {"min": 0.0, "max": 1.0}),
        C("bt_mart_adj_effect", "between", "mart", ("adj_effect",),
          {"min": p.effect_range[0], "max": p.effect_range[1]}),
        # Q7, Q8
        C("mean_mart_adj_effect", "mean_between", "mart", ("adj_effect",),
          {"min": p.mean_effect_range[0], "max": p.mean_effect_range[1]}, severity="prod_error"),
        C("stdev_mart_adj_effect", "stdev_between", "mart", ("adj_effect",),
          {"min": p.stdev_effect_range[0], "max": p.stdev_effect_range[1]}, severity="prod_error"),
    ]


def singular_checks(L: Layers, p: Params, tags: dict | None = None, masking: bool = False) -> list[Q.Check]:
    C = Q.Check
    tags = tags or {}
    spark = L.scores.sparkSession

    def sentinel():
        bad = Q.tag_sentinel(tags) if masking else []
        return spark.createDataFrame(bad, "column_name string, tag string")

    return [
        C("zero_sum_demeaned", "custom", "demeaned",
          custom=lambda: Q.zero_sum(L.demeaned, ["student_id", "year"], "grade_dm", p.zero_sum_tol)),
        C("monotone_weight", "custom", "mart",
          custom=lambda: Q.monotone(L.mart, ["subject", "year"], ["n_obs", "school_id"], "weight", p.monotone_tol)),
        C("row_conservation", "custom", "mart",
          custom=lambda: Q.row_conservation(L.mart, L.demeaned).filter("mismatch")),
        C("term_gaps", "custom", "enriched", severity="prod_error",
          custom=lambda: Q.term_gaps(L.enriched, deal=True)),
        C("class_one_year", "custom", "classes", severity="prod_error",
          custom=lambda: Q.one_value_per_key(L.classes, "class_id", "year")),
        C("orphan_share_scores", "custom", "enriched", severity="prod_error",
          custom=lambda: Q.over_share(Q.orphan_share_rows(L.enriched, "school_id"), p.max_orphan_share_scores)),
        C("orphan_share_classes", "custom", "attendance",
          custom=lambda: Q.over_share(
              Q.orphan_share_groups(L.attendance, "class_id", "school_id"), p.max_orphan_share_classes)),
        C("policy_tag_sentinel", "custom", "-", custom=sentinel),
    ]


def singular_meta(p: Params) -> list[Q.Check]:
    """Names, tables and severities of the singular checks (no plans)."""
    return [
        Q.Check(n, "custom", t, severity=sev)
        for n, t, sev in [
            ("zero_sum_demeaned", "demeaned", "error"),
            ("monotone_weight", "mart", "error"),
            ("row_conservation", "mart", "error"),
            ("term_gaps", "enriched", "prod_error"),
            ("class_one_year", "classes", "prod_error"),
            ("orphan_share_scores", "enriched", "prod_error"),
            ("orphan_share_classes", "attendance", "error"),
            ("policy_tag_sentinel", "-", "error"),
        ]
    ]


RAW_TABLES = ["raw_score", "raw_attendance", "raw_class"]


def raw_checks() -> list[Q.Check]:
    """One generic check of each kind over raw layers, narrow enough to fail."""
    C = Q.Check
    return [
        C("raw_nn_attendance_school", "not_null", "raw_attendance", ("school_id",)),
        C("raw_uq_class", "unique", "raw_class", ("class_id",)),
        C("raw_uc_score", "unique_combination", "raw_score", ("student_key", "term")),
        C("raw_av_subject", "accepted_values", "raw_attendance", ("subject",), {"values": ["subject_1", "subject_2"]}),
        C("raw_rel_class", "relationships", "raw_attendance", ("class_id",), {"to": "raw_class", "field": "class_id"}),
        C("raw_between_pct", "between", "raw_attendance", ("pct",), {"min": 99.25, "max": 99.75}),
        C("raw_mean_score", "mean_between", "raw_score", ("subject_1",), {"min": 0.0, "max": 1.0}),
        C("raw_stdev_score", "stdev_between", "raw_score", ("subject_1",), {"min": 0.0, "max": 1.0}),
    ]


def tables_of(L: Layers, checks: list[Q.Check] | None = None) -> dict:
    """The layers by name; of ``checks``, those alone that they read (the moments
    and the mart are built where they are asked for)."""
    read = SQL_TABLE if checks is None else {t for c in checks for t in (c.table, c.args.get("to"))}
    return {k: getattr(L, k) for k in SQL_TABLE if k in read}


def suite(L: Layers, p: Params) -> list[Q.Check]:
    return generic_checks(p) + singular_checks(L, p)


# ---------------------------------------------------------------------------
# SQL rendering (oracle)
# ---------------------------------------------------------------------------


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else repr(v)


def _sql_count(ch: Q.Check) -> str:
    t = SQL_TABLE.get(ch.table, ch.table)
    a = ch.args
    c = ch.cols[0] if ch.cols else None
    if ch.kind == "not_null":
        return f"SELECT count(*) FROM {t} WHERE {c} IS NULL"
    if ch.kind == "unique":
        return f"SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
    if ch.kind == "unique_combination":
        cols = ", ".join(ch.cols)
        return f"SELECT count(*) FROM (SELECT {cols} FROM {t} GROUP BY {cols} HAVING count(*) > 1)"
    if ch.kind == "accepted_values":
        vals = ", ".join(_lit(v) for v in a["values"])
        return f"SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN ({vals}) GROUP BY {c})"
    if ch.kind == "relationships":
        pt = SQL_TABLE.get(a["to"], a["to"])
        return (f"SELECT count(*) FROM {t} ch WHERE ch.{c} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {pt} pa WHERE pa.{a['field']} = ch.{c})")
    if ch.kind == "between":
        conds = []
        if a.get("min") is not None:
            conds.append(f"{c} < {a['min']!r}")
        if a.get("max") is not None:
            conds.append(f"{c} > {a['max']!r}")
        return f"SELECT count(*) FROM {t} WHERE {c} IS NOT NULL AND ({' OR '.join(conds)})"
    if ch.kind in ("mean_between", "stdev_between"):
        fn = "avg" if ch.kind == "mean_between" else "stddev_samp"
        return (f"SELECT count(*) FROM (SELECT {fn}({c}) AS v FROM {t}) "
                f"WHERE NOT (v >= {a['min']!r} AND v <= {a['max']!r})")
    raise ValueError(ch.kind)


#: One row for each thing a singular check counts; the catalogue's queries show
#: some of them, the suite counts them.
DROPS = """SELECT b.weight < a.weight - {tol!r} AS drops
    FROM (SELECT *, row_number() OVER (PARTITION BY subject, year ORDER BY n_obs, school_id) AS k FROM mart) b
    LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY subject, year ORDER BY n_obs, school_id) AS k FROM mart) a
    ON a.subject = b.subject AND a.year = b.year AND a.k = b.k - 1"""
BALANCE = """SELECT subject, year, CAST(sum(claimed) AS BIGINT) AS n_obs_mart, CAST(sum(there) AS BIGINT) AS n_obs_int
    FROM (SELECT subject, year, n_obs AS claimed, NULL AS there FROM mart
          UNION ALL SELECT subject, year, NULL, 1 FROM demeaned WHERE school_id IS NOT NULL)
    GROUP BY subject, year"""
GAPS = """SELECT student_id, year, subject, count(DISTINCT term) AS n_terms, max(term) AS max_term
    FROM enriched WHERE term IS NOT NULL GROUP BY student_id, year, subject HAVING n_terms <> max_term"""
NO_SCHOOL = "SELECT class_id, bool_and(school_id IS NULL) AS orphan FROM stg_attendance WHERE class_id IS NOT NULL GROUP BY class_id"


def singular_sql(p: Params) -> dict[str, str]:
    """Failing-row counts of the singular checks."""
    return {
        "zero_sum_demeaned": f"""SELECT count(*) FROM (SELECT 1 FROM demeaned GROUP BY student_id, year
            HAVING abs(avg(grade_dm)) > {p.zero_sum_tol!r})""",
        "monotone_weight": f"SELECT count_if(drops) FROM ({DROPS.format(tol=p.monotone_tol)})",
        "row_conservation": f"SELECT count_if(n_obs_mart IS DISTINCT FROM n_obs_int) FROM ({BALANCE})",
        "term_gaps": f"SELECT count(*) FROM ({GAPS})",
        "class_one_year": """SELECT count(*) FROM (SELECT class_id FROM stg_classes WHERE class_id IS NOT NULL
            GROUP BY class_id HAVING min(year) < max(year))""",
        "orphan_share_scores": f"""SELECT CAST(coalesce(avg(CAST(school_id IS NULL AS DOUBLE)) > {p.max_orphan_share_scores!r}, false)
            AS BIGINT) FROM enriched""",
        "orphan_share_classes": f"""SELECT CAST(coalesce(avg(CAST(orphan AS DOUBLE)) > {p.max_orphan_share_classes!r}, false) AS BIGINT)
            FROM ({NO_SCHOOL})""",
        "policy_tag_sentinel": "SELECT CAST(0 AS BIGINT)",
    }


def counts_sql(checks: list[Q.Check], p: Params) -> str:
    """UNION ALL of (check_name, failures) rows."""
    sing = singular_sql(p)
    rows = []
    for ch in checks:
        body = sing[ch.name] if ch.kind == "custom" else _sql_count(ch)
        rows.append(f"SELECT '{ch.name}' AS check_name, CAST(({body}) AS BIGINT) AS failures")
    return "\nUNION ALL\n".join(rows)


def results_sql(checks: list[Q.Check], p: Params) -> str:
    meta = "\nUNION ALL\n".join(
        f"SELECT '{c.name}' AS check_name, '{c.kind}' AS kind, '{c.table}' AS table_name, "
        f"'{Q.effective_severity(c.severity, p.target)}' AS severity"
        for c in checks
    )
    return f"""SELECT m.check_name, m.kind, m.table_name, m.severity, c.failures,
        CASE WHEN c.failures = 0 THEN 'pass' WHEN m.severity = 'error' THEN 'fail' ELSE 'warn' END AS status
        FROM ({meta}) m JOIN ({counts_sql(checks, p)}) c ON m.check_name = c.check_name"""


ALL_SQL_TABLES = list(SQL_TABLE.values())
