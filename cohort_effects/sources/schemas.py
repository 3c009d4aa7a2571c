"""Declared schemas: input contracts (S3) and output contracts (Q12).

Descriptions and sensitivity tags ride in ``StructField.metadata``.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, D, S, B, DT, BIN = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.DateType(), T.BinaryType()

# Sensitivity categories (tags); actions are chosen by the caller.
DIRECT_ID = "direct_identifier"
DEMOGRAPHIC = "demographic"
MINOR_PERFORMANCE = "minor_performance"


def _f(name, dtype, nullable=True, desc="", tag=None):
    meta = {"description": desc}
    if tag:
        meta["sensitivity"] = tag
    return T.StructField(name, dtype, nullable, meta)


# Raw source contracts of the analysed project (wide score table etc.).
SOURCE_SCHEMAS = {
    "student": T.StructType([_f("id_aluno", BIN), _f("id_turma", L), _f("faixa_etaria", S), _f("bairro", L)]),
    "roster": T.StructType([_f("ano", L), _f("id_turma", L), _f("id_aluno", BIN)]),
    "attendance": T.StructType([
        _f("id_escola", L), _f("id_aluno", BIN), _f("id_turma", L), _f("data_inicio", S),
        _f("data_fim", S), _f("disciplina", S), _f("frequencia", D),
    ]),
    "score": T.StructType([
        _f("id_aluno", BIN), _f("id_turma", L), _f("bimestre", S),
        _f("disciplina_1", D), _f("disciplina_2", D), _f("disciplina_3", D), _f("disciplina_4", D),
    ]),
}

# Column mappings that let the cleaners read those raw names directly.
SOURCE_COLUMNS = {
    "student": {"student": "id_aluno", "class_id": "id_turma", "age_band": "faixa_etaria", "district": "bairro"},
    "roster": {"student": "id_aluno", "class_id": "id_turma", "year": "ano"},
    "attendance": {"student": "id_aluno", "class_id": "id_turma", "subject": "disciplina", "start": "data_inicio",
                   "school": "id_escola", "end": "data_fim", "pct": "frequencia"},
    "score": {"student": "id_aluno", "term": "bimestre", "class_id": "id_turma"},
}

MART_SCHEMA = T.StructType([
    _f("school_id", L, False, "group (school) id"),
    _f("subject", S, False, "subject name"),
    _f("year", L, False, "school year; partition column"),
    _f("n_obs", L, False, "demeaned observations in the group"),
    _f("pct_multi_school", D, False, "share of observations from students in 2+ schools that year"),
    _f("raw_effect", D, False, "mean demeaned grade"),
    _f("weight", D, False, "shrinkage weight in [0, 1]"),
    _f("adj_effect", D, False, "weight x raw effect", MINOR_PERFORMANCE),
    _f("std_err", D, False, "sqrt((1 - weight) x clamped var_between)"),
    _f("ci_low", D, False, "adj_effect - z x std_err"),
    _f("ci_high", D, False, "adj_effect + z x std_err"),
    _f("effect_class", S, False, "magnitude band"),
    _f("confidence", S, False, "significant when the interval excludes 0"),
    _f("rank_in_subject", L, False, "dense rank of adj_effect within (subject, year)"),
])

DEMEANED_SCHEMA = T.StructType([
    _f("student_id", S, False, "hex student id", DIRECT_ID),
    _f("class_id", L, False),
    _f("year", L, False),
    _f("term", L, False),
    _f("subject", S, False),
    _f("school_id", L, True),
    _f("grade", D, False, "grade", MINOR_PERFORMANCE),
    _f("student_mean", D, False),
    _f("grade_dm", D, False, "grade - student mean", MINOR_PERFORMANCE),
    _f("n_obs_student", L, False),
    _f("multi_school", B, False),
])

BRIDGE_SCHEMA = T.StructType([
    _f("class_id", L, False, "class"),
    _f("school_id", L, False, "school the class was seen in"),
])

ENRICHED_SCHEMA = T.StructType([
    _f("student_id", S, True, "hex student id", DIRECT_ID),
    _f("term", L),
    _f("subject", S, False),
    _f("class_id", L),
    _f("school_id", L, True, "NULL for a class without a school"),
    _f("year", L, True, "NULL for a class without a year"),
    _f("grade", D, False, "grade", MINOR_PERFORMANCE),
    _f("multi_school", B, False, "student in 2+ schools that year"),
])

EFFECTS_SCHEMA = T.StructType([
    _f("school_id", L, False),
    _f("subject", S, False),
    _f("year", L, False),
    _f("n_obs", L, False),
    _f("pct_multi_school", D, False),
    _f("raw_effect", D, False, "mean demeaned grade", MINOR_PERFORMANCE),
])

VARIANCES_SCHEMA = T.StructType([
    _f("subject", S, False),
    _f("year", L, False),
    _f("var_total", D),
    _f("var_within", D),
    _f("var_between", D, True, "before clamping; may be negative"),
    _f("n_eff", D, True, "effective group size"),
])

NOT_NULL_MART = [f.name for f in MART_SCHEMA.fields if not f.nullable]
NOT_NULL_DEMEANED = [f.name for f in DEMEANED_SCHEMA.fields if not f.nullable]

STUDENT_TAGS = {"student_id": DIRECT_ID, "age_band": DEMOGRAPHIC}
