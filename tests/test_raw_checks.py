"""Checks and bridges on data where they find something."""

from conftest import SF_SMALL

from cohort_effects.plans.catalog import QUERIES


def test_every_kind_of_check_fails_somewhere(spark):
    rows = {r.check_name: r.failures for r in QUERIES["dq_raw_layers"](spark, SF_SMALL).collect()}
    assert len(rows) == 8 and min(rows.values()) > 0


def test_classes_that_span_schools_and_years(spark):
    rows = QUERIES["spanning_classes"](spark, SF_SMALL).collect()
    assert len(rows) == 7 and max(r.n_schools for r in rows) > 1 and all(r.n_years > 1 for r in rows)


def test_profile_covers_every_column(spark):
    from cohort_effects.sources.io import TABLES

    rows = QUERIES["column_profile"](spark, SF_SMALL).collect()
    want = {(t, c) for t in TABLES for c in spark.read.parquet(f"{SF_SMALL}/{t}.parquet").columns}
    assert {(r.table_name, r.column_name) for r in rows} == want
