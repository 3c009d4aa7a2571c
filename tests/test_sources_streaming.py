import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_freshness_from_file_metadata(spark, tmp_path):
    from cohort_effects.sources import io

    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    df = spark.read.parquet(path)
    r = io.freshness(df, "t", None, 7, 30, dt.datetime.utcnow() + dt.timedelta(days=10)).collect()[0]
    assert r.status == "warn" and 9.9 < r.age_days < 10.1
    r = io.freshness(df, "t", None, 7, 30, dt.datetime.utcnow() + dt.timedelta(days=40)).collect()[0]
    assert r.status == "error"


def test_volumes_and_catalog(spark):
    from cohort_effects.sources import io

    t = io.read_tables(spark, SF_SMALL, ["region", "nation"])
    v = {r.table_name: r for r in io.table_volumes(t).collect()}
    assert v["region"].n_rows == 5 and v["nation"].n_columns == 3
    assert abs(sum(r.share_of_storage for r in v.values()) - 1.0) < 1e-9
    cat = io.describe_schema(t).collect()
    assert ("nation", "n_name", 2) in [(r.table_name, r.column_name, r.ordinal_position) for r in cat]


def test_stream_refresh_only_touched_years(spark, tmp_path):
    from cohort_effects.plans import fixtures as FX
    from cohort_effects.plans.build import build_layers
    from cohort_effects.sources.io import read_table
    from cohort_effects.streaming import start_year_refresh

    li = read_table(spark, SF_SMALL, "lineitem")
    att, cls = FX.raw_attendance(li), FX.raw_class(li)
    inbox, mart_path, ckpt = (str(tmp_path / n) for n in ("inbox", "mart", "ckpt"))
    schema = FX.raw_score(li).schema

    def build(scores, years):
        return build_layers(scores, att, cls).mart_of(years)

    FX.raw_score(li.filter(F.year("l_shipdate") < 1997)).write.parquet(inbox)
    start_year_refresh(spark, inbox, schema, build, cls, mart_path, ckpt).awaitTermination()
    years_1 = {r[0] for r in spark.read.parquet(mart_path).select("year").distinct().collect()}
    assert years_1 and max(years_1) <= 1997
    FX.raw_score(li.filter(F.year("l_shipdate") >= 1997)).write.mode("append").parquet(inbox)
    start_year_refresh(spark, inbox, schema, build, cls, mart_path, ckpt).awaitTermination()
    full = build_layers(FX.raw_score(li), att, cls).mart
    got = spark.read.parquet(mart_path)
    assert got.count() == full.count()
    key = ["school_id", "subject", "year"]
    diff = got.select(*key, "n_obs").exceptAll(full.select(*key, "n_obs"))
    assert diff.count() == 0


def test_run_build_writes_and_gates(spark, tmp_path):
    from cohort_effects.plans.catalog import QP
    from cohort_effects.plans.build import fixture_layers, run_build

    res = run_build(fixture_layers(spark, SF_SMALL, QP), str(tmp_path / "out"), QP, gate_on_errors=False)
    rows = {r.check_name: r for r in res.collect()}
    assert len(rows) == 41 and rows["zero_sum_demeaned"].status == "pass"
    assert os.path.isdir(str(tmp_path / "out" / "marts" / "effects"))


def test_a_failing_check_leaves_the_published_mart(spark, tmp_path):
    from dataclasses import replace

    import pytest

    from cohort_effects.operators.quality import ContractError
    from cohort_effects.plans.build import fixture_layers, run_build
    from cohort_effects.plans.catalog import QP

    out = str(tmp_path / "out")
    L = fixture_layers(spark, SF_SMALL, QP)
    run_build(L, out, QP, gate_on_errors=False)
    files = lambda: sorted(str(f) for f in (tmp_path / "out").rglob("*.parquet"))
    before = files()
    assert before
    with pytest.raises(ContractError):
        run_build(L, out, replace(QP, zero_sum_tol=-1.0))
    assert files() == before


def test_refresh_finds_null_keys_and_drops_emptied_years(spark, tmp_path):
    from cohort_effects.streaming.refresh import affected_years, refresh_years

    schema = "student_key binary, term string, class_id long"
    old = spark.createDataFrame([(b"a", "1", 1), (None, None, 2)], schema)
    batch = spark.createDataFrame([(None, None, 3)], schema)
    classes = spark.createDataFrame([(1997, 1, b"a"), (1998, 2, b"a"), (1999, 3, b"a")], "year long, class_id long, student_key binary")
    assert affected_years(batch, old.unionByName(batch), classes) == [1998, 1999]
    path = str(tmp_path / "mart")
    cols = "school_id long, subject string, effect_class string, year long"
    mart = spark.createDataFrame([(1, "s", "x", 1998), (2, "s", "x", 1999)], cols)
    refresh_years(mart, path, [1998, 1999])
    refresh_years(mart.where("year = 1999"), path, [1998, 1999])
    assert [tuple(r) for r in spark.read.parquet(path).select("school_id", "year").collect()] == [(2, 1999)]


def test_scale_conf_only_fills_unset_keys(spark):
    from cohort_effects.session import apply_scale_conf

    before = spark.conf.get("spark.sql.shuffle.partitions")
    key = "spark.sql.adaptive.skewJoin.skewedPartitionFactor"
    was_set = spark.conf.get(key, None)
    applied = apply_scale_conf(spark, {"spark.sql.shuffle.partitions": "20000", key: "4"})
    assert spark.conf.get("spark.sql.shuffle.partitions") == before  # set by the session: kept
    assert "spark.sql.shuffle.partitions" not in applied
    assert (key in applied) == (was_set is None)
