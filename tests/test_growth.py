"""What the figures of large runs rest on: sorts after the shuffle, layers made
once, tables built where they are read, tasks that grow with rows."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from cohort_effects.operators import effects as fx
from cohort_effects.operators.dedup import keep_first
from cohort_effects.plans import suite as SU
from cohort_effects.plans.build import build_layers
from cohort_effects.params import Params

DETAIL = "student_id string, year bigint, subject string, grade double, school_id bigint"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _layers(spark):
    rng = random.Random(3)
    rows = [(None if s == 0 else f"s{s}".encode(), str(t), s % 5 * 10 + 2, *[float(rng.randint(0, 10)) for _ in range(4)])
            for s in range(40) for t in range(1, 5)]
    scores = spark.createDataFrame(rows, "student_key binary, term string, class_id long, " + ", ".join(f"subject_{k} double" for k in range(1, 5)))
    att = spark.createDataFrame(
        [(r[2] // 10, r[0], r[2], "2000-01-01", "2000-01-31", "subject_1", 90.0) for r in rows],
        "school_id long, student_key binary, class_id long, start string, end string, subject string, pct double")
    cls = spark.createDataFrame([(2000, r[2], r[0]) for r in rows], "year long, class_id long, student_key binary")
    students = spark.createDataFrame([(b"s1", "a", 1)], "student_key binary, age_band string, district int")
    return build_layers(scores, att, cls, students, Params())


def test_first_rows_are_sorted_after_the_shuffle(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "b", "c"]), rng.choice([None, 1, 2]), rng.choice([None, 1, 2, 3]), k) for k in range(300)]
    df = spark.createDataFrame(rows * 2, "k string, t int, c int, id int")
    got = {(r.k, r.t): (r.c, r.id) for r in keep_first(df, ["k", "t"], ["c", "id"], deal=True).collect()}
    want = {}
    for k, t, c, i in rows:
        want[k, t] = min(want.get((k, t), (c is None, c or 0, c, i)), (c is None, c or 0, c, i))
    assert got == {key: (v[2], v[3]) for key, v in want.items()}
    below = _plan(keep_first(df, ["k", "t"], ["c", "id"], deal=True)).split("REPARTITION_BY_COL", 1)[1].split("Scan ", 1)[0]
    assert "Sort" not in below and "WindowGroupLimit" not in below  # the known keys' rows go to their task as they are


def test_grouping_by_the_keys_needs_no_other_shuffle(spark):
    df = spark.createDataFrame([("a", 1, 2)], "k string, t int, c int")
    counted = keep_first(df, ["k", "t"], ["c"], deal=True).groupBy("k", "t").count()
    assert _plan(counted).count("Exchange") == 2  # known and unknown keys


def test_dealt_demeaning_gives_the_same_rows(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, "", "a", "b", "c"]), rng.choice([None, 1, 2]), rng.choice("xyz"), float(rng.randint(0, 9)), rng.choice([None, 1, 2]))
            for _ in range(200)]
    df = spark.createDataFrame(rows, DETAIL)

    def bag(deal):
        return sorted(map(repr, fx.demean(df, flag_target="school_id", deal=deal).collect()))

    assert bag(True) == bag(False)
    assert "RepartitionByExpression" in _optimized(fx.demean(df, deal=True))


def test_detail_and_statistics_are_one_exchange(spark):
    moments = fx.group_moments(_layers(spark).demeaned)
    moments.collect()
    assert "ReusedExchange" in _plan(moments)
    df = spark.createDataFrame([("x", 2000, 1, 1.0), ("x", 2000, None, 5.0)], "subject string, year int, school_id int, grade_dm double")
    assert [r.school_id for r in fx.group_moments(df, flag=None).collect()] == [1]


def test_layers_read_more_than_once_are_written_once(spark):
    L = _layers(spark)
    for layer in (L.bridge, L.years, L.context, L.moments):
        assert len(layer.inputFiles()) >= 1 and "Join" not in _optimized(layer) and "Aggregate" not in _optimized(layer)
    assert "Join" not in _optimized(L.enriched.select("grade", "class_id"))  # the flag is not read
    whole = {(r.school_id, r.subject, r.year): r.adj_effect for r in L.mart.collect()}
    assert whole and whole == pytest.approx({(r.school_id, r.subject, r.year): r.adj_effect for r in L.mart_of([2000]).collect()})
    assert L.mart_of([1999]).collect() == []


def test_checks_build_the_tables_they_read(spark):
    L = _layers(spark)
    checks = [c for c in SU.generic_checks(Params()) if c.kind in ("not_null", "unique", "relationships")]
    read = SU.tables_of(L, checks)
    assert "mart" not in read and "mart" not in vars(L) and set(read) >= {"students", "bridge", "classes", "attendance", "effects"}
    assert set(SU.tables_of(L)) == set(SU.SQL_TABLE)


def test_small_files_share_a_task(spark, tmp_path):
    from cohort_effects.sources.clustered import file_index, write_clustered

    df = spark.range(3000).select(F.col("id").cast("int"), (F.col("id") % 2).cast("int").alias("year"), F.col("id").cast("int").alias("school"))
    path = str(tmp_path / "t")
    write_clustered(df, path, ["school"], rows_per_file=100)
    files = [f for folder, _, fs in os.walk(path) for f in fs if f.endswith(".parquet") and "_index" not in folder]
    assert len(files) == 30 and len({re.match(r"part-(\d+)", f)[1] for f in files}) == 1
    index = file_index(spark, path).orderBy("year", "min_school").collect()
    assert all(r.n_rows == 100 for r in index) and all(a.max_school < b.min_school for a, b in zip(index, index[1:], strict=False) if a.year == b.year)


def test_bootstrap_brings_cells_together_before_the_sums(spark):
    df = spark.createDataFrame([("a", 1, "x", 2000, 1.0)], "student_id string, school_id int, subject string, year int, grade_dm double")
    assert "RebalancePartitions" in _optimized(fx.bootstrap_effects(df, 3))


def test_refresh_reads_the_rosters_once(spark, monkeypatch):
    from cohort_effects.operators import enrich
    from cohort_effects.plans import build, catalog
    from conftest import SF_SMALL

    kept, made, real = [], [], build.checkpointed
    monkeypatch.setattr(build, "checkpointed", lambda df: (kept.append(df.columns), real(df))[1])
    monkeypatch.setattr(enrich, "class_school_bridge", lambda a, f=enrich.class_school_bridge: (made.append(1), f(a))[1])
    assert catalog.QUERIES["mart_stream_refresh"](spark, SF_SMALL).count() > 0
    assert kept.count(["class_id", "school_id"]) == 1 and made
