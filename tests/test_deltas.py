"""The mart kept up by changes equals a full rebuild."""

import random

import pytest
from pyspark.sql import functions as F

from cohort_effects.operators import effects as fx
from cohort_effects.params import Params
from cohort_effects.streaming import deltas as D

LONG = "student_id string, year bigint, school_id bigint, subject string, grade double"


def sample(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        student = rng.choice([None, *[f"s{k}" for k in range(60)]])
        out.append((student, rng.choice([1999, 2000, None]), rng.choice([None, 1, 2, 3, 4]), rng.choice(["a", "b", "c"]), round(rng.uniform(0, 10), 2)))
    return out


def whole(spark, rows, p):
    """The mart of all rows, from the detail."""
    dm = fx.demean(spark.createDataFrame(rows, LONG), min_obs=p.min_obs_per_student, min_groups=p.min_subjects_per_student, flag_target="school_id")
    return fx.score_effects(fx.group_moments(dm), None, p)


def cells(df):
    out = {}
    for r in df.select(*fx.MART_COLUMNS).collect():
        out[r.school_id, r.subject, r.year] = tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in r)
    return out


def signed(spark, plus, minus=()):
    rows = [(*r, 1) for r in plus] + [(*r, -1) for r in minus]
    return spark.createDataFrame(rows, LONG + ", sign int")


def test_additions_corrections_and_deletions_equal_a_rebuild(spark, tmp_path):
    p = Params()
    state, path = D.State(spark, str(tmp_path / "state"), 8), str(tmp_path / "mart")
    rows = sample(900, 1)
    years = D.apply_changes(state, signed(spark, rows), 0, p)
    D.refresh(state, path, years, 0, p)
    assert years == [1999, 2000]
    # corrections of some rows, deletions of others, all rows of two students, and new ones
    rng = random.Random(2)
    wrong = rng.sample(range(len(rows)), 60)
    gone = set(rng.sample(range(len(rows)), 50)) | {k for k, r in enumerate(rows) if r[0] in ("s3", "s4")}
    fixed = [(*rows[k][:2], rng.choice([None, 1, 5]), rows[k][3], round(rng.uniform(0, 10), 2)) for k in wrong]
    fresh = sample(80, 3)
    minus = [rows[k] for k in {*wrong, *gone}]
    kept = [r for k, r in enumerate(rows) if k not in {*wrong, *gone}] + fixed + fresh
    years = D.apply_changes(state, signed(spark, fixed + fresh, minus), 1, p)
    D.refresh(state, path, years, 1, p)
    mart = spark.read.parquet(path)
    assert cells(mart) == cells(whole(spark, kept, p))
    # the same batch again, as after a restart
    assert D.apply_changes(state, signed(spark, fixed + fresh, minus), 1, p) == years
    D.refresh(state, path, years, 1, p)
    assert cells(spark.read.parquet(path)) == cells(whole(spark, kept, p))
    # merged epochs give the same sums
    before = cells(fx.score_effects(D.moments(state, [1999, 2000], 1), None, p))
    D.compact(state, 1)
    assert cells(fx.score_effects(D.moments(state, [1999, 2000], 1), None, p)) == before
    late = sample(40, 4)
    years = D.apply_changes(state, signed(spark, late), 2, p)
    D.refresh(state, path, years, 2, p)
    assert cells(spark.read.parquet(path)) == cells(whole(spark, kept + late, p))


def test_a_batch_reads_only_its_students_buckets(spark, tmp_path):
    p = Params()
    state = D.State(spark, str(tmp_path / "state"), 16)
    D.apply_changes(state, signed(spark, sample(600, 5)), 0, p)
    one = D.cells_of(signed(spark, [("s1", 1999, 1, "a", 5.0)])).withColumn("bucket", state.bucket())
    read = state.read("cells", D.CELL_SCHEMA, 1).where(F.col("bucket").isin(D._buckets(one)))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:200]
    opened = {r[0].split("bucket=")[1].split("/")[0] for r in read.select("_metadata.file_path").distinct().collect()}
    assert opened == {str(b) for b in D._buckets(one)} and len(opened) == 1


def test_all_rows_of_a_year_gone_drops_its_partition(spark, tmp_path):
    p = Params(min_obs_per_student=1, min_subjects_per_student=1)
    state, path = D.State(spark, str(tmp_path / "state"), 4), str(tmp_path / "mart")
    rows = [("s1", 1999, 1, "a", 3.0), ("s1", 1999, 2, "b", 5.0), ("s1", 2000, 1, "a", 4.0)]
    D.refresh(state, path, D.apply_changes(state, signed(spark, rows), 0, p), 0, p)
    years = D.apply_changes(state, signed(spark, [], rows[:2]), 1, p)
    D.refresh(state, path, years, 1, p)
    assert years == [1999] and {r.year for r in spark.read.parquet(path).collect()} == {2000}


@pytest.mark.parametrize("drops", [2, 3])
def test_stream_of_score_files(spark, tmp_path, drops):
    from conftest import SF_SMALL

    from cohort_effects.operators import enrich, staging
    from cohort_effects.plans import fixtures as FX
    from cohort_effects.plans.build import build_layers
    from cohort_effects.plans.catalog import QP
    from cohort_effects.sources.io import read_table

    li = read_table(spark, SF_SMALL, "lineitem")
    att, cls = FX.raw_attendance(li), FX.raw_class(li)
    bridge = enrich.class_school_bridge(staging.clean_attendance(att))
    years = enrich.class_year(staging.clean_classes(cls))
    inbox, path, ckpt = (str(tmp_path / n) for n in ("inbox", "mart", "ckpt"))
    state = D.State(spark, str(tmp_path / "state"), 8)
    raw = FX.raw_score(li)
    deal = F.pmod(F.xxhash64("l_linenumber", "l_orderkey"), F.lit(drops))
    for k in range(drops):  # a (student, term) meets its rows over several drops
        FX.raw_score(li.where(deal == k)).write.mode("append").parquet(inbox)
        D.start_delta_refresh(spark, inbox, raw.schema, bridge, years, state, path, ckpt, QP, compact_every=1).awaitTermination()
    got, want = cells(spark.read.parquet(path)), cells(build_layers(raw, att, cls, None, QP).mart)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-5) for k in want)
