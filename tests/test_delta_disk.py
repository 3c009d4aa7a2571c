"""What a change batch leaves on disk: the state, and nothing else for long."""

import os
import time

from pyspark.sql import functions as F
from test_deltas import cells, sample, signed, whole

from cohort_effects.operators import enrich
from cohort_effects.operators.ranges import written
from cohort_effects.params import Params
from cohort_effects.session import ensure_checkpoint_dir
from cohort_effects.streaming import deltas as D


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size())} if files.size() else set()


def _new_shuffles(spark, before, seconds=20):
    """Shuffle files since ``before``, when those that go have gone."""
    end = time.time() + seconds
    while True:
        left = {f for f in _shuffle_files(spark) - before if f.startswith("shuffle_") and f.endswith(".data")}
        if not left or time.time() > end:
            return left
        time.sleep(0.2)


def _checkpoints(spark):
    return {os.path.join(r, d) for r, ds, _ in os.walk(ensure_checkpoint_dir(spark)) for d in ds if d.startswith("rdd-")}


def _exchanges(df):
    plan = df.select("*")._jdf.queryExecution().executedPlan().toString().splitlines()
    return [line for line in plan if "Exchange" in line and "Broadcast" not in line]


def test_a_written_frame_leaves_no_shuffle_files(spark):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    before = _shuffle_files(spark)
    kept = written(df, "counts")
    assert not _new_shuffles(spark, before)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert kept.agg(F.sum("n")).first()[0] == 1000


def test_changes_are_kept_in_the_state_alone(spark, tmp_path):
    p = Params()
    state = D.State(spark, str(tmp_path / "state"), 4)
    D.apply_changes(state, signed(spark, sample(300, 7)), 0, p)
    before = _checkpoints(spark)
    D.apply_changes(state, signed(spark, sample(300, 8)), 1, p)
    assert _checkpoints(spark) == before


def test_a_few_buckets_at_a_time_give_the_same(spark, tmp_path, monkeypatch):
    p = Params(min_obs_per_student=3)
    first, second = sample(500, 11), sample(200, 12)
    marts = []
    for at_once in (D.AT_ONCE, 1):
        monkeypatch.setattr(D, "AT_ONCE", at_once)
        state, path = D.State(spark, str(tmp_path / f"state{at_once}"), 8), str(tmp_path / f"mart{at_once}")
        for epoch, (plus, minus) in enumerate([(first, []), (second, first[:100])]):
            years = D.apply_changes(state, signed(spark, plus, minus), epoch, p)
            D.refresh(state, path, years, epoch, p)
        marts.append(cells(spark.read.parquet(path)))
        changed = state.of("cells", D.CELL_SCHEMA, 1)
        rounds = list(state.rounds(D._buckets(changed), *state.places("cells")))
        assert len(rounds) == (1 if at_once > 1 else len(D._buckets(changed)))
        assert sum(changed.where(r).count() for r in rounds) == changed.count()
    assert marts[0] == marts[1] == cells(whole(spark, first[100:] + second, p))


def test_winners_turn_over_in_rounds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(D, "AT_ONCE", 1)
    p = Params()
    measures = list(p.subject_map)
    schema = "student_id string, term bigint, class_id bigint, " + ", ".join(f"{m} double" for m in measures)
    row = lambda s, t, c, g: (s, t, c, g, *[None] * (len(measures) - 1))
    state = D.State(spark, str(tmp_path / "state"), 4)
    as_they_are = lambda df: df.select("student_id", "term", "class_id", "sign")
    batches = [
        [row("a", 1, 5, 2.0), row(None, 1, 5, 1.0), row("b", None, 5, 1.0), row("c", 1, None, None)],
        [row("a", 1, 4, 2.0), row(None, 1, 5, 0.5), row("b", None, 6, 1.0), row("c", 1, None, None), row("d", 2, 1, 1.0)],
        [row("a", 1, 4, 3.0), row("b", None, None, 1.0), row("c", 1, 9, 1.0)],
    ]
    want = [
        {("a", 1, 5, 1), (None, 1, 5, 1), ("b", None, 5, 1), ("c", 1, None, 1)},
        {("a", 1, 4, 1), ("a", 1, 5, -1), (None, 1, 5, 1), (None, 1, 5, -1), ("d", 2, 1, 1)},
        {("c", 1, 9, 1), ("c", 1, None, -1)},
    ]
    for epoch, (batch, signs) in enumerate(zip(batches, want, strict=True)):
        for _ in range(2):  # and again, as after a restart
            got, _place = D.score_changes(state, spark.createDataFrame(batch, schema), epoch, as_they_are, p)
            assert sorted(map(repr, {tuple(r) for r in got.collect()})) == sorted(map(repr, signs))


def test_long_rows_stay_where_the_wide_ones_were_dealt(spark):
    p = Params()
    scores = spark.createDataFrame([("a", 10, 1, 1.0, 2.0, None, 4.0), ("a", 20, 1, None, 2.0, None, 4.0), (None, 10, -1, 3.0, None, None, None)],
                                   "student_id string, class_id bigint, sign int, subject_1 double, subject_2 double, subject_3 double, subject_4 double")
    bridge = spark.createDataFrame([(10, 1), (10, 2)], "class_id bigint, school_id bigint")
    years = spark.createDataFrame([(10, 2000), (20, 2001)], "class_id bigint, year bigint")
    ids = ["student_id", "class_id", "sign"]
    subjects = {f"subject_{k}": f"s{k % 2}" for k in range(1, 5)}
    dealt = enrich.attach_context(scores, bridge, years, subjects, ids, deal=["student_id"])
    plain = enrich.attach_context(scores, bridge, years, subjects, ids)
    assert sorted(map(repr, dealt.collect())) == sorted(map(repr, plain.collect())) and dealt.count() == 10
    assert len(_exchanges(D.cells_of(dealt))) == len(_exchanges(dealt))
    assert sorted(map(repr, D.cells_of(dealt).collect())) == sorted(map(repr, D.cells_of(plain).collect()))
    stored = D.cells_of(plain)
    apart = spark.createDataFrame(stored.collect(), stored.schema)
    assert len(_exchanges(D.group_changes(apart, apart, p))) == 2  # by student, then by group
