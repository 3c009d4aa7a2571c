"""Positions, dense ranks and neighbours over ranges against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from cohort_effects.operators import quality as Q
from cohort_effects.operators.effects import rank_in_group
from cohort_effects.operators.ranges import dense_ranks, in_ranges, positions, with_previous
from cohort_effects.operators.report import study_shortlist


@pytest.fixture(scope="module")
def rows():
    """(id, group, value): one group with most rows, ties, nulls, a null group."""
    rng = random.Random(4)
    out = []
    for k in range(1500):
        g = "hot" if k % 3 else rng.choice(["a", "b", None, "é"])
        v = None if k % 17 == 0 else 0.0 if k % 5 == 0 else round(rng.gauss(0, 0.4), 3)
        out.append((k, g, v))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "id int, g string, v double").repartition(5).cache()


def by_group(rows):
    out = {}
    for r in rows:
        out.setdefault(r[1], []).append(r)
    return out


def test_positions(table, rows):
    order = [F.col("v").asc_nulls_first(), F.col("id").asc()]
    got = {r.id: (r.position, r.position_of) for r in positions(table, ["g"], order, ranges=9).collect()}
    want = {}
    for members in by_group(rows).values():
        members = sorted(members, key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
        want |= {r[0]: (k, len(members)) for k, r in enumerate(members)}
    assert got == want
    whole = positions(table, [], order, "place", ranges=4).collect()
    assert sorted(r.place for r in whole) == list(range(len(rows)))


def test_a_hot_group_spreads_over_ranges(table):
    spread = in_ranges(table, [F.col("g").asc_nulls_first(), F.col("id").asc()], 8)
    hot = {r._range: r["count"] for r in spread.where("g = 'hot'").groupBy("_range").count().collect()}
    assert len(hot) >= 5 and max(hot.values()) < 400


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("step", [1e-3, 0.25, 100.0])
def test_dense_ranks(table, rows, descending, step):
    got = {r.id: r.place for r in dense_ranks(table, ["g"], "v", "place", descending, step).collect()}
    want = {}
    for members in by_group(rows).values():
        values = sorted({r[2] for r in members if r[2] is not None}, reverse=descending)
        want |= {r[0]: len(values) + 1 if r[2] is None else values.index(r[2]) + 1 for r in members}
    assert got == want


def test_rank_has_no_window_over_a_whole_group_of_rows(spark, table):
    """The one window keyed by the group alone runs over the slots' counts."""
    ranked = rank_in_group(table.withColumn("adj_effect", F.col("v")), ["g"], "adj_effect", "place", 9)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and all("_slot" in w or "_n#" in w for w in windows)
    assert not [w for w in windows if "dense_rank" in w]


def test_previous_across_ranges(table, rows):
    order = [F.col("id").asc()]
    got = {r.id: (r.before, r.v_before) for r in with_previous(table, ["g"], order, {"before": "id", "v_before": "v"}, ranges=11).collect()}
    want = {}
    for members in by_group(rows).values():
        members = sorted(members)
        want |= {b[0]: (a[0], a[2]) if a else (None, None) for a, b in zip([None, *members], members, strict=False)}
    assert got == want


@pytest.mark.parametrize("ranges", [1, 2, 5, 40])
def test_a_drop_on_a_boundary_is_found(spark, ranges, monkeypatch):
    """Every row of one group drops, so every boundary between ranges is one."""
    monkeypatch.setattr(Q, "with_previous", lambda *a: with_previous(*a, ranges=ranges))
    df = spark.range(60).select(F.lit("s").alias("subject"), F.lit(1).alias("year"), "id", (-F.col("id").cast("double")).alias("w"))
    bad = Q.monotone(df.repartition(3), ["subject", "year"], ["id"], "w", 1e-6)
    assert sorted((r.id, r.w, r.prev_value) for r in bad.collect()) == [(k, -float(k), -float(k - 1)) for k in range(1, 60)]
    steady = df.withColumn("w", F.col("id") * 1.0)
    assert Q.monotone(steady, ["subject", "year"], ["id"], "w").count() == 0


def test_shortlist_priority(spark):
    rng = random.Random(1)
    cols = "subject string, year int, school_id int, weight double, rank_in_subject int, effect_class string, confidence string"
    from cohort_effects.params import Params

    p = Params()
    rows = [("m", 2000 + k % 2, k, rng.choice([0.2, 0.5]), k % 7, rng.choice(p.effect_labels), rng.choice(p.confidence_labels)) for k in range(200)]
    got = study_shortlist(spark.createDataFrame(rows, cols)).collect()
    want = {}
    for r in sorted((r for r in rows if r[5] in (p.effect_labels[0], p.effect_labels[4]) and r[6] == p.confidence_labels[0]), key=lambda r: (r[1], -r[3], r[4], r[2])):
        want[r[2]] = sum(1 for w in want if w % 2 == r[2] % 2) + 1
    assert {r.school_id: r.priority for r in got} == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id int, g string, v double")
    assert positions(none, ["g"], [F.col("id").asc()]).collect() == []
    assert with_previous(none, ["g"], [F.col("id").asc()], {"p": "v"}).collect() == []
    assert dense_ranks(none, ["g"], "v", "place").collect() == []
