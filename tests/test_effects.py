"""Edge cases of the effect model on hand-made frames."""

import pytest
from pyspark.sql import functions as F

from cohort_effects.operators import effects as fx
from cohort_effects.operators import enrich, staging
from cohort_effects.operators.dedup import keep_first
from cohort_effects.params import Params

P = Params()


def _moments(spark, rows):
    """rows: (school, subject, year, grade_dm)"""
    dm = spark.createDataFrame(rows, "school_id bigint, subject string, year bigint, grade_dm double").withColumn(
        "multi_school", F.lit(False)
    )
    return fx.group_moments(dm), dm


def test_one_school_gives_null_weight(spark):
    m, _ = _moments(spark, [(1, "s", 2000, 0.5), (1, "s", 2000, -0.1)])
    v = fx.variance_components(m).collect()[0]
    assert v["var_between"] is None and v["n_eff"] is None
    mart = fx.score_effects(m, None, P).collect()[0]
    assert mart["weight"] is None and mart["adj_effect"] is None
    assert mart["effect_class"] == P.effect_labels[4] and mart["confidence"] == P.confidence_labels[1]


def test_single_row_schools_give_null_var_within(spark):
    m, _ = _moments(spark, [(1, "s", 2000, 0.5), (2, "s", 2000, -0.5)])
    v = fx.variance_components(m).collect()[0]
    assert v["var_within"] is None


def test_negative_var_between_clamps_to_positive_zero(spark):
    # large within spread, tiny between spread -> var_between < 0
    rows = [(1, "s", 2000, x) for x in (3.0, -3.0, 2.9, -2.9)] + [(2, "s", 2000, x) for x in (3.0, -3.0, 3.1, -3.0)]
    m, _ = _moments(spark, rows)
    v = fx.variance_components(m).collect()[0]
    assert v["var_between"] < 0
    out = fx.score_effects(m, None, P).orderBy("school_id").collect()
    for r in out:
        assert r["weight"] == 0.0
        assert r["rank_in_subject"] == 1
        assert r["effect_class"] == P.effect_labels[2] and r["confidence"] == P.confidence_labels[1]
    # school 2 has a negative raw effect: 0 * negative must not print as -0.0 after normalising
    from cohort_effects.plans.catalog import normalize

    adj = normalize(fx.score_effects(m, None, P)).orderBy("school_id").collect()[1]["adj_effect"]
    assert str(adj) == "0.0"


def test_components_match_the_detail(spark):
    import random
    import statistics

    rnd = random.Random(7)
    rows = [(s, subj, 2000 + y, rnd.uniform(-2, 2)) for s in range(1, 6) for subj in ("a", "b")
            for y in range(2) for _ in range(rnd.randint(1, 6))]
    m, _ = _moments(spark, rows)
    got = {(r.subject, r.year): r for r in fx.variance_components(m).collect()}
    assert set(got) == {(r[1], r[2]) for r in rows}
    for (subj, year), r in got.items():
        groups = {}
        for s, b, y, v in rows:
            if (b, y) == (subj, year):
                groups.setdefault(s, []).append(v)
        n, k = sum(map(len, groups.values())), len(groups)
        means = {s: sum(v) / len(v) for s, v in groups.items()}
        within = sum((x - means[s]) ** 2 for s, v in groups.items() for x in v) / (n - k)
        n_eff = (n - sum(len(v) ** 2 for v in groups.values()) / n) / (k - 1)
        want = (statistics.variance([x for v in groups.values() for x in v]), within,
                statistics.variance(means.values()) - within / n_eff, n_eff)
        assert all(abs(x - y) < 1e-9 for x, y in zip((r.var_total, r.var_within, r.var_between, r.n_eff), want))


def test_shrink_makes_its_own_components(spark):
    rows = [(s, "a", 2000, float(s * i % 5) - 2) for s in range(1, 5) for i in range(1, 5)]
    m, _ = _moments(spark, rows)
    g = {r.school_id: r for r in fx.shrink(m.drop("m2"), fx.variance_components(m)).collect()}
    w = {r.school_id: r for r in fx.shrink(m).collect()}
    for k in g:
        assert abs(g[k]["weight"] - w[k]["weight"]) < 1e-12


def test_distinct_groups_by_bit_set(spark):
    rows = [("s1", 2000, "a", 1.0), ("s1", 2000, "a", 2.0), ("s2", 2000, "a", 1.0), ("s2", 2000, "b", 3.0), ("s2", 2000, None, 3.0)]
    df = spark.createDataFrame(rows, "student_id string, year int, subject string, grade double")
    for values in ((), ("a", "b")):
        got = fx.demean(df, min_obs=2, min_groups=2, group_values=values)
        assert {r.student_id for r in got.collect()} == {"s2"}


def test_demean_filters_after_stats(spark):
    rows = [
        # student a: 4 obs, 2 subjects -> kept
        ("a", 2000, "x", 1.0, 1), ("a", 2000, "x", 2.0, 1), ("a", 2000, "y", 3.0, 1), ("a", 2000, "y", 6.0, 2),
        # student b: 3 obs -> dropped
        ("b", 2000, "x", 1.0, 1), ("b", 2000, "y", 1.0, 1), ("b", 2000, "y", 1.0, 1),
        # student c: 4 obs in one subject -> dropped
        ("c", 2000, "x", 1.0, 1), ("c", 2000, "x", 2.0, 1), ("c", 2000, "x", 3.0, 1), ("c", 2000, "x", 4.0, 1),
        # null year -> dropped
        ("d", None, "x", 1.0, 1), ("d", None, "y", 1.0, 1), ("d", None, "x", 1.0, 1), ("d", None, "y", 1.0, 1),
    ]
    df = spark.createDataFrame(rows, "student_id string, year bigint, subject string, grade double, school_id bigint")
    out = fx.demean(df, flag_target="school_id").collect()
    assert {r.student_id for r in out} == {"a"}
    assert all(r.student_mean == 3.0 and r.n_obs_student == 4 for r in out)
    assert sum(r.grade_dm for r in out) == 0.0
    assert all(r.multi_school for r in out)  # schools 1 and 2


def test_multi_school_flag_ignores_null_school(spark):
    scores = spark.createDataFrame(
        [("s1", 1, 10, 5.0), ("s1", 2, 11, 6.0), ("s2", 1, 10, 5.0), ("s2", 2, 12, 6.0)],
        "student_id string, term bigint, class_id bigint, subject_1 double",
    )
    bridge = spark.createDataFrame([(10, 1), (11, 2)], "class_id bigint, school_id bigint")
    years = spark.createDataFrame([(10, 2000), (11, 2000), (12, 2000)], "class_id bigint, year bigint")
    out = {(r.student_id, r.term): r.multi_school
           for r in enrich.enrich_scores(scores, bridge, years, {"subject_1": "x"}).collect()}
    assert out[("s1", 1)] and out[("s1", 2)]  # two schools
    assert not out[("s2", 1)] and not out[("s2", 2)]  # one school plus a NULL school


def test_bridge_fans_out_and_class_year_takes_lowest(spark):
    att = spark.createDataFrame([(10, 1), (10, 2), (10, None), (None, 3)], "class_id bigint, school_id bigint")
    assert sorted(tuple(r) for r in enrich.class_school_bridge(att).collect()) == [(10, 1), (10, 2)]
    cls = spark.createDataFrame([(10, 2001), (10, 2000), (11, None)], "class_id bigint, year bigint")
    assert [tuple(r) for r in enrich.class_year(cls).collect()] == [(10, 2000)]


def test_keep_first_nulls_last(spark):
    df = spark.createDataFrame([("a", 1, None, 1.0), ("a", 1, 5, 9.0), ("a", 1, 5, 2.0)], "k string, t bigint, c bigint, v double")
    r = keep_first(df, ["k", "t"], ["c", "v"]).collect()
    assert len(r) == 1 and r[0].c == 5 and r[0].v == 2.0


def test_unpivot_drops_all_null_subject(spark):
    raw = spark.createDataFrame(
        [(bytearray(b"1"), "1", "10", 1.234, None, None, 7.0)],
        "student_key binary, term string, class_id string, subject_1 double, subject_2 double, subject_3 double, subject_4 double",
    )
    s = staging.clean_scores(raw)
    r = s.collect()[0]
    assert r.term == 1 and r.class_id == 10 and r.subject_1 == 1.23
    long = enrich.attach_context(s, spark.createDataFrame([], "class_id bigint, school_id bigint"),
                                 spark.createDataFrame([], "class_id bigint, year bigint"), P.subject_map)
    assert sorted(r.subject for r in long.collect()) == ["subject_1", "subject_4"]


@pytest.mark.parametrize("val,label", [(0.10, 2), (-0.10, 2), (0.30, 0), (-0.30, 4), (0.2, 1), (-0.2, 3)])
def test_classify_edges(spark, val, label):
    df = spark.createDataFrame([(val,)], "adj_effect double")
    assert fx.classify(df, P).collect()[0]["effect_class"] == P.effect_labels[label]


def test_bootstrap_is_repeatable(spark):
    dm = spark.createDataFrame(
        [("s%d" % i, t, "x", 1, 2000, float(i % 3)) for i in range(20) for t in (1, 2)],
        "student_id string, term bigint, subject string, school_id bigint, year bigint, grade_dm double",
    )
    a = fx.bootstrap_se(dm, 10).collect()
    b = fx.bootstrap_se(dm, 10).collect()
    assert a == b and a[0]["n_replicates"] == 10 and a[0]["boot_se"] > 0


def test_null_keys_form_their_own_group(spark):
    scores = spark.createDataFrame(
        [(None, 1, 10, 5.0), (None, 2, 11, 6.0)], "student_id string, term bigint, class_id bigint, subject_1 double"
    )
    bridge = spark.createDataFrame([(10, 1), (11, 2)], "class_id bigint, school_id bigint")
    years = spark.createDataFrame([(10, 2000), (11, 2000)], "class_id bigint, year bigint")
    out = enrich.enrich_scores(scores, bridge, years, {"subject_1": "x"}).collect()
    assert len(out) == 2 and all(r.multi_school is True for r in out)
