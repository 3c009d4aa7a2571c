"""Anchor counts of the fixture build (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from cohort_effects.plans.build import fixture_layers
from cohort_effects.plans.catalog import QP

ANCHORS = {
    "/root/testdata/sf0.001": dict(scores=3783, attendance=5995, classes=5792, students=1500, bridge=63,
                                   enriched=11136, no_school=1537, no_year=1537, multi=1852, demeaned=2158,
                                   mart=189, variances=21, neg_vb=13),
    "/root/testdata/sf0.01": dict(scores=37902, attendance=59994, classes=59791, students=15000, bridge=665,
                                  enriched=111461, no_school=6274, no_year=4415, multi=23537, demeaned=25566,
                                  mart=1932, variances=21, neg_vb=1),
}


@pytest.mark.parametrize("base", sorted(ANCHORS))
def test_fixture_anchors(spark, base):
    a = ANCHORS[base]
    L = fixture_layers(spark, base, QP)
    assert L.scores.count() == a["scores"]
    assert L.attendance.count() == a["attendance"]
    assert L.classes.count() == a["classes"]
    assert L.students.count() == a["students"]
    assert L.bridge.count() == a["bridge"]
    e = L.enriched.agg(
        F.count(F.lit(1)), F.count_if(F.col("school_id").isNull()), F.count_if(F.col("year").isNull()),
        F.count_if("multi_school"),
    ).collect()[0]
    assert tuple(e) == (a["enriched"], a["no_school"], a["no_year"], a["multi"])
    assert L.demeaned.count() == a["demeaned"]
    assert L.mart.count() == a["mart"]
    v = L.variances.agg(F.count(F.lit(1)), F.count_if(F.col("var_between") < 0)).collect()[0]
    assert tuple(v) == (a["variances"], a["neg_vb"])


def test_sf001_effect_classes(spark):
    L = fixture_layers(spark, "/root/testdata/sf0.01", QP)
    got = {(r.effect_class, r.confidence): r["count"] for r in L.mart.groupBy("effect_class", "confidence").count().collect()}
    sp, mp, ind, mn, sn = QP.effect_labels
    sig, inc = QP.confidence_labels
    assert got == {(sp, inc): 137, (sp, sig): 1, (mp, inc): 291, (ind, inc): 1127, (mn, inc): 274,
                   (sn, inc): 99, (sn, sig): 3}
    s = L.mart.agg(F.avg("adj_effect"), F.min("adj_effect"), F.max("adj_effect")).collect()[0]
    assert round(s[0], 6) == 0.009856 and round(s[1], 6) == -0.994237 and round(s[2], 6) == 1.222157
