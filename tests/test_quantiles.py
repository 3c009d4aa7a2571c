"""Exact and sketched quantiles against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohort_effects.operators import quantiles as QN
from cohort_effects.operators.profile import counts_by_value, numeric_summary
from cohort_effects.operators.ranges import running
from cohort_effects.operators.report import box_stats, describe_by

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for k in range(3000):
        g = "hot" if k % 2 else rng.choice(["a", None, "c"])
        v = None if k % 31 == 0 else 1.5 if k % 3 == 0 else round(rng.gauss(0, 2), 2)
        out.append((g, 1990 + k % 9, v))
    return [*out, ("one", 2000, 7.0), ("none", 2000, None)]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "g string, year int, v double").repartition(4).cache()


def groups(rows):
    out = {}
    for g, _, v in rows:
        if v is not None:
            out.setdefault(g, []).append(v)
    return out


def test_exact(table, rows):
    got = {r.g: r.quantiles for r in QN.exact(counts_by_value(table, "v", ["g"]), ["g"], "v", "n", PROBS).collect()}
    want = {g: np.quantile(v, PROBS) for g, v in groups(rows).items()}
    assert got.keys() == want.keys() and all(np.allclose(got[g], want[g]) for g in want)
    disc = {r.g: r.quantiles for r in QN.exact(counts_by_value(table, "v", ["g"]), ["g"], "v", "n", PROBS, linear=False).collect()}
    want = {g: np.quantile(v, PROBS, method="inverted_cdf") for g, v in groups(rows).items()}
    assert all(np.allclose(disc[g], want[g]) for g in want)


def test_running_sums(table, rows):
    counts = counts_by_value(table, "v", ["g"])
    got = {(r.g, r.v): (r.upto, r.upto_of) for r in running(counts, ["g"], [F.col("v").asc()], "n", "upto", ranges=7).collect()}
    for g, values in groups(rows).items():
        for v in set(values):
            assert got[g, v] == (sum(x < v for x in values), len(values))


def test_merged_sketches_stay_in_their_bound(table, rows):
    kept = QN.sketch(table, ["g", "year"], "v")
    merged = {r.g: r.quantiles for r in QN.sketch_quantiles(kept.where("g <> 'none' or g is null"), ["g"], PROBS).collect()}
    for g, values in groups(rows).items():
        for p, q in zip(PROBS, merged[g], strict=True):
            assert np.mean(np.array(values) < q) <= p + QN.RANK_BOUND and np.mean(np.array(values) <= q) >= p - QN.RANK_BOUND


def test_reports(table, rows):
    got = {r.g: r for r in describe_by(table, ["g"], "v").collect()}
    for g, values in groups(rows).items():
        assert [got[g].q25, got[g].q50, got[g].q75] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]), abs=6e-4)
        assert got[g]["count"] == len(values)
    assert got["none"]["count"] == 0 and got["none"].q50 is None
    box = {r.g: r for r in box_stats(table, ["g"], "v").collect()}
    assert box.keys() == groups(rows).keys()
    values = [v for vs in groups(rows).values() for v in vs]
    one = numeric_summary(table, "v").first()
    assert [one.p01, one.p50, one.p99] == list(np.quantile(values, [0.01, 0.5, 0.99], method="inverted_cdf")) and one.n == len(values)
    near = numeric_summary(table, "v", sketch=10000).first()
    assert near.p50 == one.p50


def test_no_values(spark):
    none = spark.createDataFrame([], "g string, v double")
    assert QN.exact(counts_by_value(none, "v", ["g"]), ["g"], "v", "n", PROBS).collect() == []
    assert numeric_summary(none, "v").first().p50 is None
