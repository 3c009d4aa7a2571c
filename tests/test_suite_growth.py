"""What the check suite rests on at size: key checks by hashes, references and terms
counted."""

import random

from pyspark.sql import functions as F

from cohort_effects.operators import quality as Q


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_checks_by_hash_find_every_repeat(spark, monkeypatch):
    rows = [(None, None), (None, None), (None, "a"), ("a", None), ("a", "b"), ("a", "b"), ("a", "b"), ("c", "d"), ("", "d")]
    df = spark.createDataFrame(rows, "k string, v string").withColumn("x", F.when(F.col("k") == "a", F.lit(-0.0)).otherwise(F.lit(0.0)))
    once = spark.createDataFrame([(i,) for i in range(50)], "i long")
    checks = [Q.Check("uc", "unique_combination", "t", ("k", "v")), Q.Check("uq", "unique", "t", ("k",)), Q.Check("ux", "unique", "t", ("x",)),
              Q.Check("once", "unique", "o", ("i",))]
    want = {"uc": 2, "uq": 1, "ux": 1, "once": 0}
    for few in (Q.FEW, 0):
        monkeypatch.setattr(Q, "FEW", few)
        among = Q.narrowed(checks, {"t": df, "o": once})
        assert among["once"] is None and among["uc"].count() == (7 if few else 9)  # a null is left out of a hash
        assert {r.check_name: r.failures for r in Q.check_counts(checks, {"t": df, "o": once}, by_hash=True).collect()} == want
    assert {r.check_name: r.failures for r in Q.check_counts(checks, {"t": df, "o": once}).collect()} == want


def test_chance_hashes_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(Q, "_hashed", lambda check, table: table.withColumn("_hash", F.lit(1).cast("bigint")))
    df = spark.createDataFrame([(1,), (2,), (2,), (3,)], "i long")
    assert [r.failures for r in Q.check_counts([Q.Check("u", "unique", "t", ("i",))], {"t": df}, by_hash=True).collect()] == [1]


def test_references_are_counted_without_a_join(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,), (4,)], "k bigint")
    for parent in (spark.createDataFrame([(1,), (1,), (None,), (9,)], "p bigint"), spark.createDataFrame([(1,), (9,)], "p int")):
        counted = Q.relationships(child, "k", parent, "p", counted=True)
        assert {(r.k, r.n_records) for r in counted.collect()} == {(2, 2), (4, 1)}
        assert Q.relationships(child, "k", parent, "p").count() == 3
        found = Q.check_counts([Q.Check("r", "relationships", "c", ("k",), {"to": "p", "field": "p"})], {"c": child, "p": parent})
        assert found.first().failures == 3
    same = Q.relationships(child, "k", child, "k", counted=True)
    assert same.count() == 0 and "Join" not in _plan(same)


def test_term_gaps_of_any_terms(spark):
    rng = random.Random(6)
    rows = [(rng.choice([None, "a", "b", "c", "d"]), y, s, rng.choice([None, -1, 0, 1, 1, 2, 3, 62, 63, 64, 10**12])) for y in range(12) for s in "xy" for _ in range(12)]
    rows += [("full", 1, "x", t) for t in range(1, 71)] + [("short", 1, "x", t) for t in (1, 2)] + [("zero", 1, "x", t) for t in (0, 1)]
    df = spark.createDataFrame(rows, "student_id string, year int, subject string, term long")
    seen: dict = {}
    for s, y, b, t in rows:
        if t is not None:
            seen.setdefault((s, y, b), set()).add(t)
    want = {k: (len(v), max(v)) for k, v in seen.items() if len(v) != max(v)}
    got = {(r.student_id, r.year, r.subject): (r.n_terms, r.max_term) for r in Q.term_gaps(df).collect()}
    assert got == want and ("full", 1, "x") not in got and ("zero", 1, "x") in got
    assert [r.term for r in Q.term_gaps(df.withColumn("term", F.col("term").cast("double")), term="term").select(F.lit(1).alias("term")).collect()] == [1] * len(want)
