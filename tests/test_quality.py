import pytest
from pyspark.sql import types as T

from cohort_effects.operators import quality as Q


def test_null_semantics(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (None, None), (2, "z")], "k bigint, v string")
    assert Q.not_null(df, "k").count() == 2
    assert Q.unique(df, "k").count() == 1  # NULL ids are ignored
    assert Q.unique_combination(df, ["k", "v"]).count() == 2  # NULL == NULL
    assert Q.accepted_values(df, "v", ["a"]).count() == 1  # NULL passes; 'z' fails once
    assert Q.between(df, "k", 1, 1).count() == 1  # only 2 is outside


def test_relationships_and_stats(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k bigint")
    parent = spark.createDataFrame([(1,)], "k bigint")
    assert Q.relationships(child, "k", parent, "k").count() == 1
    vals = spark.createDataFrame([(0.5,), (-0.5,)], "x double")
    assert Q.mean_between(vals, "x", -0.1, 0.1).count() == 0
    assert Q.stdev_between(vals, "x", 0.0, 0.5).count() == 1


def test_contract_rejects_silent_upcast(spark):
    df = spark.createDataFrame([(1,)], "a bigint")
    with pytest.raises(Q.ContractError):
        Q.enforce_contract(df, T.StructType([T.StructField("a", T.StringType())]))
    with pytest.raises(Q.ContractError):
        Q.enforce_contract(df, T.StructType([T.StructField("b", T.LongType())]))
    out = Q.enforce_contract(df, T.StructType([T.StructField("a", T.LongType(), False, {"description": "d"})]))
    assert out.schema["a"].metadata["description"] == "d"


def test_not_null_guard_fails_the_job(spark):
    df = spark.createDataFrame([(1,), (None,)], "a bigint")
    with pytest.raises(Exception):
        Q.assert_not_null(df, ["a"]).collect()
    assert Q.assert_not_null(df.dropna(), ["a"]).count() == 1


def test_masking_and_sentinel(spark):
    df = Q.tag_columns(spark.createDataFrame([("id1", "6-10", 3)], "sid string, age string, d bigint"),
                       {"sid": "direct", "age": "demo"})
    out = Q.mask_sensitive(df, {"direct": "hash", "demo": "drop"}, key=("k1", "v7")).collect()[0]
    assert out.asDict().keys() == {"sid", "d"} and out.sid.startswith("v7:") and len(out.sid) == 67
    with pytest.raises(Q.ContractError):  # no key, no masking by a plain digest
        Q.mask_sensitive(df, {"direct": "hash"})
    spark.conf.set(Q.PSEUDONYM_KEY, "k1")
    try:
        assert Q.mask_sensitive(df, {"direct": "hash"}).first().sid == "v1" + out.sid[2:]
    finally:
        spark.conf.unset(Q.PSEUDONYM_KEY)
    bad = Q.tag_columns(df.select("sid"), {"sid": "projects/PROJECT_ID/x"})
    with pytest.raises(Q.ContractError):
        Q.mask_sensitive(bad, {})


def test_suite_statuses(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 2.0)], "k bigint, x double")
    checks = [
        Q.Check("nn", "not_null", "t", ("k",)),
        Q.Check("uq", "unique", "t", ("k",)),
        Q.Check("bt", "between", "t", ("x",), {"min": 0.0, "max": 1.0}, severity="prod_error"),
    ]
    res = {r.check_name: r for r in Q.run_checks(checks, {"t": df}, "dev").collect()}
    assert res["nn"].status == "pass" and res["uq"].status == "fail" and res["bt"].status == "warn"
    res = {r.check_name: r for r in Q.run_checks(checks, {"t": df}, "prod").collect()}
    assert res["bt"].status == "fail"
    with pytest.raises(Q.ContractError):
        Q.gate(Q.run_checks(checks, {"t": df}))


def test_source_drift(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(1, "x")], "a bigint, c string")
    want = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    issues = {(c, i) for c, i, _ in Q.source_drift(df, want)}
    assert issues == {("a", "type"), ("b", "missing"), ("c", "undeclared")}


def test_pseudonyms_of_two_keys_are_unlinkable(spark):
    import hashlib

    ids = [f"s{k}" for k in range(50)]
    df = Q.tag_columns(spark.createDataFrame([(i,) for i in [*ids, None]], "sid string"), {"sid": "direct"})
    one, two, again = ([r.sid for r in Q.mask_sensitive(df, {"direct": "hash"}, key=k).collect()] for k in (("a", "1"), ("b", "1"), ("a", "1")))
    assert one == again and not set(one) & set(two) - {None} and len(set(one)) == 51 and one[-1] is None
    plain = {hashlib.sha256(i.encode()).hexdigest() for i in ids}
    assert not {x[2:] for x in one if x} & plain


def test_regex_failures(spark):
    df = spark.createDataFrame([("ab1",), ("x",), ("",), (None,)], "v string")
    assert sorted(r.v for r in Q.regex_failures(df, "v", "[0-9]").collect()) == ["", "x"]
    assert [r.v for r in Q.regex_failures(df, "v", "[0-9]", wanted=False).collect()] == ["ab1"]
    tags = spark.createDataFrame([("a", "projects/PROJECT_ID/x"), ("b", ""), ("c", "ok"), ("d", None), ("e", "TAXONOMY_ID")], "c string, tag string")
    assert sorted(r.c for r in Q.tag_failures(tags).collect()) == ["a", "b", "e"]
