from cohort_effects.operators import profile as Pm
from cohort_effects.operators import report as Rm


def test_profile_null_conventions(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "c string")
    a = Pm.column_profile(df, "t").collect()[0]
    assert (a.n_rows, a.pct_null, a.nunique, a.pct_mode) == (4, 0.25, 2, 0.5)
    b = Pm.column_profile(df, "t", nulls_as_value=True).collect()[0]
    assert b.nunique == 3


def test_histogram_puts_max_in_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "x double")
    bins = {r.bin: r.n for r in Pm.histogram(df, "x", 10).collect()}
    assert bins == {1: 1, 6: 1, 10: 1}


def test_grain_and_fk(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3)], "a bigint, b bigint")
    g = Pm.grain_report([("t", df, ["a", "b"])]).collect()[0]
    assert (g.total, g.n_distinct, g.duplicates) == (3, 2, 1)
    parent = spark.createDataFrame([(1,)], "a bigint")
    fk = Pm.fk_match_report([("t", df, "b", "p", parent, "a")]).collect()[0]
    assert fk.n_orphans == 3  # NULL keys never match


def test_crosstab_and_topn(spark):
    df = spark.createDataFrame([("x", "s"), ("x", "i"), ("y", "i")], "k string, c string")
    rows = {r.k: r for r in Rm.crosstab(df, "k", "c", ["y", "x"], ["s", "i"]).collect()}
    assert rows["total"].total == 3 and rows["y"].s == 0 and rows["x"].row_order == 1
    t = spark.createDataFrame([("a", 1, 10), ("a", 1, 5), ("a", 2, 1)], "g string, r bigint, id bigint")
    assert [r.id for r in Rm.top_n_per(t, ["g"], "r", 2, ["id"], ["id"]).collect()] == [5, 10]


def test_box_stats_whiskers(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]], "g string, x double")
    r = Rm.box_stats(df, ["g"], "x", 10.0).collect()[0]
    assert (r.q1, r.median, r.q3) == (2.0, 3.0, 4.0)
    assert r.whisker_high == 4.0 and r.n_outliers == 1 and r.share_above == 0.2


def test_extreme_profiles(spark):
    m = spark.createDataFrame(
        [(1, 2000, "A", 0.4), (1, 2000, "B", -0.2), (2, 2000, "A", 0.1), (2, 2000, "B", 0.1), (3, 2000, "A", 0.5)],
        "school_id bigint, year bigint, subject string, adj_effect double",
    )
    rows = {r.school_id: r.extreme for r in Rm.extreme_profiles(m, "A", "B").collect()}
    assert rows == {1: True, 2: False}  # school 3 lacks subject B


def test_fk_report_scans_each_table_once_and_counts_all(spark, tmp_path):
    child = [(k, k % 7 if k % 5 else None, f"p{k % 3}") for k in range(100)]
    spark.createDataFrame(child, "id int, a int, b string").write.parquet(str(tmp_path / "child"))
    c = spark.read.parquet(str(tmp_path / "child"))
    one = spark.createDataFrame([(k,) for k in (0, 1, 2, 2, None)], "k int")
    two = spark.createDataFrame([("p0",), ("p9",)], "k string")
    none = spark.createDataFrame([], "k int")
    got = Pm.fk_match_report([("c", c, "a", "one", one, "k"), ("c", c, "b", "two", two, "k"), ("c", c, "id", "none", none, "k"), ("none", none, "k", "none", none, "k")])
    rows = {(r.child, r.fk): (r.n_child, r.n_orphans, r.orphan_rate) for r in got.collect()}
    lost = sum(a not in (0, 1, 2) for _, a, _ in child)
    assert rows == {("c", "a"): (100, lost, lost / 100), ("c", "b"): (100, 66, 0.66), ("c", "id"): (100, 100, 1.0), ("none", "k"): (0, 0, None)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "SortMergeJoin" not in plan


def test_file_sample_opens_only_the_chosen_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4000).repartition(40).write.parquet(path)
    df = spark.read.parquet(path)
    got = Pm.sample_files(df, 0.25)
    plan = got._jdf.queryExecution().executedPlan()
    rows = got.select("id", "_metadata.file_path").collect()
    chosen = {r.file_path for r in rows}
    whole = {f: n for f, n in df.groupBy("_metadata.file_path").count().collect()}
    assert 3 <= len(chosen) <= 20 and len(rows) == sum(whole[f] for f in chosen)
    assert rows == Pm.sample_files(df, 0.25).select("id", "_metadata.file_path").collect()
    assert {r.file_path for r in Pm.sample_files(df, 0.25, seed=1).select("_metadata.file_path").distinct().collect()} != chosen
    assert Pm.sample_files(df, 1.0).count() == 4000 and Pm.sample_files(df, 0.0).count() == 0
    scans = got.select("id")
    scans.collect()
    scan = scans._jdf.queryExecution().executedPlan()
    leaf = scan.collectLeaves().head()
    assert leaf.metrics().apply("numFiles").value() == len(chosen)


def test_sample_per_group_is_cut_before_the_shuffle(spark):
    df = spark.range(5000).selectExpr("id", "if(id % 3 = 0, null, id % 2) as g")
    got = Pm.sample_per_group(df, ["g"], "id", 7)
    assert {r.g: r["count"] for r in got.groupBy("g").count().collect()} == {None: 7, 0: 7, 1: 7}
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(got.collect()) == sorted(Pm.sample_per_group(df.repartition(9), ["g"], "id", 7).collect())
