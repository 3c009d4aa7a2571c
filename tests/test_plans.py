"""Plan shape: the properties the design relies on at scale."""

from pyspark.sql import functions as F

from cohort_effects.plans.catalog import layers
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_is_reduced_before_the_shuffle(spark):
    L = layers(spark, SF_SMALL)
    s = _plan(L.scores)
    assert "WindowGroupLimit" in s and "Partial" in s


def test_mart_plan_is_hash_aggregated_and_single_pass(spark):
    L = layers(spark, SF_SMALL)
    L.mart.collect()
    s = _plan(L.mart)
    assert "SortAggregate" not in s
    assert "CartesianProduct" not in s and "BroadcastNestedLoopJoin" not in s


def test_scan_prunes_columns_and_partitions(spark, tmp_path):
    from cohort_effects.sources import io

    L = layers(spark, SF_SMALL)
    path = str(tmp_path / "mart")
    io.write_partitioned(L.mart, path, ["year"])
    df = io.read_partition(spark, path, {"year": 1998}).select("school_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "ReadSchema: struct<school_id:bigint>" in plan


def test_student_stats_are_partial_aggregates_not_windows(spark):
    L = layers(spark, SF_SMALL)
    L.demeaned.collect()
    s = _plan(L.demeaned)
    assert "partial_avg(grade" in s and "partial_count(1)" in s
    assert "Window [avg(grade" not in s


def test_scored_rows_have_constant_aggregate_state_and_no_window(spark):
    from cohort_effects.operators import effects as fx

    L = layers(spark, SF_SMALL)
    scored = fx.shrink(L.moments)
    scored.collect()
    final = scored._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ObjectHashAggregate" not in final and "collect_set" not in final
    assert "Window [avg(" not in final and "Window [sum(" not in final and "Window [var_samp(" not in final
    ranks = L.mart._jdf.queryExecution().optimizedPlan().toString()
    assert "dense_rank(" not in ranks and "_slot" in ranks


def test_no_forced_broadcast_on_caller_chosen_keys(spark):
    from cohort_effects.operators import effects as fx
    from cohort_effects.operators import profile as Pm

    L = layers(spark, SF_SMALL)
    for df in (fx.shrink(L.effects, L.variances), Pm.histogram(L.enriched, "grade", 10, ["subject"])):
        assert "strategy=broadcast" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_scans_are_not_dealt_by_a_key(spark, tmp_path):
    """A constant first column must not gather a table in one task."""
    from cohort_effects.sources import read_table

    spark.range(8000).selectExpr("2000 as year", "id").repartition(4).write.parquet(f"{tmp_path}/roster.parquet")
    df = read_table(spark, str(tmp_path), "roster")
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 4 or df.rdd.getNumPartitions() == len(sizes) > 0
    assert max(sizes) <= 8000 // max(1, df.rdd.getNumPartitions()) * 2
