"""Brute-force checks for the queries that have no SQL twin."""

import os

import pandas as pd
import pyarrow.parquet as pq

from conftest import SF_SMALL


def test_bootstrap_matches_pandas(spark):
    from cohort_effects.operators.effects import bootstrap_se, replicate_weights
    from cohort_effects.plans.catalog import layers

    dm = layers(spark, SF_SMALL).demeaned
    w = replicate_weights(dm, 8).toPandas()
    w["_wx"] = w["_wt"] * w["grade_dm"]
    per = w.groupby(["school_id", "subject", "year", "_b"])[["_wx", "_wt"]].sum()
    per["m"] = per["_wx"] / per["_wt"].where(per["_wt"] != 0)
    want = per.groupby(level=[0, 1, 2])["m"].std(ddof=1)
    got = bootstrap_se(dm, 8).toPandas().set_index(["school_id", "subject", "year"])["boot_se"]
    both = pd.concat([want.rename("a"), got.rename("b")], axis=1)
    assert len(both) == len(got) == len(want)
    diff = (both["a"] - both["b"]).abs()
    assert ((diff < 1e-9) | (both["a"].isna() & both["b"].isna())).all()
    # Poisson(1) weights: mean ~ 1
    assert abs(w["_wt"].mean() - 1.0) < 0.05


def test_bootstrap_copies_no_detail_row(spark):
    from cohort_effects.operators.effects import bootstrap_effects, bootstrap_se
    from cohort_effects.plans.catalog import layers

    dm = layers(spark, SF_SMALL).demeaned
    alone = spark.createDataFrame(dm.limit(50).collect(), dm.schema)  # without the unpivot of the layers
    assert "Generate" not in bootstrap_se(alone, 5)._jdf.queryExecution().optimizedPlan().toString()
    plan = bootstrap_effects(alone, 5)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = [k for k, line in enumerate(plan) if "Generate inline" in line]
    assert at and all(any("Aggregate" in line for line in plan[k:k + 4]) for k in at)  # over the groups' sums


def test_bootstrap_by_student_matches_pandas(spark):
    """Every replicate through the moments, the components and the shrinkage."""
    import numpy as np

    from cohort_effects.operators.effects import bootstrap_effects, weight_array
    from cohort_effects.plans.catalog import layers

    B = 6
    dm = layers(spark, SF_SMALL).demeaned
    rows = dm.withColumn("_wts", weight_array(["student_id"], B, 42)).toPandas().dropna(subset=["school_id"])
    by = ["school_id", "subject", "year"]
    drawn = {}
    for b in range(B):
        part = rows.assign(w=rows["_wts"].str[b])
        part = part.assign(wx=part.w * part.grade_dm, wxx=part.w * part.grade_dm**2)
        g = part.groupby(by)[["w", "wx", "wxx"]].sum()
        g = g[g.w > 0].assign(mean=lambda x: x.wx / x.w, m2=lambda x: (x.wxx - x.wx**2 / x.w).clip(lower=0))
        for key, s in g.groupby(level=[1, 2]):
            n, k, N = s.w, len(s), s.w.sum()
            with np.errstate(all="ignore"):
                within = s.m2.sum() / (N - k) if N != k else np.nan
                n_eff = (N - (n**2).sum() / N) / (k - 1) if k > 1 else np.nan
                between = s["mean"].var(ddof=1) - (within / n_eff if n_eff else np.nan)
                vb = max(0.0, between) if between == between else np.nan
                denom = vb + within / n
                weight = vb / denom.where(denom != 0)
            for idx, a in (weight * s["mean"]).items():
                drawn.setdefault(idx, []).append(a)
    got = bootstrap_effects(dm, B).toPandas().set_index(by)
    assert len(got) == len(drawn)
    for idx, a in drawn.items():
        r = got.loc[idx]
        a = np.array(a, float)
        assert r.n_replicates == len(a)
        a = a[~np.isnan(a)]
        if len(a) > 1:
            assert abs(r.boot_se - a.std(ddof=1)) < 1e-6
            assert np.allclose([r.boot_low, r.boot_high], np.quantile(a, [0.025, 0.975]), atol=1e-6)


def test_schema_catalog_matches_parquet(spark):
    from __spark_entry__ import queries

    got = queries()["schema_catalog"](spark, SF_SMALL).toPandas()
    for t, g in got.groupby("table_name"):
        names = pq.read_schema(f"{SF_SMALL}/{t}.parquet").names
        assert list(g.sort_values("ordinal_position")["column_name"]) == names


def test_table_volumes_match_files(spark):
    from __spark_entry__ import queries

    got = queries()["table_volumes"](spark, SF_SMALL).toPandas().set_index("table_name")
    for t, r in got.iterrows():
        path = f"{SF_SMALL}/{t}.parquet"
        assert r["bytes"] == os.path.getsize(path)
        assert r["n_rows"] == pq.ParquetFile(path).metadata.num_rows


def test_sample_fraction_rate_and_determinism(spark):
    from __spark_entry__ import queries

    a = queries()["sample_fraction"](spark, SF_SMALL)
    b = queries()["sample_fraction"](spark, SF_SMALL)
    n_all = pq.ParquetFile(f"{SF_SMALL}/lineitem.parquet").metadata.num_rows
    n = a.count()
    assert 0.07 * n_all < n < 0.13 * n_all
    assert a.exceptAll(b).count() == 0
