"""The tabular fit/transform job against a pandas computation of the same rules."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import prep
from tessera.plans.tabular import TabularOptions, TabularPrep


def _frame():
    rng = np.random.default_rng(4)
    n = 400
    x = rng.normal(50, 10, n)
    x[rng.choice(n, 12, replace=False)] = 400.0  # outliers
    z = rng.integers(0, 6, n).astype(float)  # zeros are invalid here
    y = rng.normal(0, 1, n)
    y[rng.choice(n, 30, replace=False)] = np.nan
    cat = rng.choice(["b", "a", "c"], n).astype(object)
    cat[rng.choice(n, 25, replace=False)] = None
    prio = rng.choice(["1-HIGH", "2-MID", "3-LOW"], n)
    target = rng.integers(0, 2, n)
    return pd.DataFrame({"rid": np.arange(n), "x": x, "z": z, "y": y, "cat": cat, "prio": prio, "target": target})


def _expected(pdf, o: TabularOptions, target="target"):
    df = pdf.copy()
    num = ["x", "z", "y"] + ([] if o.protect_target else [target])
    if o.numeric_nulls == "drop":
        df = df.dropna(subset=num)
    else:
        for c in num:
            if df[c].isna().any():
                df[c] = df[c].fillna(df[c].mean() if o.numeric_nulls == "mean" else df[c].median())
    for c in o.invalid_zeros:
        df[c] = df[c].replace(0, df.loc[df[c] != 0, c].median())
    if o.outliers != "keep":
        for c in num:
            q1, q3 = df[c].quantile(0.25), df[c].quantile(0.75)
            lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
            centre = df[c].mean() if o.outliers == "mean" else df[c].median()
            df[c] = np.where((df[c] < lo) | (df[c] > hi), centre, df[c])
    for c in ["x", "z", "y"]:
        if o.scaling == "standardisation":
            sd = df[c].std(ddof=0)
            df[c] = (df[c] - df[c].mean()) / (sd if sd else 1.0)
        else:
            rng_ = df[c].max() - df[c].min()
            df[c] = (df[c] - df[c].min()) / (rng_ if rng_ else 1.0)
    if o.categorical_nulls == "drop":
        df = df.dropna(subset=["cat"])
    else:
        vc = df["cat"].value_counts()
        best = sorted(vc.items(), key=lambda kv: (-kv[1], kv[0]) if o.categorical_nulls == "most" else (kv[1], kv[0]))[0][0]
        df["cat"] = df["cat"].fillna(best)
    df["prio"] = df["prio"].map({v: float(i) for i, v in enumerate(sorted(df["prio"].unique()))})
    for v in sorted(df["cat"].unique()):
        df[f"cat_{v}"] = (df["cat"] == v).astype(float)
    return df.drop(columns=["cat"]).set_index("rid").sort_index()


@pytest.mark.parametrize(
    "opts",
    [
        TabularOptions(outliers="median", scaling="standardisation", numeric_nulls="mean", categorical_nulls="most",
                       ordinal=["prio"], invalid_zeros=["z"], protect_target=True),
        TabularOptions(outliers="mean", scaling="normalisation", numeric_nulls="drop", categorical_nulls="drop",
                       ordinal=["prio"], invalid_zeros=["z"], protect_target=True),
        TabularOptions(outliers="keep", scaling="standardisation", numeric_nulls="median", categorical_nulls="less",
                       ordinal=["prio"], protect_target=True),
    ],
)
def test_tabular_job_matches_pandas(spark, opts):
    pdf = _frame()
    df = spark.createDataFrame(pdf.astype({"cat": object}))
    out = TabularPrep(opts, key_columns=["rid"]).fit_transform(df, target="target").toPandas().set_index("rid").sort_index()
    exp = _expected(pdf, opts)
    assert sorted(out.columns) == sorted(exp.columns)
    for c in exp.columns:
        assert np.allclose(out[c].astype(float), exp[c].astype(float), atol=1e-9), c


def test_numeric_target_is_not_scaled(spark):
    pdf = _frame()
    df = spark.createDataFrame(pdf.astype({"cat": object}))
    out = TabularPrep(TabularOptions(ordinal=["prio"]), key_columns=["rid"]).fit_transform(df, target="target")
    got = out.select("target").toPandas()["target"]
    assert set(got.unique()) <= {0, 1, 0.0, 1.0}


def test_options_are_validated():
    with pytest.raises(ValueError):
        TabularOptions(outliers="clip")
    with pytest.raises(ValueError):
        TabularOptions(numeric_nulls="zero")


@pytest.mark.parametrize("n", [2, 65, 70_000])
def test_unseen_values_are_null_at_every_size(spark, n):
    levels = [f"v{i:06d}" for i in range(n)]
    df = spark.createDataFrame([("v000001",), ("unseen",), (None,)], "c string")
    assert [r.k for r in prep.label_encode(df, "c", out="k", levels=levels).select("c", "k").orderBy(F.col("c").desc()).collect()] == [1, None, None]


def test_code_tables_equal_level_lists(spark):
    df = spark.range(500).select((F.col("id") % 90).cast("string").alias("c"))
    by_table = prep.label_encode(df, "c", out="k", levels=prep.level_codes(df, "c"))
    by_list = prep.label_encode(df, "c", out="k", levels=prep.fit_levels(df, "c"))
    assert sorted(by_table.collect()) == sorted(by_list.collect())


def test_wide_one_hot_and_sparse_one_hot(spark):
    df = spark.range(1001).select("id", F.format_string("%05d", "id").alias("c"))
    wide = prep.onehot_encode(df, ["c"])
    assert len(wide.columns) == 1002
    assert {(r.id, r.c["index"], r.c["value"]) for r in prep.onehot_sparse(df, ["c"]).collect()} == {(i, i, 1.0) for i in range(1001)}


def test_nulls_that_first_come_at_transform_are_filled(spark):
    rows = [(i, float(i % 5), i % 3, "ab"[i % 2], "t") for i in range(30)]
    fit = spark.createDataFrame(rows, "rid int, x double, k int, c string, target string")
    prepared = TabularPrep(TabularOptions(numeric_nulls="median", ordinal=["c"]), key_columns=["rid"]).fit(fit, "target")
    new = spark.createDataFrame([(99, None, None, None, "t"), (98, float("nan"), 1, "a", "t")], fit.schema)
    got = prepared.transform(new).collect()
    assert all(v is not None for r in got for v in r)


def test_fit_leaves_a_callers_cache_alone(spark):
    df = spark.createDataFrame([(i, float(i), "ab"[i % 2]) for i in range(20)], "rid int, x double, target string").cache()
    df.count()
    TabularPrep(key_columns=["rid"]).fit(df, "target")
    assert df.is_cached and df.storageLevel.useMemory
    df.unpersist()


def test_three_scan_statistics_equal_step_by_step(spark, monkeypatch):
    """Fills, zero medians and fences from the raw order statistics are those of fitting each step."""
    import itertools
    import math
    import random

    from tessera.operators import prep, stats
    from tessera.plans.profile import fit_numeric

    rng = random.Random(4)
    rows = [tuple(rng.choice([None, 0.0, 0.0, 1.0, float(rng.randint(-3, 30)), rng.gauss(0, 1) * 10**k]) for k in range(4)) + (None,) for _ in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(4).cache()
    cols, treated = df.columns, ["a", "b", "c", "e"]
    scans, scan = [], stats._scan
    monkeypatch.setattr(stats, "_scan", lambda *a: scans.append(1) or scan(*a))
    every = list(itertools.product(("mean", "median", "none"), ([], ["a"], ["a", "c", "d", "e"]), ("keep", "mean", "median")))
    for fill, zeros, outliers in every[1::4]:
        scans.clear()
        got = fit_numeric(df, cols, treated, fill, zeros, outliers)[:3]
        assert len(scans) <= 3
        cur, fills = df, {}
        if fill != "none":
            fills = prep.fit_numeric_fill(cur, treated, fill)
            cur = prep.apply_fill(cur, fills)
        medians = prep.fit_zero_medians(cur, zeros)
        fences = prep.fit_outliers(prep.apply_zero_replace(cur, medians), treated, outliers)
        for a, b in zip(got[:2], (fills, medians)):
            assert a.keys() == b.keys()
            assert all(a[k] == b[k] or math.isclose(a[k], b[k], rel_tol=1e-12) for k in a)
        assert got[2].keys() == fences.keys()
        assert all(math.isclose(got[2][c][k], fences[c][k], rel_tol=1e-12, abs_tol=1e-12) for c in fences for k in fences[c])


def test_any_number_of_onehot_levels(spark):
    from pyspark.sql import functions as F

    from tessera.plans.tabular import TabularOptions, TabularPrep

    n = 100_001
    df = spark.range(n).select((F.col("id") % 7).cast("double").alias("x"), F.concat(F.lit("v"), "id").alias("wide"), F.concat(F.lit("y"), F.col("id") % 3).alias("y"))
    out = TabularPrep(TabularOptions()).fit_transform(df, "y")
    assert dict(out.dtypes)["wide"] == "struct<index:bigint,value:double>"
    told = out.agg(F.count("*"), F.count_distinct("wide.index"), F.min("wide.index"), F.max("wide.index"), F.sum("wide.value")).first()
    assert tuple(told) == (n, n, 0, n - 1, float(n))
