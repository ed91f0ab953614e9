"""Exact quantiles, frequency extremes and the distributed row number."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.ranking import exact_row_number
from tessera.operators.stats import exact_quantiles, frequency_extremes


def _frame(spark, n=5000, seed=0):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "id": np.arange(n),
        "x": rng.normal(size=n),
        "t": rng.integers(0, 7, size=n).astype(float),  # heavy ties
        "g": np.where(rng.random(n) < 0.4, 0, rng.integers(1, 5, size=n)),  # one hot group
    })
    return pdf, spark.createDataFrame(pdf).repartition(6)


def test_exact_quantiles_match_pandas(spark):
    pdf, df = _frame(spark)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = exact_quantiles(df, ["x", "t"], probs)
    for c in ("x", "t"):
        exp = pdf[c].quantile(probs).tolist()
        assert np.allclose(got[c], exp, rtol=0, atol=1e-12), c


def test_exact_quantiles_narrowing_path(spark):
    pdf, df = _frame(spark, n=20000, seed=3)
    got = exact_quantiles(df, ["x"], [0.25, 0.5, 0.75], bins=3)
    assert np.allclose(got["x"], pdf["x"].quantile([0.25, 0.5, 0.75]).tolist(), atol=1e-12)


def test_exact_quantiles_of_extreme_values(spark):
    vals = [float("-inf"), -1.7e308, -1.0, 0.0, 5e-324, 1e-300, 1.0, 1.0, 1.7e308, float("inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    probs = [i / 9 for i in range(10)]
    assert exact_quantiles(df, ["v"], probs, bins=2)["v"] == sorted(vals[:10])
    assert exact_quantiles(df.where("v IS NULL"), ["v"], [0.5])["v"] == [None]


def test_quantiles_ignore_nulls_and_filter(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0, 1, 2, 3, 10]] + [(None,)], "v double")
    got = exact_quantiles(df, ["v"], [0.5], where={"v": F.col("v") != 0})
    assert got["v"] == [2.5]


def test_frequency_extremes_ties_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "s string")
    assert frequency_extremes(df, ["s"], "most") == {"s": "a"}
    assert frequency_extremes(df, ["s"], "less") == {"s": "c"}


def test_exact_row_number_equals_window(spark):
    _, df = _frame(spark, n=3000)
    ours = exact_row_number(df, ["x", "id"], ["g"], out="rn", num_partitions=7)
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("x", "id")))
    a = {(r.id, r.rn) for r in ours.select("id", "rn").collect()}
    b = {(r.id, r.rn) for r in ref.select("id", "rn").collect()}
    assert a == b


def test_exact_row_number_global_and_partition_independent(spark):
    _, df = _frame(spark, n=2000)
    r1 = {(r.id, r.rn) for r in exact_row_number(df, ["t", "id"], num_partitions=1).select("id", "rn").collect()}
    r5 = {(r.id, r.rn) for r in exact_row_number(df, ["t", "id"], num_partitions=5).select("id", "rn").collect()}
    assert r1 == r5
    assert sorted(rn for _, rn in r1) == list(range(1, 2001))


def test_label_encode_tiers_agree(spark, monkeypatch):
    from pyspark.sql import Window

    from tessera.operators import prep

    c = spark.read.parquet("/root/testdata/sf0.01/customer.parquet").select("c_custkey", "c_name")
    ref = c.withColumn("code", (F.dense_rank().over(Window.orderBy("c_name")) - 1).cast("bigint"))
    want = {(r.c_custkey, r.code) for r in ref.collect()}
    levels = prep.fit_levels(c, "c_name")
    assert len(levels) > prep.MAX_INLINE_LEVELS  # broadcast-table tier
    got = {(r.c_custkey, r.code) for r in prep.label_encode(c, "c_name", out="code", levels=levels).collect()}
    assert got == want
    monkeypatch.setattr(prep, "MAX_LITERAL_LEVELS", 100)  # force the distributed-rank tier
    got_rank = {(r.c_custkey, r.code) for r in prep.label_encode(c, "c_name", out="code").collect()}
    assert got_rank == want


def test_align_requires_unique_key(spark):
    import pytest

    from tessera.operators import prep

    a = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, x double")
    b = spark.createDataFrame([(1, "a")], "k int, s string")
    with pytest.raises(ValueError):
        prep.align_columns(a, b, "k")


def test_approx_quantiles_within_rank_error(spark):
    from tessera.operators.stats import quantiles

    pdf, df = _frame(spark, n=20000, seed=5)
    got = quantiles(df, ["x"], [0.25, 0.5, 0.75], approx=True, accuracy=1000)["x"]
    ranks = [(pdf["x"] < v).mean() for v in got]
    assert all(abs(r - p) <= 1 / 1000 + 1e-9 for r, p in zip(ranks, [0.25, 0.5, 0.75]))


def test_numeric_row_number_equals_window(spark, monkeypatch):
    from tessera.operators import ranking

    _, df = _frame(spark, n=3000)
    monkeypatch.setattr(ranking, "TARGET_BUCKET_ROWS", 50)  # many buckets even on small data
    ours = ranking.numeric_row_number(df, "x", ["g"], out="rn", tie_breaker="id")
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("x", "id")))
    assert {(r.id, r.rn) for r in ours.select("id", "rn").collect()} == {(r.id, r.rn) for r in ref.select("id", "rn").collect()}
    ties = ranking.numeric_row_number(df, "t", out="rn", tie_breaker="id")  # heavy ties in the key
    ref2 = df.withColumn("rn", F.row_number().over(Window.orderBy("t", "id")))
    assert {(r.id, r.rn) for r in ties.select("id", "rn").collect()} == {(r.id, r.rn) for r in ref2.select("id", "rn").collect()}


def test_nan_is_missing_like_pandas(spark):
    from tessera.operators.stats import exact_quantiles, moments

    vals = [1.0, 2.0, float("nan"), 4.0, None, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    s = pd.Series(vals, dtype=float)
    assert np.isclose(moments(df, ["v"])["v"]["mean"], s.mean())
    assert np.allclose(exact_quantiles(df, ["v"], [0.25, 0.5])["v"], s.quantile([0.25, 0.5]).tolist())


def _count_scans(monkeypatch):
    from tessera.operators import stats

    scans, scan = [], stats._scan
    monkeypatch.setattr(stats, "_scan", lambda *a: scans.append(1) or scan(*a))
    return scans


def test_quantiles_take_three_scans_for_any_distribution(spark, monkeypatch):
    rng = np.random.default_rng(0)
    scans = _count_scans(monkeypatch)
    data = {f"e{e}": 10.0 ** rng.uniform(-e, e, 20_000) * rng.choice([-1, 1], 20_000) for e in (3, 30, 300)}
    data["hot"] = np.where(rng.random(20_000) < 0.5, 7.0, rng.normal(size=20_000))
    data["few"] = rng.integers(0, 3, 20_000).astype(float)
    df = spark.createDataFrame(pd.DataFrame(data)).repartition(8).cache()
    probs = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    for bins, most in ((8192, 3), (20, 6)):
        scans.clear()
        got = exact_quantiles(df, list(data), probs, bins=bins)
        assert len(scans) <= most
        for c, v in data.items():
            assert np.allclose(got[c], np.quantile(v, probs), rtol=1e-12, atol=0), c


def test_a_bracket_that_misses_is_found_out(spark, monkeypatch):
    from tessera.operators import stats

    vals = [float(v) for v in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    profile, wrong_once = stats.profile_columns, [1]

    def wrong(*a, **k):
        found, *rest = profile(*a, **k)
        if wrong_once:
            wrong_once.pop()
            for p in found.values():
                p.grid = p.grid[100:300] + [p.grid[300]] * (len(p.grid) - 200)
        return found, *rest

    monkeypatch.setattr(stats, "profile_columns", wrong)
    assert exact_quantiles(df, ["v"], [0.1, 0.5, 0.95])["v"] == list(np.quantile(vals, [0.1, 0.5, 0.95]))
