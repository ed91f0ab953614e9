"""Split, fold and batch invariants."""

from pyspark.sql import functions as F

from tessera.operators import splits

from .conftest import SF_MID


def _emb(spark):
    return spark.read.parquet(f"{SF_MID}/embeddings.parquet").select("vec_id", "label")


def test_stratified_split_quota_and_repeatable(spark):
    e = _emb(spark)
    a = splits.stratified_split(e, "label", "vec_id", 0.2, 42)
    b = splits.stratified_split(e, "label", "vec_id", 0.2, 42)
    ra = {(r.vec_id, r.set) for r in a.collect()}
    assert ra == {(r.vec_id, r.set) for r in b.collect()}
    n_test = sum(1 for _, s in ra if s == "test")
    assert n_test == 100  # ceil(0.2 · 500)
    per = a.groupBy("label").agg(F.sum((F.col("set") == "test").cast("int")).alias("t"), F.count("*").alias("n")).collect()
    for r in per:
        assert abs(r.t - 0.2 * r.n) < 1.0


def test_seed_changes_membership(spark):
    e = _emb(spark)
    a = {r.vec_id for r in splits.stratified_split(e, "label", "vec_id", 0.2, 1).where("set = 'test'").collect()}
    b = {r.vec_id for r in splits.stratified_split(e, "label", "vec_id", 0.2, 2).where("set = 'test'").collect()}
    assert a != b


def test_three_way_disjoint_sizes(spark):
    e = _emb(spark)
    s = splits.three_way_split(e, "label", "vec_id", 0.2, 0.2, 7)
    counts = {r.set: r["count"] for r in s.groupBy("set").count().collect()}
    assert sum(counts.values()) == 500
    assert counts["test"] == 100 and counts["val"] == 100  # 60/20/20
    assert s.select("vec_id").distinct().count() == 500


def test_kfold_balanced(spark):
    e = _emb(spark)
    f = splits.kfold(e, "label", "vec_id", 5, 42)
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert sorted(sizes) == [100] * 5
    per = f.groupBy("label", "fold").count().groupBy("label").agg((F.max("count") - F.min("count")).alias("d")).collect()
    assert all(r.d <= 1 for r in per)


def test_batches_cover_once(spark):
    e = _emb(spark)
    b = splits.assign_batches(e, "vec_id", 3, 0, 32)
    sizes = sorted(r["count"] for r in b.groupBy("batch").count().collect())
    assert sum(sizes) == 500 and sizes[0] == 500 % 32 and sizes[-1] == 32


def test_hash_split_no_shuffle(spark):
    e = _emb(spark)
    s = splits.hash_split(e, "vec_id", 0.2, 0.2, 42)
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert 0.1 < s.where("set = 'test'").count() / 500 < 0.3


def test_kfold_without_shuffle_follows_id_order(spark):
    e = _emb(spark)
    f = splits.kfold(e, "label", "vec_id", 4, shuffle=False).collect()
    by_label = {}
    for r in sorted(f, key=lambda r: r.vec_id):
        by_label.setdefault(r.label, []).append(r.fold)
    offset = 0
    for lab in sorted(by_label):
        folds = by_label[lab]
        assert folds == [(offset + i) % 4 for i in range(len(folds))]
        offset += len(folds)


def test_random_seed_split_is_valid(spark):
    e = _emb(spark)
    s = splits.stratified_split(e, "label", "vec_id", 0.2, seed=None)
    assert s.where("set = 'test'").count() == 100


def test_hot_class_split_quota(spark):
    """One class holds 60% of the rows: per-class quotas and exact sizes still hold."""
    e = _emb(spark).withColumn("label", F.when(F.col("vec_id") % 5 < 3, F.lit(99)).otherwise(F.col("label")))
    s = splits.stratified_split(e, "label", "vec_id", 0.25, 3)
    per = {r.label: (r.t, r.n) for r in s.groupBy("label").agg(
        F.sum((F.col("set") == "test").cast("int")).alias("t"), F.count("*").alias("n")).collect()}
    assert sum(t for t, _ in per.values()) == 125
    assert all(abs(t - 0.25 * n) < 1 for t, n in per.values())


def test_null_labels_keep_their_rows(spark):
    e = _emb(spark).withColumn("label", F.when(F.col("vec_id") % 7 == 0, None).otherwise(F.col("label")))
    s = splits.three_way_split(e, "label", "vec_id", 0.2, 0.2, 5)
    assert s.count() == 500
    nulls = s.where(F.col("label").isNull())
    assert nulls.count() == e.where(F.col("label").isNull()).count() and nulls.where("set = 'test'").count() > 0
    f = splits.kfold(e, "label", "vec_id", 4, 5)
    assert f.count() == 500


def test_keyed_order_is_a_permutation_without_a_shuffle(spark):
    from pyspark.sql import functions as F

    from tessera.operators import splits

    seen = []
    for n in (1, 2, 3, 5, 16, 17, 1000, 4099):
        a, b = splits.feistel_sides(n)
        assert n <= a * b < n + a
        at = spark.range(n).withColumnRenamed("id", "at")
        for epoch in (0, 1):
            out = at.select("at", splits.keyed_order("at", n, 5, epoch).alias("pos"))
            assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
            order = [r["pos"] for r in out.orderBy("at").collect()]
            assert sorted(order) == list(range(n))
            seen.append((n, tuple(order)))
    big = [o for n, o in seen if n == 4099]
    assert big[0] != big[1] and sum(x == i for i, x in enumerate(big[0])) < 30
    moved = sum(abs(x - y) for x, y in zip(big[0], big[0][1:])) / 4098
    assert 0.25 * 4099 < moved < 0.42 * 4099  # neighbours are a third of the length apart, as at random
    batches = spark.range(100).select(splits.keyed_batches("id", 100, 1, 0, 32).alias("b")).groupBy("b").agg(F.count("*").alias("n")).collect()
    assert {r["b"]: r["n"] for r in batches} == {0: 32, 1: 32, 2: 32, 3: 4}
