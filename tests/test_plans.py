"""Physical-plan properties that matter at scale (checked on the executed plan text)."""

from pyspark.sql import functions as F

from tessera.operators import splits
from tessera.operators import tensor as T
from tessera.plans import kernels as K
from tessera.plans.scoring import score
from tessera.plans.tabular import TabularOptions, TabularPrep
from tessera.queries.fixtures import conv_weights, image_cells

from .conftest import SF_MID


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fitted_tabular_transform_is_one_map_stage_with_pruned_scan(spark):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet").select("l_orderkey", "l_quantity", "l_discount", "l_returnflag")
    prep = TabularPrep(TabularOptions(outliers="median", scaling="normalisation", invalid_zeros=["l_discount"]),
                       key_columns=["l_orderkey"]).fit(li, target="l_returnflag")
    out = prep.transform(li.where(F.col("l_quantity") > 10))
    plan = _plan(out)
    assert "Exchange" not in plan and "Join" not in plan
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "l_extendedprice" not in plan  # column pruning reaches the scan


def test_split_has_no_exchange_and_one_broadcast_join(spark):
    e = spark.read.parquet(f"{SF_MID}/embeddings.parquet").select("vec_id", "label")
    plan = _plan(splits.three_way_split(e, "label", "vec_id", 0.2, 0.2, 42))
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan
    assert plan.count("BroadcastHashJoin") == 1


def test_packed_scoring_is_map_only(spark):
    e = spark.read.parquet(f"{SF_MID}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("data"))
    layers = [K.dense(64, 10, "softmax")]
    out = score(e, layers, K.init_params(layers), (64,), keep=["id"])
    plan = _plan(out)
    assert "Exchange" not in plan and "MapInArrow" in plan


def test_cell_conv_broadcasts_parameters(spark):
    w, b = conv_weights()
    wdf, bdf = T.conv_weight_table(spark, w, b)
    out = T.conv2d(image_cells(spark, SF_MID), wdf, bdf, 3, 3, 1, 8, 8, n_params=w.size)
    plan = _plan(out)
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_cell_network_shuffles_once(spark):
    """Clustering packed rows by id before exploding leaves every later per-example operator
    (window sums, pooling, dense sums, softmax window) without an exchange."""
    w, b = conv_weights()
    wdf, bdf = T.conv_weight_table(spark, w, b)
    from tessera.queries.fixtures import dense_weights

    dw, db = dense_weights(18, 10)
    dwdf, dbdf = T.dense_weight_table(spark, dw, db)
    conv = T.conv2d(image_cells(spark, SF_MID), wdf, bdf, 3, 3, 1, 8, 8, n_params=w.size)
    pooled = T.pool(T.activate(conv, "relu"), 2, 2, 6, 6, "avg")
    probs = T.dense(T.flatten(pooled, 3, 2), dwdf, dbdf, "softmax", n_params=dw.size)
    plan = _plan(probs)
    assert plan.count("Exchange hashpartitioning") == 1


def test_reading_one_set_prunes_partitions(spark):
    from tessera.session import shared_path
    from tessera.sources.sinks import read_set, write_sets

    e = spark.read.parquet(f"{SF_MID}/embeddings.parquet").select("vec_id", "label")
    path = shared_path(spark, "test-sets", "emb")
    write_sets(splits.three_way_split(e, "label", "vec_id", 0.2, 0.2, 42), path)
    df = read_set(spark, path, "val")
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(set" in plan and "(set#" in plan
    assert df.count() == 100


def test_three_way_split_shuffles_no_data_rows(spark):
    """The payload meets only broadcast tables; exchanges are of digests in two buckets a class."""
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("label"), F.repeat(F.lit("x"), 50).alias("payload")).cache()
    out = splits.three_way_split(df, "label", "id", 0.2, 0.2, 42)
    assert {r["set"]: r["count"] for r in out.groupBy("set").count().collect()} == {"test": 600, "val": 600, "train": 1800}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "payload" in plan and not [x for x in plan.splitlines() if "Window" in x and "payload" in x]
    physical = out._jdf.queryExecution().executedPlan().toString()
    data = [x for x in physical.splitlines() if "Exchange hashpartitioning" in x]
    assert not any("payload" in x for x in data)
    df.unpersist()
