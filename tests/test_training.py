"""Training: loss falls, partition-count independence, optimizers, model table round trip."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.plans import kernels as K
from tessera.plans.training import Optimizer, TrainConfig, cnn_config, mlp_config, one_step_params, train_network
from tessera.session import shared_path
from tessera.sources.model_store import load_model, save_model

from .conftest import SF_MID


def _emb(spark):
    return spark.read.parquet(f"{SF_MID}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), "label", F.col("embedding").alias("data")
    )


def test_loss_falls_sync_full_batch(spark):
    layers = [K.dense(64, 32, "relu"), K.dense(32, 10, "softmax")]
    cfg = mlp_config(epochs=15, learning_rate=0.5, batch_size=None, mode="sync")
    res = train_network(_emb(spark), layers, cfg, (64,), 10, init_scheme="small")
    losses = [l for _, s, l, _ in res.curves if s == "train"]
    assert losses[-1] < losses[0]


def test_loss_falls_replicas_cnn(spark):
    layers = [K.conv(2, 1, 3), K.act("relu"), K.pool(2), K.flatten(), K.dense(18, 10, "softmax")]
    cfg = cnn_config(epochs=3, optimizer="adam", learning_rate=0.01, batch_size=32, mode="replicas", replicas=4)
    res = train_network(_emb(spark), layers, cfg, (8, 8, 1), 10)
    losses = [l for _, s, l, _ in res.curves if s == "train"]
    assert losses[-1] < losses[0]


def test_gradient_step_independent_of_partitions(spark):
    layers = [K.dense(64, 16, "relu"), K.dense(16, 10, "softmax")]
    params = K.init_params(layers, 5)
    cfg = cnn_config(optimizer="sgd", learning_rate=0.01, lam=0.01)
    e = _emb(spark)
    a = K.pack(one_step_params(e.repartition(1), layers, params, cfg, (64,), 10, steps=2))
    b = K.pack(one_step_params(e.repartition(7), layers, params, cfg, (64,), 10, steps=2))
    assert np.allclose(a, b, atol=1e-12)


def _replay(rows, batches, layers, params, cfg, n_copies):
    """Plain NumPy: copies take the batches in turn, one epoch, then the average by rows."""
    from tessera.plans.training import weight_mask

    thetas = [K.pack(params) for _ in range(n_copies)]
    opts = [Optimizer(cfg, thetas[0].size, weight_mask(params)) for _ in range(n_copies)]
    seen = [0] * n_copies
    for b in range(max(batches.values()) + 1):
        r = b % n_copies
        own = [x for x in rows if batches[x.id] == b]
        x = np.array([q.data for q in own], dtype=np.float32).astype(float)
        g, _, _ = K.batch_gradients(x, np.array([q.label for q in own]), layers, K.unpack(thetas[r], params), 10, "add")
        thetas[r] = opts[r].step(thetas[r], g, len(own))
        seen[r] += len(own)
    return sum(n / sum(seen) * t for n, t in zip(seen, thetas))


@pytest.mark.parametrize("n_copies", [1, 3])
def test_replicas_follow_the_seeded_order_whatever_the_partitions(spark, n_copies):
    from tessera.operators.splits import assign_batches

    layers = [K.dense(64, 10, "softmax")]
    params = K.init_params(layers, 9)
    cfg = mlp_config(epochs=1, learning_rate=0.1, lam=0.01, batch_size=50, mode="replicas", replicas=n_copies, seed=4)
    e = _emb(spark)
    rows = e.collect()
    batches = {r.id: r.batch for r in assign_batches(e, "id", 4, 0, 50).select("id", "batch").collect()}
    expected = _replay(rows, batches, layers, params, cfg, n_copies)
    for parts in (1, 4, 9):
        got = train_network(e.repartition(parts), layers, cfg, (64,), 10, params=params, evaluate_every=0)
        assert np.allclose(K.pack(got.params), expected, atol=1e-10)


@pytest.mark.parametrize("optimizer", ["sgd", "momentum", "adam"])
@pytest.mark.parametrize("mode,replicas", [("sync", 1), ("replicas", 3)])
def test_steps_in_runs_equal_a_job_a_step(spark, monkeypatch, optimizer, mode, replicas):
    from tessera.plans import training

    layers = [K.conv(2, 1, 3), K.act("relu"), K.pool(2), K.flatten(), K.dense(18, 10, "softmax")]
    params = K.init_params(layers, 3)
    cfg = cnn_config(epochs=2, optimizer=optimizer, learning_rate=0.001, batch_size=30, mode=mode, replicas=replicas, seed=8)
    e = _emb(spark).repartition(5)

    def run(**limits):
        for name, value in limits.items():
            monkeypatch.setattr(training, name, value)
        return train_network(e, layers, cfg, (8, 8, 1), 10, params=params, evaluate_every=0)

    by_job = run(STEP_BYTES=0)
    for run_bytes in (3 * 30 * 544, 64 << 20):  # three batches, or all batches of a copy in a run
        got = run(STEP_BYTES=4 << 20, RUN_BYTES=run_bytes, STEP_ROWS=16)
        assert np.allclose(K.pack(got.params), K.pack(by_job.params), atol=1e-10) and got.steps == by_job.steps
        assert got.optimizer_state["t"] == by_job.optimizer_state["t"]
        for name in ("m", "v"):
            assert np.allclose(got.optimizer_state[name], by_job.optimizer_state[name], atol=1e-10)


@pytest.mark.parametrize("mode", ["sync", "replicas"])
def test_the_driver_receives_no_gradient_of_a_small_step(spark, monkeypatch, mode):
    from tessera.plans import training

    calls = []
    monkeypatch.setattr(training, "_sum_partials", lambda *a: calls.append("step"))
    runs = training.run_steps
    monkeypatch.setattr(training, "run_steps", lambda *a, **kw: (calls.append("run"), runs(*a, **kw))[1])
    cfg = cnn_config(epochs=2, learning_rate=0.001, batch_size=10, mode=mode, replicas=4)
    res = train_network(_emb(spark), [K.dense(64, 10, "softmax")], cfg, (64,), 10, evaluate_every=0)
    assert calls == ["run"] * 2 and res.steps >= 10  # one job an epoch, whatever the number of steps


def test_driver_receives_a_bounded_number_of_vectors(spark):
    from tessera.plans import training

    rows = spark.range(5000).select(
        (F.col("id") % 2).cast("int").alias("replica"), (F.col("id") / 2).cast("bigint").alias("part"), F.lit(1).cast("bigint").alias("n"),
        F.lit(0.5).alias("loss"), F.lit(1).cast("bigint").alias("correct"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("grad"))
    got = training._sum_partials(rows, 2, 2500)
    assert got[0][0].tolist() == [float(sum(range(0, 5000, 2))), 2500.0] and got[1][1:] == (2500, 1250.0, 2500)


def test_optimizer_formulas():
    cfg = TrainConfig(optimizer="adam", learning_rate=0.1)
    opt = Optimizer(cfg, 2, np.array([1.0, 0.0]))
    th = opt.step(np.array([1.0, 1.0]), np.array([0.5, -0.5]), 1)
    assert np.allclose(th, [0.9, 1.1], atol=1e-6)  # first Adam step moves by lr·sign(g)
    mom = Optimizer(TrainConfig(optimizer="momentum", learning_rate=0.1, gamma=0.9), 1, np.ones(1))
    t1 = mom.step(np.array([0.0]), np.array([1.0]), 1)
    t2 = mom.step(t1, np.array([1.0]), 1)
    assert np.allclose([t1[0], t2[0]], [-0.1, -0.1 - 0.19])


def test_config_validation():
    with pytest.raises(ValueError):
        TrainConfig(optimizer="rmsprop")
    with pytest.raises(ValueError):
        TrainConfig(learning_rate=0)


def test_model_roundtrip_and_structure_check(spark):
    layers = [K.conv(2, 1, 3), K.act("relu"), K.pool(2), K.flatten(), K.dense(18, 10, "softmax")]
    params = K.init_params(layers, 3)
    path = shared_path(spark, "test-models", "m1")
    save_model(spark, path, layers, params)
    lys, prm = load_model(spark, path, expect_layers=layers)
    assert [ly["type"] for ly in lys] == [ly["type"] for ly in layers]
    assert np.allclose(K.pack(prm), K.pack(params))
    with pytest.raises(ValueError):
        load_model(spark, path, expect_layers=layers[:-1])
    with pytest.raises(ValueError):
        load_model(spark, path, expect_layers=[K.dense(1, 1)] + layers[1:])


def test_tree_reduction_matches_driver_sum(spark, monkeypatch):
    from tessera.plans import training

    layers = [K.dense(64, 10, "softmax")]
    params = K.init_params(layers, 2)
    cfg = cnn_config(optimizer="sgd", learning_rate=0.01)
    e = _emb(spark).repartition(9)
    a = K.pack(one_step_params(e, layers, params, cfg, (64,), 10))
    monkeypatch.setattr(training, "FAN_IN", 2)  # several levels on executors
    b = K.pack(one_step_params(e, layers, params, cfg, (64,), 10))
    assert np.allclose(a, b, atol=1e-12)


def test_checkpoint_and_resume(spark):
    layers = [K.dense(64, 10, "softmax")]
    cfg2 = cnn_config(epochs=2, optimizer="adam", learning_rate=0.01, batch_size=None, mode="sync")
    cfg3 = cnn_config(epochs=3, optimizer="adam", learning_rate=0.01, batch_size=None, mode="sync")
    e = _emb(spark)
    path = shared_path(spark, "test-ckpt", "adam")
    full = train_network(e, layers, cfg3, (64,), 10)
    train_network(e, layers, cfg2, (64,), 10, checkpoint_path=path)
    resumed = train_network(e, layers, cfg3, (64,), 10, checkpoint_path=path, resume=True)
    assert resumed.steps == 1
    assert np.allclose(K.pack(full.params), K.pack(resumed.params), atol=1e-12)
