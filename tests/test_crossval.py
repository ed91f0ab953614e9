"""Cross-validation against a brute-force NumPy replay, full-batch and in mini-batches."""

from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from tessera.operators.splits import fold_batch_count, fold_batches, kfold
from tessera.plans import kernels as K
from tessera.plans import stacked
from tessera.plans.crossval import best_cell, cv_grid_scores, cv_scores
from tessera.plans.training import Optimizer, mlp_config, weight_mask

from .conftest import SF_SMALL


def _emb(spark):
    return spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), "label", F.col("embedding").alias("data")
    )


def _replay(x, y, xv, yv, layers, cfg, epochs):
    params = K.init_params(layers, cfg.seed)
    theta = K.pack(params)
    opt = Optimizer(cfg, theta.size, weight_mask(params))
    for _ in range(epochs):
        g, _, _ = K.batch_gradients(x, y, layers, K.unpack(theta, params), 10, cfg.eps_mode)
        theta = opt.step(theta, g, len(y))
    res = {}
    for name, (a, b) in {"train": (x, y), "val": (xv, yv)}.items():
        p, _ = K.forward(a, layers, K.unpack(theta, params))
        res[name] = (K.ce_terms(p, b, cfg.eps_mode).mean(), (p.argmax(1) == b).mean())
    return res


def test_cv_scores_match_numpy_replay(spark):
    e = _emb(spark)
    layers = [K.dense(64, 16, "relu"), K.dense(16, 10, "softmax")]
    cfg = mlp_config(epochs=3, learning_rate=0.5, lam=0.01, batch_size=None, mode="sync")
    got = {(f, s): (l, a) for f, s, l, a in cv_scores(e, layers, cfg, (64,), 10, k=3, seed=7)}
    rows = kfold(e, "label", "id", 3, 7).collect()
    for f in range(3):
        tr = [r for r in rows if r.fold != f]
        va = [r for r in rows if r.fold == f]
        x = np.array([r.data for r in tr], dtype=np.float32).astype(float)
        xv = np.array([r.data for r in va], dtype=np.float32).astype(float)
        want = _replay(x, np.array([r.label for r in tr]), xv, np.array([r.label for r in va]), layers, cfg, 3)
        for s in ("train", "val"):
            assert np.allclose(got[(f, s)], want[s], atol=1e-9), (f, s)


def test_grid_best_is_first_of_ties(spark):
    rows = cv_grid_scores(_emb(spark), [K.dense(64, 10, "softmax")], mlp_config(epochs=1), (64,), 10,
                          [0.1, 0.5], [0.0, 0.1], k=2, seed=3)
    assert len(rows) == 2 * 2 * 2 * 2  # grid cells × folds × sets
    scores = spark.createDataFrame(
        [(0, 0, 0.5), (1, 0, 0.7), (2, 1, 0.7), (3, 0, 0.2)], "grid_idx int, fold int, accuracy double"
    )
    best = best_cell(scores).first()
    assert (best.grid_idx, best.fold) == (1, 0)
    assert best_cell(scores, by="mean").first().grid_idx == 1


def test_fold_batches_are_exact_and_cover_every_row_once(spark):
    n, k, bs = 503, 5, 32
    rows = spark.range(n).select((F.col("id") % k).alias("fold"), F.floor(F.col("id") / k).alias("place"))
    batch = {e: fold_batches("fold", "place", n, k, 7, e, batch_size=bs) for e in (0, 1)}
    got = rows.select("fold", "place", *[batch[e].alias(f"b{e}") for e in batch]).toPandas()
    last = fold_batch_count(n, k, bs, None) - 1
    for e in batch:
        assert got[f"b{e}"].between(0, last).all()
        for f in range(k):  # without fold f every batch but the last holds exactly 32 rows
            sizes = got[got.fold != f][f"b{e}"].value_counts()
            assert (sizes.drop(last, errors="ignore") == bs).all() and sizes.sum() == n - (got.fold == f).sum()
    assert (got.b0 != got.b1).mean() > 0.5  # another order each epoch
    several = rows.select("fold", fold_batches("fold", "place", n, k, 7, 0, batches=6).alias("b")).toPandas()
    counts = several.groupby(["b", "fold"]).size()
    assert several.b.nunique() == 6 and counts.max() - counts.min() <= 1


def test_fold_batches_move_no_rows(spark):
    rows = spark.range(100).select((F.col("id") % 5).alias("fold"), F.floor(F.col("id") / 5).alias("place"))
    plan = rows.withColumn("b", fold_batches("fold", "place", 100, 5, 1, 0, batch_size=8))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_minibatch_cv_matches_numpy_replay_of_every_model(spark):
    e = _emb(spark)
    n, k = e.count(), 3
    layers = [K.dense(64, 8, "relu"), K.dense(8, 10, "softmax")]
    cfg = mlp_config(epochs=2, batch_size=8, learning_rate=0.3, lam=0.05)
    lrs, lams = [0.3, 0.6], [0.0, 0.05]
    got = {(g, f, s): (l, a) for g, _, _, f, s, l, a in cv_grid_scores(e, layers, cfg, (64,), 10, lrs, lams, k=k, seed=7)}
    folds = kfold(e, "label", "id", k, 7, place="place")
    batch = [fold_batches("fold", "place", n, k, cfg.seed, ep, batch_size=8).alias(f"b{ep}") for ep in range(2)]
    rows = folds.select("*", *batch).toPandas()
    x, y = np.array(rows.data.to_list(), dtype=np.float32).astype(float), rows.label.to_numpy()
    for g, (lr, lam) in enumerate((lr, lam) for lr in lrs for lam in lams):
        for f in range(k):
            params = K.init_params(layers, cfg.seed)
            theta = K.pack(params)
            opt = Optimizer(replace(cfg, learning_rate=lr, lam=lam), theta.size, weight_mask(params))
            for ep in range(2):
                for b in range(rows[f"b{ep}"].max() + 1):
                    at = ((rows.fold != f) & (rows[f"b{ep}"] == b)).to_numpy()
                    if at.any():
                        grad, _, _ = K.batch_gradients(x[at], y[at], layers, K.unpack(theta, params), 10, cfg.eps_mode)
                        theta = opt.step(theta, grad, int(at.sum()))
            p, _ = K.forward(x, layers, K.unpack(theta, params))
            for s, at in (("train", rows.fold != f), ("val", rows.fold == f)):
                want = K.ce_terms(p, y, cfg.eps_mode)[at].mean(), (p.argmax(1) == y)[at].mean()
                assert np.allclose(got[(g, f, s)], want, atol=1e-9), (g, f, s)


def test_jobs_do_not_grow_with_cells_and_groups_agree(spark, monkeypatch):
    e = _emb(spark)
    layers, cfg = [K.dense(64, 10, "softmax")], mlp_config(epochs=1, batches_per_epoch=2)
    sc = spark.sparkContext

    def run(name, lrs):
        sc.setJobGroup(name, name)
        try:
            got = cv_grid_scores(e, layers, cfg, (64,), 10, lrs, [0.0], k=2, seed=3)
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        return got, len(sc.statusTracker().getJobIdsForGroup(name))

    one, jobs_one = run("stack-1", [0.1])
    six, jobs_six = run("stack-6", [0.1, 0.2, 0.3, 0.4, 0.5, 0.6])
    assert jobs_one == jobs_six
    assert np.allclose([r[5:] for r in one], [r[5:] for r in six[: len(one)]], atol=1e-12)
    monkeypatch.setattr(stacked, "STACK_PARAMS", 2 * 2 * 650)  # two cells of two folds at a time
    grouped, _ = run("stack-groups", [0.1, 0.2, 0.3, 0.4, 0.5, 0.6])
    assert [r[:5] for r in grouped] == [r[:5] for r in six]
    assert np.allclose([r[5:] for r in grouped], [r[5:] for r in six], atol=1e-12)
