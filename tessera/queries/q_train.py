"""Queries for data-parallel training, optimizers, cross-validation, the model table and
streaming scoring.

The SQL oracles repeat the training arithmetic exactly from fixed formula weights: optimizer
steps on a softmax-regression network, full CNN steps, mini-batch MLP and CNN+Adam runs over
the same seeded batches, k-fold CV and grid search, and learning curves. The gradient work runs
in Arrow tasks on Spark, the updates on the driver. ``train_mlp`` (local mini-batch SGD with
weight averaging), ``train_cnn`` (Adam from random weights) have no oracle; pytest covers them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..operators.splits import FEISTEL_ROUNDS, three_way_split
from ..plans import kernels as K
from ..plans.crossval import best_cell, cv_grid_scores, cv_scores
from ..plans.scoring import score
from ..plans.training import cnn_config, curves_frame, mlp_config, one_step_params, train_network
from ..session import shared_path
from ..sources.model_store import load_model, save_model
from ..sources.tables import read_table
from . import register
from .fixtures import IMG_C, IMG_H, IMG_W, dense_bias_sql, dense_weights, dense_weights_sql
from .q_tensor import VEC

LR, LAM, GAMMA, B1, B2, EPS = 0.01, 0.01, 0.9, 0.9, 0.999, 1e-8


def _emb(spark, sf):
    return read_table(spark, sf, "embeddings").select(F.col("vec_id").cast("bigint").alias("id"), "label", F.col("embedding").alias("data"))


def _softreg():
    w, b = dense_weights(64, 10)
    return [K.dense(64, 10, "softmax")], [{"W": w, "b": b}]


def _params_frame(spark, params):
    p = params[0]
    rows = [("W", int(i), int(j), float(p["W"][i, j])) for i in range(p["W"].shape[0]) for j in range(p["W"].shape[1])]
    rows += [("b", -1, int(j), float(v)) for j, v in enumerate(p["b"])]
    df = spark.createDataFrame(rows, "param string, i bigint, j bigint, value double")
    return df.select("param", "i", "j", r6("value").alias("value"))


def _step_sql(opt: str, steps: int, predict: bool = False) -> str:
    """SQL text of ``steps`` full-batch optimizer steps from the formula weights; with
    ``predict`` the text ends with every row's arg-max class under the updated weights."""
    f = lambda v: f"CAST('{v!r}' AS DOUBLE)"
    lr, lam, gm, b1, b2, eps = f(LR), f(LAM), f(GAMMA), f(B1), f(B2), f(EPS)
    ctes = [VEC, f"w0 AS (SELECT i, j, w FROM ({dense_weights_sql(64, 10)}))", f"b0 AS ({dense_bias_sql(10)})",
            "lab AS (SELECT CAST(vec_id AS BIGINT) AS id, label FROM embeddings)",
            "m AS (SELECT CAST(count(*) AS DOUBLE) AS m FROM lab)",
            "sw0 AS (SELECT i, j, 0.0 AS m1, 0.0 AS m2 FROM w0)", "sb0 AS (SELECT j, 0.0 AS m1, 0.0 AS m2 FROM b0)"]
    for k in range(1, steps + 1):
        p = k - 1
        ctes += [
            f"z{k} AS (SELECT id, j, sum(v * w) + b AS z FROM vec JOIN w{p} USING (i) JOIN b{p} USING (j) GROUP BY id, j, b)",
            f"e{k} AS (SELECT id, j, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM z{k})",
            f"d{k} AS (SELECT id, j, e / sum(e) OVER (PARTITION BY id) - CASE WHEN j = label THEN 1.0 ELSE 0.0 END AS g FROM e{k} JOIN lab USING (id))",
            f"gw{k} AS (SELECT i, j, sum(v * g) AS g FROM vec JOIN d{k} USING (id) GROUP BY i, j)",
            f"gb{k} AS (SELECT j, sum(g) AS g FROM d{k} GROUP BY j)",
        ]
        for kind, keys, cur, st in (("w", "i, j", "w", "sw"), ("b", "j", "b", "sb")):
            wt = "w" if kind == "w" else "b"
            gsrc = f"g{kind}{k}"
            if opt == "sgd":
                decay = f" + {lam} * {wt}" if kind == "w" else ""
                ctes.append(f"{kind}{k} AS (SELECT {keys}, {wt} - {lr} * (g{decay}) AS {wt} FROM {kind}{p} JOIN {gsrc} USING ({keys}))")
                ctes.append(f"{st}{k} AS (SELECT {keys}, m1, m2 FROM {st}{p})")
            elif opt == "mlp":
                decay = f" + {lam} * {wt} / m" if kind == "w" else ""
                ctes.append(f"{kind}{k} AS (SELECT {keys}, {wt} - {lr} * (g / m{decay}) AS {wt} FROM {kind}{p} JOIN {gsrc} USING ({keys}), m)")
                ctes.append(f"{st}{k} AS (SELECT {keys}, m1, m2 FROM {st}{p})")
            elif opt == "momentum":
                ctes.append(f"{st}{k} AS (SELECT {keys}, {gm} * m1 + {lr} * g AS m1, m2 FROM {st}{p} JOIN {gsrc} USING ({keys}))")
                ctes.append(f"{kind}{k} AS (SELECT {keys}, {wt} - m1 AS {wt} FROM {kind}{p} JOIN {st}{k} USING ({keys}))")
            else:  # adam
                ctes.append(
                    f"{st}{k} AS (SELECT {keys}, {b1} * m1 + (1 - {b1}) * g AS m1, {b2} * m2 + (1 - {b2}) * g * g AS m2 "
                    f"FROM {st}{p} JOIN {gsrc} USING ({keys}))"
                )
                ctes.append(
                    f"{kind}{k} AS (SELECT {keys}, {wt} - {lr} * (m1 / (1 - pow({b1}, {k}))) / (sqrt(m2 / (1 - pow({b2}, {k}))) + {eps}) AS {wt} "
                    f"FROM {kind}{p} JOIN {st}{k} USING ({keys}))"
                )
    s = steps
    if predict:
        ctes += [
            f"zf AS (SELECT id, j, sum(v * w) + b AS z FROM vec JOIN w{s} USING (i) JOIN b{s} USING (j) GROUP BY id, j, b)",
            "rk AS (SELECT id, j, row_number() OVER (PARTITION BY id ORDER BY z DESC, j) AS r FROM zf)",
        ]
        return ("WITH " + ",\n".join(ctes) + "\nSELECT id, label, CAST(j AS BIGINT) AS predicted FROM rk JOIN lab USING (id) WHERE r = 1")
    return (
        "WITH " + ",\n".join(ctes)
        + f"\nSELECT 'W' AS param, i, j, round(w, 6) + 0.0 AS value FROM w{s}"
        + f"\nUNION ALL SELECT 'b' AS param, CAST(-1 AS BIGINT) AS i, j, round(b, 6) + 0.0 AS value FROM b{s}"
    )


def _step_query(cfg_fn, steps):
    def q(spark, sf):
        layers, params = _softreg()
        new = one_step_params(_emb(spark, sf), layers, params, cfg_fn(), (64,), 10, steps=steps)
        return _params_frame(spark, new)

    return q


register("train_step_sgd", _step_sql("sgd", 1))(_step_query(lambda: cnn_config(optimizer="sgd", learning_rate=LR, lam=LAM), 1))
register("train_step_sgd_two", _step_sql("sgd", 2))(_step_query(lambda: cnn_config(optimizer="sgd", learning_rate=LR, lam=LAM), 2))
register("train_step_momentum", _step_sql("momentum", 2))(
    _step_query(lambda: cnn_config(optimizer="momentum", learning_rate=LR, gamma=GAMMA), 2)
)
register("train_step_adam", _step_sql("adam", 2))(
    _step_query(lambda: cnn_config(optimizer="adam", learning_rate=LR, beta1=B1, beta2=B2, epsilon=EPS), 2)
)
register("train_step_mlp", _step_sql("mlp", 1))(_step_query(lambda: mlp_config(learning_rate=LR, lam=LAM), 1))


# ----------------------------------------------------------------------------- full training runs
def _sets(spark, sf):
    return three_way_split(_emb(spark, sf), "label", "id", 0.2, 0.2, 42)


def _mlp_run(spark, sf, epochs=5):
    s = _sets(spark, sf).coalesce(spark.sparkContext.defaultParallelism).cache()  # AQE does not resize cached plans
    tr = s.where(F.col("set") == "train")
    layers = [K.dense(64, 32, "relu"), K.dense(32, 10, "softmax")]
    cfg = mlp_config(epochs=epochs, learning_rate=0.5, lam=0.01, batch_size=64, mode="replicas", replicas=4)
    # Scored once at the end (below); per-epoch curves are the learning_curves query.
    res = train_network(tr, layers, cfg, (64,), 10, init_scheme="mlp_sequential", evaluate_every=0)
    return s, res


@register("train_mlp")
def q_train_mlp(spark, sf):
    """MLP 64→32→10 (ReLU, softmax), mini-batch SGD of four model copies on
    a seeded order, weights averaged per epoch; final
    loss / accuracy per set (train, val, test) from one scoring pass."""
    s, res = _mlp_run(spark, sf)
    scored = score(s, res.layers, res.params, (64,), keep=["id", "label", "set"])
    from ..operators.metrics import cross_entropy_terms

    return scored.groupBy("set").agg(
        r6(F.avg(cross_entropy_terms("probs", "label", "add"))).alias("loss"),
        r6(F.avg((F.col("predicted") == F.col("label")).cast("double"))).alias("accuracy"),
        F.count(F.lit(1)).alias("n"),
    )


CURVE_EPOCHS, CURVE_LR, CURVE_LAM = 3, 0.5, 0.01


def _curves_sql(epochs: int, lr: float, lam: float) -> str:
    """SQL of full-batch MLP training (softmax output, mean gradient + λW/m) on the training
    set of the stratified 60/20/20 split, scored on train and validation after every epoch."""
    from .q_splits import split_sql

    f = lambda v: f"CAST('{float(v)!r}' AS DOUBLE)"
    ctes = [
        "sets AS (WITH " + split_sql("SELECT vec_id, label FROM embeddings", "vec_id", "label", 0.2, 0.2, 42,
                                     "CAST(vec_id AS BIGINT) AS id, label") + ")",
        VEC,
        f"w0 AS (SELECT i, j, w FROM ({dense_weights_sql(64, 10)}))",
        f"b0 AS ({dense_bias_sql(10)})",
        "tr AS (SELECT id, label FROM sets WHERE set = 'train')",
        "ev AS (SELECT id, label, set FROM sets WHERE set IN ('train', 'val'))",
        "m AS (SELECT CAST(count(*) AS DOUBLE) AS m FROM tr)",
    ]
    outs = []
    for s in range(1, epochs + 1):
        p = s - 1
        ctes += [
            f"z{s} AS (SELECT id, j, sum(v * w) + b AS z FROM tr JOIN vec USING (id) JOIN w{p} USING (i) JOIN b{p} USING (j) GROUP BY id, j, b)",
            f"e{s} AS (SELECT id, j, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM z{s})",
            f"d{s} AS (SELECT id, j, e / sum(e) OVER (PARTITION BY id) - CASE WHEN j = label THEN 1.0 ELSE 0.0 END AS g FROM e{s} JOIN tr USING (id))",
            f"gw{s} AS (SELECT i, j, sum(v * g) AS g FROM d{s} JOIN vec USING (id) GROUP BY i, j)",
            f"gb{s} AS (SELECT j, sum(g) AS g FROM d{s} GROUP BY j)",
            f"w{s} AS (SELECT i, j, w - {f(lr)} * (g / m + {f(lam)} * w / m) AS w FROM w{p} JOIN gw{s} USING (i, j), m)",
            f"b{s} AS (SELECT j, b - {f(lr)} * (g / m) AS b FROM b{p} JOIN gb{s} USING (j), m)",
            f"q{s} AS (SELECT id, j, sum(v * w) + b AS z FROM ev JOIN vec USING (id) JOIN w{s} USING (i) JOIN b{s} USING (j) GROUP BY id, j, b)",
            f"qe{s} AS (SELECT id, j, z, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM q{s})",
            f"qp{s} AS (SELECT id, j, e / sum(e) OVER (PARTITION BY id) AS p, row_number() OVER (PARTITION BY id ORDER BY z DESC, j) AS r FROM qe{s})",
            f"qr{s} AS (SELECT ev.set, max(CASE WHEN j = ev.label THEN -ln(p + 1e-15) END) AS loss, "
            f"max(CASE WHEN r = 1 THEN CAST(j = ev.label AS DOUBLE) END) AS ok FROM qp{s} JOIN ev USING (id) GROUP BY id, ev.set)",
        ]
        outs.append(f"SELECT CAST({p} AS BIGINT) AS epoch, set, round(avg(loss), 6) + 0.0 AS loss, "
                    f"round(avg(ok), 6) + 0.0 AS accuracy FROM qr{s} GROUP BY set")
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(outs)


@register("learning_curves", _curves_sql(CURVE_EPOCHS, CURVE_LR, CURVE_LAM))
def q_learning_curves(spark, sf):
    """Per-epoch loss and accuracy on train and validation (the reference's four curves) for
    full-batch MLP training from fixed weights on the stratified training split."""
    s = _sets(spark, sf).coalesce(spark.sparkContext.defaultParallelism).cache()  # AQE does not resize cached plans
    tr, va = s.where(F.col("set") == "train"), s.where(F.col("set") == "val")
    layers, params = _softreg()
    cfg = mlp_config(epochs=CURVE_EPOCHS, learning_rate=CURVE_LR, lam=CURVE_LAM, batch_size=None, mode="sync")
    res = train_network(tr, layers, cfg, (64,), 10, val_df=va, params=params)
    return curves_frame(spark, res).select("epoch", "set", r6("loss").alias("loss"), r6("accuracy").alias("accuracy"))


def _cnn_layers():
    return [K.conv(4, 1, 3), K.act("relu"), K.pool(2, 2, "avg"), K.flatten(), K.dense(36, 10, "softmax")]


@register("train_cnn")
def q_train_cnn(spark, sf):
    """Small CNN (conv 4@3×3 → ReLU → avg-pool → dense softmax), Adam, synchronous batches of
    128 rows (exact per-epoch shuffle); returns the learning curves."""
    s = _sets(spark, sf).coalesce(spark.sparkContext.defaultParallelism).cache()  # AQE does not resize cached plans
    tr, va = s.where(F.col("set") == "train"), s.where(F.col("set") == "val")
    cfg = cnn_config(epochs=2, optimizer="adam", learning_rate=0.01, batch_size=128, mode="sync")
    res = train_network(tr, _cnn_layers(), cfg, (IMG_H, IMG_W, IMG_C), 10, val_df=va)
    return curves_frame(spark, res)


CV_GRID = [(0.1, 0.0), (0.1, 0.1), (1.0, 0.0), (1.0, 0.1)]  # (lr, λ) in grid order, lr-major
CV_FOLDS, CV_EPOCHS, CV_BATCHES = 5, 2, 5


def _fold_batches_sql(k: int, epochs: int, batches: int, seed: int) -> list[str]:
    """CTEs of the keyed mini-batches: every fold's places permuted by Feistel turns (cells outside
    walk on by recursion), cut into ``batches`` near-equal parts."""

    def digest(i: int, x: str) -> str:
        return f"CAST(('0x' || substr(md5(concat_ws('-', '{seed}', CAST(key AS VARCHAR), '{i}', CAST({x} AS VARCHAR))), 1, 13)) AS BIGINT)"

    def turned(source: str) -> str:
        keep = "id, e, key, a, b, n"
        sql = f"SELECT {keep}, x // b AS r, x % b AS c FROM {source}"
        for i in range(FEISTEL_ROUNDS):
            move = f"(r + {digest(i, 'c')}) % a AS r, c" if i % 2 == 0 else f"r, (c + {digest(i, 'r')}) % b AS c"
            sql = f"SELECT {keep}, {move} FROM ({sql})"
        return f"SELECT {keep}, r * b + c AS x FROM ({sql})"

    return [
        f"fsz AS (SELECT fold, n, a, (n + a - 1) // a AS b FROM (SELECT fold, count(*) AS n, CAST(floor(sqrt(count(*) - 1)) + 1 AS BIGINT) AS a FROM folds GROUP BY fold))",
        f"places AS (SELECT id, e, e * {k} + fold AS key, place AS x, a, b, n FROM folds JOIN fsz USING (fold), "
        f"(SELECT unnest(range({epochs})) AS e))",
        f"walk AS ({turned('places')} UNION ALL {turned('(SELECT * FROM walk WHERE x >= n)')})",
        f"bt AS (SELECT id, e, CAST((x * {batches}) // n AS BIGINT) AS batch FROM walk WHERE x < n)",
    ]


def _cv_sql(grid: list[tuple[float, float]], k: int, epochs: int, batches: int, seed: int = 42) -> str:
    """SQL of k-fold CV for a softmax-regression MLP: ``epochs`` passes of ``batches`` mini-batch MLP
    steps (mean gradient + λW/m) per (grid cell, fold) from the formula weights, then loss
    (−ln(p+ε)) and accuracy on the training folds and on the held-out fold."""
    f = lambda v: f"CAST('{float(v)!r}' AS DOUBLE)"
    values = ", ".join(f"({g}, {f(lr)}, {f(lam)})" for g, (lr, lam) in enumerate(grid))
    ctes = [
        VEC,
        f"w0 AS (SELECT i, j, w FROM ({dense_weights_sql(64, 10)}))",
        f"b0 AS ({dense_bias_sql(10)})",
        "lab AS (SELECT CAST(vec_id AS BIGINT) AS id, label FROM embeddings)",
        "cnt AS (SELECT label, count(*) AS n FROM lab GROUP BY label)",
        "off AS (SELECT label, coalesce(sum(n) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM cnt)",
        f"rk AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('-', '{seed}', CAST(id AS VARCHAR))), id) AS rn FROM lab)",
        f"folds AS (SELECT id, label, CAST((o + rn - 1) % {k} AS BIGINT) AS fold, CAST((o + rn - 1) // {k} AS BIGINT) AS place FROM rk JOIN off USING (label))",
        *_fold_batches_sql(k, epochs, batches, seed),
        f"grid AS (SELECT * FROM (VALUES {values}) g(grid_idx, lr, lam))",
        f"fk AS (SELECT CAST(range AS BIGINT) AS f FROM range({k}))",
        "cell AS (SELECT grid_idx, lr, lam, f FROM grid, fk)",
        "tr AS (SELECT f, id, label, e, batch FROM fk JOIN folds ON folds.fold <> fk.f JOIN bt USING (id))",
        "cw0 AS (SELECT grid_idx, f, i, j, w FROM cell, w0)",
        "cb0 AS (SELECT grid_idx, f, j, b FROM cell, b0)",
    ]
    for s in range(1, epochs * batches + 1):
        p = s - 1
        ctes += [
            f"t{s} AS (SELECT f, id, label FROM tr WHERE e = {p // batches} AND batch = {p % batches})",
            f"m{s} AS (SELECT f, CAST(count(*) AS DOUBLE) AS m FROM t{s} GROUP BY f)",
            f"z{s} AS (SELECT grid_idx, f, id, j, sum(v * w) + b AS z FROM t{s} JOIN vec USING (id) JOIN cw{p} USING (f, i) "
            f"JOIN cb{p} USING (grid_idx, f, j) GROUP BY grid_idx, f, id, j, b)",
            f"e{s} AS (SELECT grid_idx, f, id, j, exp(z - max(z) OVER (PARTITION BY grid_idx, f, id)) AS e FROM z{s})",
            f"d{s} AS (SELECT grid_idx, f, id, j, e / sum(e) OVER (PARTITION BY grid_idx, f, id) - CASE WHEN j = label THEN 1.0 ELSE 0.0 END AS g "
            f"FROM e{s} JOIN lab USING (id))",
            f"gw{s} AS (SELECT grid_idx, f, i, j, sum(v * g) AS g FROM d{s} JOIN vec USING (id) GROUP BY grid_idx, f, i, j)",
            f"gb{s} AS (SELECT grid_idx, f, j, sum(g) AS g FROM d{s} GROUP BY grid_idx, f, j)",
            f"cw{s} AS (SELECT grid_idx, f, i, j, w - lr * (g / m + lam * w / m) AS w FROM cw{p} JOIN gw{s} USING (grid_idx, f, i, j) "
            f"JOIN m{s} USING (f) JOIN grid USING (grid_idx))",
            f"cb{s} AS (SELECT grid_idx, f, j, b - lr * (g / m) AS b FROM cb{p} JOIN gb{s} USING (grid_idx, f, j) "
            f"JOIN m{s} USING (f) JOIN grid USING (grid_idx))",
        ]
    S = epochs * batches
    ctes += [
        f"zf AS (SELECT grid_idx, f, id, j, sum(v * w) + b AS z FROM cell JOIN cw{S} USING (grid_idx, f) JOIN vec USING (i) "
        f"JOIN cb{S} USING (grid_idx, f, j) GROUP BY grid_idx, f, id, j, b)",
        "ef AS (SELECT grid_idx, f, id, j, z, exp(z - max(z) OVER (PARTITION BY grid_idx, f, id)) AS e FROM zf)",
        "pf AS (SELECT grid_idx, f, id, j, e / sum(e) OVER (PARTITION BY grid_idx, f, id) AS p, "
        "row_number() OVER (PARTITION BY grid_idx, f, id ORDER BY z DESC, j) AS r FROM ef)",
        "per AS (SELECT grid_idx, f, id, CASE WHEN folds.fold = f THEN 'val' ELSE 'train' END AS set, "
        "max(CASE WHEN j = folds.label THEN -ln(p + 1e-15) END) AS loss, "
        "max(CASE WHEN r = 1 THEN CAST(j = folds.label AS DOUBLE) END) AS ok FROM pf JOIN folds USING (id) GROUP BY grid_idx, f, id, folds.fold)",
        "scores AS (SELECT grid_idx, f, set, avg(loss) AS loss, avg(ok) AS accuracy FROM per GROUP BY grid_idx, f, set)",
    ]
    return "WITH RECURSIVE " + ",\n".join(ctes)


def _cv_select(with_grid: bool) -> str:
    g = "CAST(grid_idx AS BIGINT) AS grid_idx, lr, lam AS lambda, " if with_grid else ""
    return (f"\nSELECT {g}f AS fold, set, round(loss, 6) + 0.0 AS loss, round(accuracy, 6) + 0.0 AS accuracy "
            "FROM scores JOIN grid USING (grid_idx)" + ("" if with_grid else " WHERE grid_idx = 0"))


def _cv_run(spark, sf, grid):
    layers, params = _softreg()
    cfg = mlp_config(epochs=CV_EPOCHS, batches_per_epoch=CV_BATCHES, mode="sync")
    return cv_grid_scores(_emb(spark, sf), layers, cfg, (64,), 10, sorted({lr for lr, _ in grid}),
                          sorted({lam for _, lam in grid}), k=CV_FOLDS, init=params)


@register("cv_scores", _cv_sql(CV_GRID[:1], CV_FOLDS, CV_EPOCHS, CV_BATCHES) + _cv_select(False))
def q_cv_scores(spark, sf):
    """Stratified 5-fold CV of the reference MLP (softmax output, mean gradient + λW/m, two epochs of
    five mini-batches from fixed weights): train on four folds, score both sides."""
    layers, params = _softreg()
    lr, lam = CV_GRID[0]
    cfg = mlp_config(epochs=CV_EPOCHS, learning_rate=lr, lam=lam, batches_per_epoch=CV_BATCHES, mode="sync")
    rows = cv_scores(_emb(spark, sf), layers, cfg, (64,), 10, k=CV_FOLDS, init=params)
    return spark.createDataFrame([(f, s, r6_py(l), r6_py(a)) for f, s, l, a in rows],
                                 "fold bigint, set string, loss double, accuracy double")


def r6_py(x: float) -> float:
    return round(float(x), 6) + 0.0


@register("cv_grid_scores", _cv_sql(CV_GRID, CV_FOLDS, CV_EPOCHS, CV_BATCHES) + _cv_select(True))
def q_cv_grid_scores(spark, sf):
    """lr × λ grid (2×2) × 5 stratified folds of the MLP, all 20 models in one gradient job a step."""
    rows = _cv_run(spark, sf, CV_GRID)
    return spark.createDataFrame(
        [(g, lr, lam, f, s, r6_py(l), r6_py(a)) for g, lr, lam, f, s, l, a in rows],
        "grid_idx bigint, lr double, lambda double, fold bigint, set string, loss double, accuracy double",
    )


@register(
    "cv_grid_search",
    _cv_sql(CV_GRID, CV_FOLDS, CV_EPOCHS, CV_BATCHES)
    + "\nSELECT CAST(grid_idx AS BIGINT) AS grid_idx, lr, lam AS lambda, f AS fold, round(accuracy, 6) + 0.0 AS accuracy "
    "FROM scores JOIN grid USING (grid_idx) WHERE set = 'val' ORDER BY round(accuracy, 6) DESC, grid_idx, f LIMIT 1",
)
def q_cv_grid_search(spark, sf):
    """Grid search end to end: the grid's validation scores, then the reference's best-cell rule."""
    scores = q_cv_grid_scores(spark, sf).where(F.col("set") == "val")
    return best_cell(scores, by="single").select("grid_idx", "lr", "lambda", "fold", "accuracy")


# ----------------------------------------------------------------------------- model table
@register("model_roundtrip", _step_sql("sgd", 1, predict=True))
def q_model_roundtrip(spark, sf):
    """Train one step, write the model table to the shared folder, read it back with the
    structure check, and score all rows with the loaded model."""
    import uuid

    layers, params = _softreg()
    trained = one_step_params(_emb(spark, sf), layers, params, cnn_config(learning_rate=LR, lam=LAM), (64,), 10)
    path = shared_path(spark, "models", f"roundtrip-{uuid.uuid4().hex}")
    save_model(spark, path, layers, trained)
    lys, prm = load_model(spark, path, expect_layers=layers)
    return score(_emb(spark, sf), lys, prm, (64,), keep=["id", "label"]).select("id", "label", "predicted")


# ----------------------------------------------------------------------------- streaming
@register("stream_score_mlp", _step_sql("sgd", 1, predict=True))
def q_stream_score_mlp(spark, sf):
    """Score the embeddings table as a file stream (available-now trigger) with a model
    trained on it; the same scoring operator as the batch path."""
    import uuid

    from ..streaming.scoring import read_table_stream, run_available, score_stream

    layers, params = _softreg()
    trained = one_step_params(_emb(spark, sf), layers, params, cnn_config(learning_rate=LR, lam=LAM), (64,), 10)
    stream = read_table_stream(spark, sf, "embeddings")
    stream = stream.select(F.col("vec_id").cast("bigint").alias("id"), "label", F.col("embedding").alias("data"))
    name = f"stream_score_{uuid.uuid4().hex[:12]}"
    out = run_available(spark, score_stream(stream, layers, trained, (64,), keep=["id", "label"]), name)
    return out.select("id", "label", "predicted")


# ----------------------------------------------------------------------------- CNN training step
CNN_LR, CNN_LAM, CNN_STEPS = 0.001, 0.01, 2


def _cnn_step_sql(steps: int, lr: float, lam: float) -> str:
    """SQL of full-batch SGD (+L2 on weights) steps of conv 2@3×3 → ReLU → avg-pool 2×2 →
    dense 18→10 → softmax, gradients summed over all rows (the reference CNN's rule)."""
    from .fixtures import CELLS_SQL, conv_bias_sql, conv_weights_sql
    from .q_tensor import _win_sql

    f = lambda v: f"CAST('{float(v)!r}' AS DOUBLE)"
    LR, LM = f(lr), f(lam)
    ctes = [
        f"cells AS ({CELLS_SQL})",
        f"win AS ({_win_sql('cells', 3, 1, 8, 8)})",
        "lab AS (SELECT CAST(vec_id AS BIGINT) AS id, label FROM embeddings)",
        f"cw0 AS ({conv_weights_sql()})",
        f"cb0 AS ({conv_bias_sql()})",
        f"dw0 AS (SELECT i, j, w FROM ({dense_weights_sql(18, 10)}))",
        f"db0 AS ({dense_bias_sql(10)})",
    ]
    for s in range(1, steps + 1):
        p = s - 1
        ctes += [
            # forward
            f"z{s} AS (SELECT id, oy AS y, ox AS x, f, sum(v * w) + b AS z FROM win JOIN cw{p} USING (c, dy, dx) "
            f"JOIN cb{p} USING (f) GROUP BY id, oy, ox, f, b)",
            f"pl{s} AS (SELECT id, py, px, f, sum(greatest(z, 0.0)) / 4.0 AS a FROM "
            f"(SELECT id, y // 2 AS py, x // 2 AS px, f, z FROM z{s} WHERE y < 6 AND x < 6) GROUP BY id, py, px, f)",
            f"fl{s} AS (SELECT id, CAST((py * 3 + px) * 2 + f AS BIGINT) AS i, a FROM pl{s})",
            f"lg{s} AS (SELECT id, j, sum(a * w) + b AS z FROM fl{s} JOIN dw{p} USING (i) JOIN db{p} USING (j) GROUP BY id, j, b)",
            f"ex{s} AS (SELECT id, j, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM lg{s})",
            f"dz{s} AS (SELECT id, j, e / sum(e) OVER (PARTITION BY id) - CASE WHEN j = label THEN 1.0 ELSE 0.0 END AS g "
            f"FROM ex{s} JOIN lab USING (id))",
            # dense backward
            f"gdw{s} AS (SELECT i, j, sum(a * g) AS g FROM fl{s} JOIN dz{s} USING (id) GROUP BY i, j)",
            f"gdb{s} AS (SELECT j, sum(g) AS g FROM dz{s} GROUP BY j)",
            f"dfl{s} AS (SELECT id, i, sum(g * w) AS g FROM dz{s} JOIN dw{p} USING (j) GROUP BY id, i)",
            # pool (stride = size, no overlap) and ReLU backward
            f"dzc{s} AS (SELECT z.id, z.y, z.x, z.f, CASE WHEN z.z > 0 THEN d.g / 4.0 ELSE 0.0 END AS g FROM z{s} z "
            f"JOIN dfl{s} d ON d.id = z.id AND d.i = ((z.y // 2) * 3 + (z.x // 2)) * 2 + z.f WHERE z.y < 6 AND z.x < 6)",
            # conv backward
            f"gcw{s} AS (SELECT f, c, dy, dx, sum(v * g) AS g FROM win JOIN dzc{s} d ON d.id = win.id AND d.y = win.oy AND d.x = win.ox "
            f"GROUP BY f, c, dy, dx)",
            f"gcb{s} AS (SELECT f, sum(g) AS g FROM dzc{s} GROUP BY f)",
            # SGD with L2 on weights
            f"cw{s} AS (SELECT f, c, dy, dx, w - {LR} * (g + {LM} * w) AS w FROM cw{p} JOIN gcw{s} USING (f, c, dy, dx))",
            f"cb{s} AS (SELECT f, b - {LR} * g AS b FROM cb{p} JOIN gcb{s} USING (f))",
            f"dw{s} AS (SELECT i, j, w - {LR} * (g + {LM} * w) AS w FROM dw{p} JOIN gdw{s} USING (i, j))",
            f"db{s} AS (SELECT j, b - {LR} * g AS b FROM db{p} JOIN gdb{s} USING (j))",
        ]
    S = steps
    final = (
        f"SELECT 'conv_W' AS param, CAST(((f * 1 + c) * 3 + dy) * 3 + dx AS BIGINT) AS idx, round(w, 6) + 0.0 AS value FROM cw{S}\n"
        f"UNION ALL SELECT 'conv_b', CAST(f AS BIGINT), round(b, 6) + 0.0 FROM cb{S}\n"
        f"UNION ALL SELECT 'dense_W', CAST(i * 10 + j AS BIGINT), round(w, 6) + 0.0 FROM dw{S}\n"
        f"UNION ALL SELECT 'dense_b', CAST(j AS BIGINT), round(b, 6) + 0.0 FROM db{S}"
    )
    return "WITH " + ",\n".join(ctes) + "\n" + final


@register("train_step_cnn", _cnn_step_sql(CNN_STEPS, CNN_LR, CNN_LAM))
def q_train_step_cnn(spark, sf):
    """Two full-batch SGD steps of the small CNN from fixed weights: the Arrow gradient job
    (conv, ReLU, average-pool and dense backward in NumPy) and the driver update."""
    from .q_tensor import _cnn_net

    layers, params = _cnn_net()
    cfg = cnn_config(optimizer="sgd", learning_rate=CNN_LR, lam=CNN_LAM)
    new = one_step_params(_emb(spark, sf), layers, params, cfg, (IMG_H, IMG_W, IMG_C), 10, steps=CNN_STEPS)
    rows = []
    for name, arr in (("conv_W", new[0]["W"]), ("conv_b", new[0]["b"]), ("dense_W", new[4]["W"]), ("dense_b", new[4]["b"])):
        rows += [(name, int(k), float(v)) for k, v in enumerate(np.ravel(arr))]
    df = spark.createDataFrame(rows, "param string, idx bigint, value double")
    return df.select("param", "idx", r6("value").alias("value"))


# ----------------------------------------------------------------------------- exact mini-batch MLP
MB_HIDDEN, MB_EPOCHS, MB_BATCHES, MB_LR, MB_LAM = 8, 2, 5, 0.5, 0.01


def _mb_net():
    w1, b1 = dense_weights(64, MB_HIDDEN)
    w2, b2 = dense_weights(MB_HIDDEN, 10)
    return [K.dense(64, MB_HIDDEN, "relu"), K.dense(MB_HIDDEN, 10, "softmax")], [{"W": w1, "b": b1}, {"W": w2, "b": b2}]


def _minibatch_sql() -> str:
    """SQL of the reference MLP's mini-batch training on the stratified training split: every
    epoch a fresh md5 order cut into ``MB_BATCHES`` consecutive batches of ceil(n/5) rows; per
    batch a ReLU-hidden / softmax forward, the backward pass, and the mean-gradient + λW/m step."""
    from .q_splits import split_sql

    f = lambda v: f"CAST('{float(v)!r}' AS DOUBLE)"
    LR, LM = f(MB_LR), f(MB_LAM)
    ctes = [
        "sets AS (WITH " + split_sql("SELECT vec_id, label FROM embeddings", "vec_id", "label", 0.2, 0.2, 42,
                                     "CAST(vec_id AS BIGINT) AS id, label") + ")",
        VEC,
        "tr AS (SELECT id, label FROM sets WHERE set = 'train')",
        f"bs AS (SELECT CAST(ceil(count(*) / {MB_BATCHES}.0) AS BIGINT) AS bs FROM tr)",
        f"w1_0 AS (SELECT i, j, w FROM ({dense_weights_sql(64, MB_HIDDEN)}))",
        f"b1_0 AS ({dense_bias_sql(MB_HIDDEN)})",
        f"w2_0 AS (SELECT i, j, w FROM ({dense_weights_sql(MB_HIDDEN, 10)}))",
        f"b2_0 AS ({dense_bias_sql(10)})",
    ]
    for e in range(MB_EPOCHS):
        ctes.append(
            f"ord{e} AS (SELECT id, label, CAST((row_number() OVER (ORDER BY md5(concat_ws('-', '42', '{e}', CAST(id AS VARCHAR))), id) - 1) "
            f"// bs AS BIGINT) AS batch FROM tr, bs)"
        )
    s = 0
    for e in range(MB_EPOCHS):
        for b in range(MB_BATCHES):
            p, s = s, s + 1
            ctes += [
                f"r{s} AS (SELECT id, label FROM ord{e} WHERE batch = {b})",
                f"m{s} AS (SELECT CAST(count(*) AS DOUBLE) AS m FROM r{s})",
                f"z1_{s} AS (SELECT id, j AS h, sum(v * w) + b AS z FROM r{s} JOIN vec USING (id) JOIN w1_{p} USING (i) "
                f"JOIN b1_{p} USING (j) GROUP BY id, j, b)",
                f"z2_{s} AS (SELECT id, w.j, sum(greatest(z, 0.0) * w.w) + bb.b AS z FROM z1_{s} JOIN w2_{p} w ON w.i = z1_{s}.h "
                f"JOIN b2_{p} bb ON bb.j = w.j GROUP BY id, w.j, bb.b)",
                f"e_{s} AS (SELECT id, j, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM z2_{s})",
                f"d2_{s} AS (SELECT id, j, e / sum(e) OVER (PARTITION BY id) - CASE WHEN j = label THEN 1.0 ELSE 0.0 END AS g "
                f"FROM e_{s} JOIN r{s} USING (id))",
                f"gw2_{s} AS (SELECT h AS i, j, sum(greatest(z, 0.0) * g) AS g FROM z1_{s} JOIN d2_{s} USING (id) GROUP BY h, j)",
                f"gb2_{s} AS (SELECT j, sum(g) AS g FROM d2_{s} GROUP BY j)",
                f"d1_{s} AS (SELECT z1.id, z1.h, CASE WHEN z1.z > 0 THEN sum(d.g * w.w) ELSE 0.0 END AS g FROM z1_{s} z1 "
                f"JOIN d2_{s} d ON d.id = z1.id JOIN w2_{p} w ON w.i = z1.h AND w.j = d.j GROUP BY z1.id, z1.h, z1.z)",
                f"gw1_{s} AS (SELECT i, h AS j, sum(v * g) AS g FROM d1_{s} JOIN vec USING (id) GROUP BY i, h)",
                f"gb1_{s} AS (SELECT h AS j, sum(g) AS g FROM d1_{s} GROUP BY h)",
                f"w1_{s} AS (SELECT i, j, w - {LR} * (g / m + {LM} * w / m) AS w FROM w1_{p} JOIN gw1_{s} USING (i, j), m{s})",
                f"b1_{s} AS (SELECT j, b - {LR} * (g / m) AS b FROM b1_{p} JOIN gb1_{s} USING (j), m{s})",
                f"w2_{s} AS (SELECT i, j, w - {LR} * (g / m + {LM} * w / m) AS w FROM w2_{p} JOIN gw2_{s} USING (i, j), m{s})",
                f"b2_{s} AS (SELECT j, b - {LR} * (g / m) AS b FROM b2_{p} JOIN gb2_{s} USING (j), m{s})",
            ]
    final = (
        f"SELECT 'W1' AS param, CAST(i * {MB_HIDDEN} + j AS BIGINT) AS idx, round(w, 6) + 0.0 AS value FROM w1_{s}\n"
        f"UNION ALL SELECT 'b1', CAST(j AS BIGINT), round(b, 6) + 0.0 FROM b1_{s}\n"
        f"UNION ALL SELECT 'W2', CAST(i * 10 + j AS BIGINT), round(w, 6) + 0.0 FROM w2_{s}\n"
        f"UNION ALL SELECT 'b2', CAST(j AS BIGINT), round(b, 6) + 0.0 FROM b2_{s}"
    )
    return "WITH " + ",\n".join(ctes) + "\n" + final


@register("train_mlp_minibatch", _minibatch_sql())
def q_train_mlp_minibatch(spark, sf):
    """The reference MLP's mini-batch SGD, run as synchronous Spark steps: per epoch an exact
    seeded permutation of the training split cut into 5 consecutive batches, one gradient
    job and one update per batch; returns the final weights."""
    s = _sets(spark, sf)
    tr = s.where(F.col("set") == "train")
    layers, params = _mb_net()
    cfg = mlp_config(epochs=MB_EPOCHS, learning_rate=MB_LR, lam=MB_LAM, batches_per_epoch=MB_BATCHES, mode="sync")
    res = train_network(tr, layers, cfg, (64,), 10, params=params, evaluate_every=0)
    rows = []
    for name, arr in (("W1", res.params[0]["W"]), ("b1", res.params[0]["b"]), ("W2", res.params[1]["W"]), ("b2", res.params[1]["b"])):
        rows += [(name, int(k), float(v)) for k, v in enumerate(np.ravel(arr))]
    return spark.createDataFrame(rows, "param string, idx bigint, value double").select("param", "idx", r6("value").alias("value"))


# ----------------------------------------------------------------------------- exact mini-batch CNN with Adam
CNN_MB_EPOCHS, CNN_MB_BATCHES, CNN_MB_LR = 2, 3, 0.01


def _cnn_minibatch_sql() -> str:
    """SQL of mini-batch Adam training of the small CNN on the stratified training split:
    per epoch a fresh md5 order cut into 3 consecutive batches; per batch the summed
    gradients (conv / ReLU / pool / dense backward) and a bias-corrected Adam step."""
    from .fixtures import CELLS_SQL, conv_bias_sql, conv_weights_sql
    from .q_splits import split_sql
    from .q_tensor import _win_sql

    f = lambda v: f"CAST('{float(v)!r}' AS DOUBLE)"
    LR, SB1, SB2, SEPS = f(CNN_MB_LR), f(B1), f(B2), f(EPS)
    ctes = [
        "sets AS (WITH " + split_sql("SELECT vec_id, label FROM embeddings", "vec_id", "label", 0.2, 0.2, 42,
                                     "CAST(vec_id AS BIGINT) AS id, label") + ")",
        "tr AS (SELECT id, label FROM sets WHERE set = 'train')",
        f"bs AS (SELECT CAST(ceil(count(*) / {CNN_MB_BATCHES}.0) AS BIGINT) AS bs FROM tr)",
        f"cells AS ({CELLS_SQL})",
        f"win AS ({_win_sql('cells', 3, 1, 8, 8)})",
        f"cw0 AS ({conv_weights_sql()})",
        f"cb0 AS ({conv_bias_sql()})",
        f"dw0 AS (SELECT i, j, w FROM ({dense_weights_sql(18, 10)}))",
        f"db0 AS ({dense_bias_sql(10)})",
        "scw0 AS (SELECT f, c, dy, dx, 0.0 AS m1, 0.0 AS m2 FROM cw0)",
        "scb0 AS (SELECT f, 0.0 AS m1, 0.0 AS m2 FROM cb0)",
        "sdw0 AS (SELECT i, j, 0.0 AS m1, 0.0 AS m2 FROM dw0)",
        "sdb0 AS (SELECT j, 0.0 AS m1, 0.0 AS m2 FROM db0)",
    ]
    for e in range(CNN_MB_EPOCHS):
        ctes.append(
            f"ord{e} AS (SELECT id, label, CAST((row_number() OVER (ORDER BY md5(concat_ws('-', '42', '{e}', CAST(id AS VARCHAR))), id) - 1) "
            f"// bs AS BIGINT) AS batch FROM tr, bs)"
        )

    def adam(name, keys, prev_w, state, grad, col, t):
        return [
            f"s{name}{t} AS (SELECT {keys}, {SB1} * m1 + (1 - {SB1}) * g AS m1, {SB2} * m2 + (1 - {SB2}) * g * g AS m2 "
            f"FROM s{name}{t - 1} JOIN {grad} USING ({keys}))",
            f"{name}{t} AS (SELECT {keys}, {col} - {LR} * (m1 / (1 - pow({SB1}, {t}))) / (sqrt(m2 / (1 - pow({SB2}, {t}))) + {SEPS}) AS {col} "
            f"FROM {prev_w} JOIN s{name}{t} USING ({keys}))",
        ]

    s = 0
    for e in range(CNN_MB_EPOCHS):
        for b in range(CNN_MB_BATCHES):
            p, s = s, s + 1
            ctes += [
                f"r{s} AS (SELECT id, label FROM ord{e} WHERE batch = {b})",
                f"z{s} AS (SELECT id, oy AS y, ox AS x, f, sum(v * w) + b AS z FROM win JOIN r{s} USING (id) JOIN cw{p} USING (c, dy, dx) "
                f"JOIN cb{p} USING (f) GROUP BY id, oy, ox, f, b)",
                f"pl{s} AS (SELECT id, py, px, f, sum(greatest(z, 0.0)) / 4.0 AS a FROM "
                f"(SELECT id, y // 2 AS py, x // 2 AS px, f, z FROM z{s} WHERE y < 6 AND x < 6) GROUP BY id, py, px, f)",
                f"fl{s} AS (SELECT id, CAST((py * 3 + px) * 2 + f AS BIGINT) AS i, a FROM pl{s})",
                f"lg{s} AS (SELECT id, j, sum(a * w) + b AS z FROM fl{s} JOIN dw{p} USING (i) JOIN db{p} USING (j) GROUP BY id, j, b)",
                f"ex{s} AS (SELECT id, j, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM lg{s})",
                f"dz{s} AS (SELECT id, j, e / sum(e) OVER (PARTITION BY id) - CASE WHEN j = label THEN 1.0 ELSE 0.0 END AS g "
                f"FROM ex{s} JOIN r{s} USING (id))",
                f"gdw{s} AS (SELECT i, j, sum(a * g) AS g FROM fl{s} JOIN dz{s} USING (id) GROUP BY i, j)",
                f"gdb{s} AS (SELECT j, sum(g) AS g FROM dz{s} GROUP BY j)",
                f"dfl{s} AS (SELECT id, i, sum(g * w) AS g FROM dz{s} JOIN dw{p} USING (j) GROUP BY id, i)",
                f"dzc{s} AS (SELECT z.id, z.y, z.x, z.f, CASE WHEN z.z > 0 THEN d.g / 4.0 ELSE 0.0 END AS g FROM z{s} z "
                f"JOIN dfl{s} d ON d.id = z.id AND d.i = ((z.y // 2) * 3 + (z.x // 2)) * 2 + z.f WHERE z.y < 6 AND z.x < 6)",
                f"gcw{s} AS (SELECT f, c, dy, dx, sum(v * g) AS g FROM win JOIN dzc{s} d ON d.id = win.id AND d.y = win.oy AND d.x = win.ox "
                f"GROUP BY f, c, dy, dx)",
                f"gcb{s} AS (SELECT f, sum(g) AS g FROM dzc{s} GROUP BY f)",
            ]
            ctes += adam("cw", "f, c, dy, dx", f"cw{p}", "scw", f"gcw{s}", "w", s)
            ctes += adam("cb", "f", f"cb{p}", "scb", f"gcb{s}", "b", s)
            ctes += adam("dw", "i, j", f"dw{p}", "sdw", f"gdw{s}", "w", s)
            ctes += adam("db", "j", f"db{p}", "sdb", f"gdb{s}", "b", s)
    S = s
    final = (
        f"SELECT 'conv_W' AS param, CAST(((f * 1 + c) * 3 + dy) * 3 + dx AS BIGINT) AS idx, round(w, 6) + 0.0 AS value FROM cw{S}\n"
        f"UNION ALL SELECT 'conv_b', CAST(f AS BIGINT), round(b, 6) + 0.0 FROM cb{S}\n"
        f"UNION ALL SELECT 'dense_W', CAST(i * 10 + j AS BIGINT), round(w, 6) + 0.0 FROM dw{S}\n"
        f"UNION ALL SELECT 'dense_b', CAST(j AS BIGINT), round(b, 6) + 0.0 FROM db{S}"
    )
    return "WITH " + ",\n".join(ctes) + "\n" + final


@register("train_cnn_minibatch", _cnn_minibatch_sql())
def q_train_cnn_minibatch(spark, sf):
    """The reference CNN's mini-batch training with Adam, as synchronous Spark steps: per
    epoch an exact seeded permutation of the training split in 3 consecutive batches, one
    Arrow gradient job (summed gradients) and one Adam step per batch; final weights."""
    from .q_tensor import _cnn_net

    s = _sets(spark, sf)
    tr = s.where(F.col("set") == "train")
    layers, params = _cnn_net()
    cfg = cnn_config(epochs=CNN_MB_EPOCHS, optimizer="adam", learning_rate=CNN_MB_LR, beta1=B1, beta2=B2, epsilon=EPS,
                     batches_per_epoch=CNN_MB_BATCHES, mode="sync")
    res = train_network(tr, layers, cfg, (IMG_H, IMG_W, IMG_C), 10, params=params, evaluate_every=0)
    new = res.params
    rows = []
    for name, arr in (("conv_W", new[0]["W"]), ("conv_b", new[0]["b"]), ("dense_W", new[4]["W"]), ("dense_b", new[4]["b"])):
        rows += [(name, int(k), float(v)) for k, v in enumerate(np.ravel(arr))]
    return spark.createDataFrame(rows, "param string, idx bigint, value double").select("param", "idx", r6("value").alias("value"))
