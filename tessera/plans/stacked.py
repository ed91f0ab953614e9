"""Stacked training: many models of one layer list, one gradient job per step for all of them.

Cross-validation and grid search train one model per (cell, fold). The models form the leading axis of
one weight matrix. A step reads one mini-batch of the fold table; every task runs each model on the
batch's rows outside the model's own fold and returns gradient sums per model. The number of Spark
jobs is therefore epochs times batches, whatever the number of cells and folds. Batches come
from :func:`~tessera.operators.splits.fold_batches`, so all folds share one reading of the rows.
Weights and optimizer state live on the driver and are bounded: beyond ``STACK_PARAMS`` parameters
the models are trained in groups of whole cells.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.splits import fold_batch_count, fold_batches
from ..session import ship_package
from . import kernels as K
from .scoring import arrow_list, arrow_matrix, check_model_size
from .training import _GRAD_SCHEMA, Optimizer, TrainConfig, _labels, _n_partitions, _shape_x, _sum_partials, weight_mask

STACK_PARAMS = 1_000_000  # doubles of all models trained together (8 MB a broadcast)


def _stacked_gradients(step: DataFrame, bc, k: int, in_shape: tuple, n_classes: int, eps_mode: str, cols: dict) -> DataFrame:
    """One row per partition and model: the gradient sum over the rows outside the model's fold.
    Model ``m`` is cell ``m // k`` trained without fold ``m % k``."""
    width = int(np.prod(in_shape))

    def run(batches):
        from pyspark import TaskContext

        layers, like, thetas = bc.value
        models = [K.unpack(t, like) for t in thetas]
        sums = np.zeros_like(thetas)
        n, loss, correct = (np.zeros(len(models)) for _ in range(3))
        for rb in batches:
            if rb.num_rows == 0:
                continue
            x = _shape_x(arrow_matrix(rb, cols["data"], width), in_shape)
            y, fold = _labels(rb, cols["label"]), _labels(rb, cols["fold"])
            for f in range(k):
                at = fold != f
                if not at.any():
                    continue
                xs, ys = x[at], y[at]
                for m in range(f, len(models), k):
                    flat, ls, ok = K.batch_gradients(xs, ys, layers, models[m], n_classes, eps_mode)
                    sums[m] += flat
                    n[m] += len(ys)
                    loss[m] += ls
                    correct[m] += ok
        part = TaskContext.get().partitionId()
        for m in np.flatnonzero(n).tolist():
            yield pa.RecordBatch.from_arrays(
                [pa.array([m], pa.int32()), pa.array([part], pa.int64()), pa.array([int(n[m])], pa.int64()), pa.array([loss[m]]),
                 pa.array([int(correct[m])], pa.int64()), arrow_list(sums[m][None, :])],
                names=["replica", "part", "n", "loss", "correct", "grad"],
            )

    return step.select(cols["label"], cols["data"], cols["fold"]).mapInArrow(run, _GRAD_SCHEMA)


def _stacked_scores(folded: DataFrame, bc, k: int, in_shape: tuple, eps_mode: str, cols: dict) -> dict[tuple[int, str], tuple]:
    """{(model, 'train' | 'val'): (mean loss, accuracy)} of all models in one job."""
    width = int(np.prod(in_shape))

    def run(batches):
        layers, like, thetas = bc.value
        models = [K.unpack(t, like) for t in thetas]
        for rb in batches:
            if rb.num_rows == 0:
                continue
            x = _shape_x(arrow_matrix(rb, cols["data"], width), in_shape)
            y, fold = _labels(rb, cols["label"]), _labels(rb, cols["fold"])
            out = []
            for m, params in enumerate(models):
                p = K.predict_proba(x, layers, params)
                terms, ok = K.ce_terms(p, y, eps_mode), p.argmax(axis=1) == y
                for name, at in (("train", fold != m % k), ("val", fold == m % k)):
                    if at.any():
                        out.append((m, name, int(at.sum()), float(terms[at].sum()), int(ok[at].sum())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.string(), pa.int64(), pa.float64(), pa.int64()))],
                names=["model", "set", "n", "loss", "ok"],
            )

    sums = folded.select(cols["label"], cols["data"], cols["fold"]).mapInArrow(run, "model int, set string, n bigint, loss double, ok bigint")
    got = sums.groupBy("model", "set").agg(F.sum("n").alias("n"), F.sum("loss").alias("loss"), F.sum("ok").alias("ok"))
    return {(r["model"], r["set"]): (r["loss"] / r["n"], r["ok"] / r["n"]) for r in got.collect()}


def _train_group(folded: DataFrame, n_rows: int, n_parts: int, k: int, layers: list, cfgs: list[TrainConfig], params: list,
                 in_shape: tuple, n_classes: int, cols: dict) -> dict:
    base = cfgs[0]
    size = K.n_params(params)
    thetas = np.tile(K.pack(params), (len(cfgs) * k, 1))
    mask = weight_mask(params)
    opts = [Optimizer(c, size, mask) for c in cfgs for _ in range(k)]
    n_batches = fold_batch_count(n_rows, k, base.batch_size, base.batches_per_epoch)
    sc = folded.sparkSession.sparkContext
    for epoch in range(base.epochs):
        batched = folded
        if n_batches > 1:
            batch = fold_batches(cols["fold"], cols["place"], n_rows, k, base.seed, epoch, base.batch_size, base.batches_per_epoch)
            # sorted by batch, the cached column batches carry tight bounds: a step skips the others' data
            batched = folded.withColumn("_batch", batch).sortWithinPartitions("_batch").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for b in range(n_batches):
                step = batched.where(F.col("_batch") == b) if n_batches > 1 else batched
                bc = sc.broadcast((layers, params, thetas))
                try:
                    rows = _stacked_gradients(step, bc, k, in_shape, n_classes, base.eps_mode, cols)
                    got = _sum_partials(rows, size, n_parts)
                finally:
                    bc.destroy()
                thetas = thetas.copy()
                for m, (g, m_rows, _, _) in got.items():
                    thetas[m] = opts[m].step(thetas[m], g, m_rows)
        finally:
            if batched is not folded:
                batched.unpersist()
        if not np.all(np.isfinite(thetas)):
            raise FloatingPointError(f"non-finite parameters after epoch {epoch}")
    bc = sc.broadcast((layers, params, thetas))
    try:
        return _stacked_scores(folded, bc, k, in_shape, base.eps_mode, cols)
    finally:
        bc.destroy()


def stacked_cv(folded: DataFrame, n_rows: int, k: int, layers: list[dict], cfgs: list[TrainConfig], in_shape: tuple, n_classes: int,
               init: list | None = None, label_col: str = "label", data_col: str = "data", fold_col: str = "fold",
               place_col: str = "place") -> list[list[tuple]]:
    """Per configuration the rows (fold, set, loss, accuracy) of its ``k`` models.

    ``folded`` is a cached fold table with each row's place in its fold. The configurations share
    epochs, batches, seed and loss and may differ in all that acts in the update (rates, λ, optimizer). All
    models start from ``init`` (default: one seeded initialisation), as they do one by one.
    """
    shared = {(c.epochs, c.batch_size, c.batches_per_epoch, c.seed, c.eps_mode, c.mode) for c in cfgs}
    if len(shared) != 1 or cfgs[0].mode != "sync":
        raise ValueError("stacked configurations share epochs, batches, seed and loss, and run in 'sync' mode")
    ship_package(folded.sparkSession)
    K.output_shapes(layers, in_shape)
    params = init if init is not None else K.init_params(layers, cfgs[0].seed)
    per_cell = check_model_size(params) * k
    group = max(1, STACK_PARAMS // max(1, per_cell))
    cols = {"label": label_col, "data": data_col, "fold": fold_col, "place": place_col}
    n_parts = _n_partitions(folded)
    out = []
    for first in range(0, len(cfgs), group):
        cells = cfgs[first : first + group]
        scores = _train_group(folded, n_rows, n_parts, k, layers, cells, params, in_shape, n_classes, cols)
        for c in range(len(cells)):
            out.append([(f, s, *map(float, scores[c * k + f, s])) for f in range(k) for s in ("train", "val") if (c * k + f, s) in scores])
    return out
