"""Cross-validation: stratified folds, per-fold training, grid search and best-cell choice."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_cell(scores: DataFrame, by: str = "single") -> DataFrame:
    """Pick the best grid cell from ``(grid_idx, fold, accuracy)`` rows.

    'single' (reference rule): the highest single-fold accuracy; the strict '>' scan in grid
    order means ties go to the first grid cell, then the first fold. 'mean': highest mean
    accuracy over folds, ties to the first grid cell. A distributed top-1, not a sort.
    """
    if by == "single":
        return scores.orderBy(F.col("accuracy").desc(), F.col("grid_idx"), F.col("fold")).limit(1)
    if by == "mean":
        m = scores.groupBy("grid_idx").agg(F.avg("accuracy").alias("accuracy"))
        return m.orderBy(F.col("accuracy").desc(), F.col("grid_idx")).limit(1)
    raise ValueError("by must be 'single' or 'mean'")


def fold_table(df: DataFrame, k: int, seed: int | None, in_shape: tuple, id_col: str = "id", label_col: str = "label",
               data_col: str = "data", fold_col: str = "fold", shuffle: bool = True) -> tuple[DataFrame, int]:
    """(fold table, rows): stratified folds with each row's ``place`` in its fold, persisted once and
    right-sized for Arrow work. The caller unpersists it."""
    from ..operators.splits import kfold
    from .training import cache_sized

    folded = kfold(df.select(id_col, label_col, data_col), label_col, id_col, k, seed, out=fold_col, shuffle=shuffle, place="place")
    return cache_sized(folded, int(np.prod(in_shape)))


def _cv(df, layers, cfgs, in_shape, n_classes, k, seed, id_col, label_col, data_col, fold_col, shuffle, init) -> list[list[tuple]]:
    from .stacked import stacked_cv

    folded, n_rows = fold_table(df, k, seed, in_shape, id_col, label_col, data_col, fold_col, shuffle)
    try:
        if n_rows == 0:
            raise ValueError("no rows to cross-validate")
        return stacked_cv(folded, n_rows, k, layers, cfgs, in_shape, n_classes, init, label_col, data_col, fold_col)
    finally:
        folded.unpersist()


def cv_scores(
    df: DataFrame,
    layers: list[dict],
    cfg,
    in_shape: tuple,
    n_classes: int,
    k: int = 5,
    seed: int = 42,
    id_col: str = "id",
    label_col: str = "label",
    data_col: str = "data",
    fold_col: str = "fold",
    shuffle: bool = True,
    init: list | None = None,
) -> list[tuple]:
    """Stratified k-fold: train on k−1 folds, score both sides. Returns (fold, set, loss, accuracy).

    The ``k`` models train together on mini-batches of one persisted fold table (``cfg.batch_size``,
    ``cfg.epochs``; the reference runs 100 epochs of 32 rows): one gradient job a step for all folds
    (:mod:`tessera.plans.stacked`). ``init`` fixes the starting parameters of every fold (default:
    one seeded initialisation).
    """
    return _cv(df, layers, [cfg], in_shape, n_classes, k, seed, id_col, label_col, data_col, fold_col, shuffle, init)[0]


def cv_grid_scores(df: DataFrame, layers, base_cfg, in_shape, n_classes, lrs: list[float], lams: list[float],
                   k: int = 5, seed: int = 42, id_col: str = "id", label_col: str = "label", data_col: str = "data",
                   fold_col: str = "fold", shuffle: bool = True, init: list | None = None) -> list[tuple]:
    """lr × λ grid of k-fold CV, grid order lr-major, on one fold table and one gradient job a step
    for all cells and folds. Rows: (grid_idx, lr, lambda, fold, set, loss, accuracy)."""
    grid = [(lr, lam) for lr in lrs for lam in lams]
    cfgs = [replace(base_cfg, learning_rate=lr, lam=lam) for lr, lam in grid]
    got = _cv(df, layers, cfgs, in_shape, n_classes, k, seed, id_col, label_col, data_col, fold_col, shuffle, init)
    return [(g, lr, lam, *row) for g, ((lr, lam), rows) in enumerate(zip(grid, got)) for row in rows]
