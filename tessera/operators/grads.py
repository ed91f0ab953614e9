"""Layer gradients in cell form (joins + grouped sums), the oracle-checkable twin of the
NumPy backward pass in :mod:`tessera.plans.kernels`. Gradients are sums over the batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import activations as A
from .tensor import CELL, MAX_PARAM_ROWS, _offsets, im2col


def softmax_ce(probs: DataFrame, labels: DataFrame) -> DataFrame:
    """dLoss/dlogits = p − onehot(y): (id, j, v) ⋈ (id, label) → (id, j, g)."""
    j = probs.join(labels, on="id", how="inner")
    return j.select("id", "j", (F.col("v") - (F.col("j") == F.col("label")).cast("double")).alias("g"))


def dense_grads(x: DataFrame, dz: DataFrame, wdf: DataFrame):
    """Dense layer backward.

    x: (id, i, v) layer input; dz: (id, j, g) gradient at the pre-activation; wdf: (i, j, w).
    Returns (dW (i, j, g), db (j, g), dX (id, i, g)). dW joins the two per-example tables on
    ``id`` (co-partitioned by the shuffle on id) and sums over examples.
    """
    dw = x.join(dz, on="id", how="inner").groupBy("i", "j").agg(F.sum(F.col("v") * F.col("g")).alias("g"))
    db = dz.groupBy("j").agg(F.sum("g").alias("g"))
    dx = dz.join(F.broadcast(wdf), on="j", how="inner").groupBy("id", "i").agg(F.sum(F.col("g") * F.col("w")).alias("g"))
    return dw, db, dx


def conv_grads(cells: DataFrame, g: DataFrame, wdf: DataFrame, kh: int, kw: int, stride: int, h: int, w: int):
    """Convolution backward. cells: input (id, y, x, c, v); g: output gradient (id, y=oy, x=ox, c=f, g).

    dW[f,c,dy,dx] = Σ windows·g; db[f] = Σ g; dX = col2im(g · W) with overlaps **added**.
    """
    win = im2col(cells, kh, kw, stride, h, w)
    gg = g.select("id", F.col("y").alias("oy"), F.col("x").alias("ox"), F.col("c").alias("f"), "g")
    dw = win.join(gg, on=["id", "oy", "ox"], how="inner").groupBy("f", "c", "dy", "dx").agg(
        F.sum(F.col("v") * F.col("g")).alias("g")
    )
    db = gg.groupBy("f").agg(F.sum("g").alias("g"))
    back = gg.join(F.broadcast(wdf), on="f", how="inner")  # filters: model-sized
    dx = back.groupBy(
        "id", (F.col("oy") * stride + F.col("dy")).alias("y"), (F.col("ox") * stride + F.col("dx")).alias("x"), "c"
    ).agg(F.sum(F.col("g") * F.col("w")).alias("g"))
    return dw, db, dx


def pool_avg_grad(g: DataFrame, k: int, stride: int) -> DataFrame:
    """Average-pool backward: each output gradient is shared equally over its window; overlaps add."""
    e = g.select("id", F.col("y").alias("oy"), F.col("x").alias("ox"), "c", "g", F.explode(_offsets(k, k)).alias("o"))
    return e.groupBy(
        "id", (F.col("oy") * stride + F.col("o.dy")).alias("y"), (F.col("ox") * stride + F.col("o.dx")).alias("x"), "c"
    ).agg(F.sum(F.col("g") / F.lit(float(k * k))).alias("g"))


def pool_max_grad(cells: DataFrame, pooled: DataFrame, g: DataFrame, k: int, stride: int, h: int, w: int) -> DataFrame:
    """Max-pool backward: the full gradient goes to **every** input equal to its window max."""
    win = im2col(cells, k, k, stride, h, w)
    mx = pooled.select("id", F.col("y").alias("oy"), F.col("x").alias("ox"), "c", F.col("v").alias("m"))
    gg = g.select("id", F.col("y").alias("oy"), F.col("x").alias("ox"), "c", "g")
    hit = win.join(mx, on=["id", "oy", "ox", "c"], how="inner").where(F.col("v") == F.col("m"))
    j = hit.join(gg, on=["id", "oy", "ox", "c"], how="inner")
    return j.groupBy(
        "id", (F.col("oy") * stride + F.col("dy")).alias("y"), (F.col("ox") * stride + F.col("dx")).alias("x"), "c"
    ).agg(F.sum("g").alias("g"))


def act_grad(z: DataFrame, g: DataFrame, fn: str) -> DataFrame:
    """Activation backward: g · act'(z), joined on the cell key."""
    j = z.join(g, on=CELL, how="inner")
    return j.select(*CELL, (F.col("g") * A.scalar(f"{fn}_grad", F.col("v"))).alias("g"))


__all__ = ["softmax_ce", "dense_grads", "conv_grads", "pool_avg_grad", "pool_max_grad", "act_grad", "MAX_PARAM_ROWS"]
