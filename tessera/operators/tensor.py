"""Tensor layers in cell form: one row per tensor element ``(id, y, x, c, v)``.

Each layer is a relational plan — window extraction is a generator over the kernel offsets
(no join), a contraction is an equi-join with the small, size-checked parameter table
followed by a grouped sum, pooling is a grouped aggregate. These plans are the
engine-independent definition of the layers (each has a SQL oracle) and the validation path
for the fused packed kernels in :mod:`tessera.plans.kernels`; at volume use the packed form,
since a convolution multiplies rows by KH·KW·F here.

Shapes (H, W, C) are layer metadata known on the driver and are passed explicitly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import activations as A

CELL = ["id", "y", "x", "c"]
MAX_PARAM_ROWS = 5_000_000  # parameter tables are model-sized; beyond this, do not broadcast


def _bcast(df: DataFrame, n_rows: int) -> DataFrame:
    return F.broadcast(df) if n_rows <= MAX_PARAM_ROWS else df


# ----------------------------------------------------------------------------- layout
def to_cells(df: DataFrame, id_col: str, data_col: str, h: int, w: int, c: int = 1, partition: bool = True,
             num_partitions: int | None = None) -> DataFrame:
    """Packed row-major HWC array → cells. ``pos = (y·W + x)·C + c``.

    With ``partition`` the packed rows are hash-partitioned by id *before* exploding: one
    shuffle of compact rows, after which every per-example operator downstream (window
    sums, pooling, dense sums, softmax windows, per-id gradient joins) finds its input
    already clustered and plans no further exchange. Leave it off for element-wise use only.
    """
    key = F.col(id_col).cast("bigint")
    if partition:
        df = df.repartition(num_partitions, key) if num_partitions else df.repartition(key)
    e = df.select(key.alias("id"), F.posexplode(F.col(data_col)).alias("pos", "v"))
    return e.select(
        "id",
        F.floor(F.col("pos") / (w * c)).cast("bigint").alias("y"),
        (F.floor(F.col("pos") / c) % w).cast("bigint").alias("x"),
        (F.col("pos") % c).cast("bigint").alias("c"),
        F.col("v").cast("double").alias("v"),
    )


def to_vectors(df: DataFrame, id_col: str, data_col: str, partition: bool = True, num_partitions: int | None = None) -> DataFrame:
    """Packed vector → (id, i, v) rows, optionally clustered by id first (see :func:`to_cells`)."""
    key = F.col(id_col).cast("bigint")
    if partition:
        df = df.repartition(num_partitions, key) if num_partitions else df.repartition(key)
    e = df.select(key.alias("id"), F.posexplode(F.col(data_col)).alias("i", "v"))
    return e.select("id", F.col("i").cast("bigint").alias("i"), F.col("v").cast("double").alias("v"))


def to_packed(cells: DataFrame, h: int, w: int, c: int = 1, out: str = "data") -> DataFrame:
    """Cells → one array per id (group size is bounded by the image size H·W·C)."""
    pos = (F.col("y") * w + F.col("x")) * c + F.col("c")
    return cells.groupBy("id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(pos.alias("p"), F.col("v").alias("v")))), lambda s: s["v"]).alias(out)
    )


def flatten(cells: DataFrame, w: int, c: int) -> DataFrame:
    """(id, y, x, c, v) → (id, i, v) with row-major ``i = (y·W + x)·C + c``."""
    return cells.select("id", ((F.col("y") * w + F.col("x")) * c + F.col("c")).cast("bigint").alias("i"), "v")


def unflatten(vec: DataFrame, w: int, c: int) -> DataFrame:
    return vec.select(
        "id",
        F.floor(F.col("i") / (w * c)).cast("bigint").alias("y"),
        (F.floor(F.col("i") / c) % w).cast("bigint").alias("x"),
        (F.col("i") % c).cast("bigint").alias("c"),
        "v",
    )


def pad(cells: DataFrame, p: int, h: int, w: int) -> DataFrame:
    """Zero padding of dense cells: a coordinate shift plus the border cells, which each channel's
    first cell (y = x = 0) brings along, so no shuffle is needed and every window has its cells."""
    shifted = cells.select("id", (F.col("y") + p).cast("bigint").alias("y"), (F.col("x") + p).cast("bigint").alias("x"), "c", "v")
    if p <= 0:
        return shifted
    zero = F.lit(0).cast(cells.schema["v"].dataType)
    at = F.sequence(F.lit(0), F.lit((h + 2 * p) * (w + 2 * p) - 1))
    y, x = (lambda i: F.floor(i / (w + 2 * p))), (lambda i: i % (w + 2 * p))
    border = F.filter(at, lambda i: (y(i) < p) | (y(i) >= p + h) | (x(i) < p) | (x(i) >= p + w))
    corner = cells.where("y = 0 AND x = 0").select("id", "c", F.explode(border).alias("i"))
    return shifted.unionByName(corner.select("id", y(F.col("i")).cast("bigint").alias("y"), x(F.col("i")).cast("bigint").alias("x"), "c", zero.alias("v")))


def pad_dense_packed(df: DataFrame, data_col: str, h: int, w: int, c: int, p: int, out: str = "data") -> DataFrame:
    """Dense zero padding of a packed HWC array, as one projection (no shuffle)."""
    hp, wp = h + 2 * p, w + 2 * p

    def pick(pos):
        y = F.floor(pos / (wp * c))
        x = F.floor(pos / c) % wp
        ch = pos % c
        inside = (y >= p) & (y < p + h) & (x >= p) & (x < p + w)
        src = ((y - p) * w + (x - p)) * c + ch + 1
        return F.when(inside, F.element_at(F.col(data_col), src.cast("int")).cast("double")).otherwise(F.lit(0.0))

    return df.withColumn(out, F.transform(F.sequence(F.lit(0), F.lit(hp * wp * c - 1)), pick))


# ----------------------------------------------------------------------------- windows
def _offsets(kh: int, kw: int) -> Column:
    return F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy in range(kh) for dx in range(kw)])


def im2col(cells: DataFrame, kh: int, kw: int, stride: int, h: int, w: int) -> DataFrame:
    """Window extraction: each cell is emitted once per window containing it.

    Output ``(id, oy, ox, c, dy, dx, v)``; ``OH = (H − KH) // s + 1``. Column order of the
    window matrix is (C, KH, KW).
    """
    oh, ow = (h - kh) // stride + 1, (w - kw) // stride + 1
    e = cells.select(*CELL, "v", F.explode(_offsets(kh, kw)).alias("o")).select(*CELL, "v", "o.dy", "o.dx")
    ty, tx = F.col("y") - F.col("dy"), F.col("x") - F.col("dx")
    ok = (ty >= 0) & (tx >= 0) & (ty % stride == 0) & (tx % stride == 0) & (ty < oh * stride) & (tx < ow * stride)
    return e.where(ok).select(
        "id",
        F.floor(ty / stride).cast("bigint").alias("oy"),
        F.floor(tx / stride).cast("bigint").alias("ox"),
        "c",
        F.col("dy").cast("bigint").alias("dy"),
        F.col("dx").cast("bigint").alias("dx"),
        "v",
    )


def col2im(windows: DataFrame, stride: int, agg: str = "avg") -> DataFrame:
    """Put window elements back; overlapping contributions are averaged ('avg') or added ('sum')."""
    y = (F.col("oy") * stride + F.col("dy")).alias("y")
    x = (F.col("ox") * stride + F.col("dx")).alias("x")
    g = windows.groupBy("id", y, x, "c")
    if agg == "avg":
        return g.agg(F.avg("v").alias("v"))
    if agg == "sum":
        return g.agg(F.sum("v").alias("v"))
    raise ValueError("agg must be 'avg' or 'sum'")


# ----------------------------------------------------------------------------- parameters
def conv_weight_table(spark: SparkSession, weights: np.ndarray, biases: np.ndarray | None = None):
    """(F, C, KH, KW) filters → rows (f, c, dy, dx, w) and (f, b)."""
    f, c, kh, kw = weights.shape
    idx = np.indices(weights.shape).reshape(4, -1).T
    rows = [(int(a), int(b), int(d), int(e), float(weights[a, b, d, e])) for a, b, d, e in idx]
    wdf = spark.createDataFrame(rows, "f bigint, c bigint, dy bigint, dx bigint, w double")
    b = biases if biases is not None else np.zeros(f)
    bdf = spark.createDataFrame([(int(i), float(v)) for i, v in enumerate(np.ravel(b))], "f bigint, b double")
    return wdf, bdf


def dense_weight_table(spark: SparkSession, weights: np.ndarray, biases: np.ndarray | None = None):
    """(in, out) matrix → rows (i, j, w) and (j, b)."""
    n_in, n_out = weights.shape
    rows = [(int(i), int(j), float(weights[i, j])) for i in range(n_in) for j in range(n_out)]
    wdf = spark.createDataFrame(rows, "i bigint, j bigint, w double")
    b = np.ravel(biases) if biases is not None else np.zeros(n_out)
    bdf = spark.createDataFrame([(int(j), float(v)) for j, v in enumerate(b)], "j bigint, b double")
    return wdf, bdf


# ----------------------------------------------------------------------------- layers
def conv2d(cells: DataFrame, wdf: DataFrame, bdf: DataFrame, kh: int, kw: int, stride: int, h: int, w: int,
           n_params: int | None = None) -> DataFrame:
    """Cross-correlation + bias → cells ``(id, y=oy, x=ox, c=f, v)``."""
    win = im2col(cells, kh, kw, stride, h, w)
    n = n_params if n_params is not None else MAX_PARAM_ROWS
    prod = win.join(_bcast(wdf, n), on=["c", "dy", "dx"], how="inner")
    s = prod.groupBy("id", "oy", "ox", "f").agg(F.sum(F.col("v") * F.col("w")).alias("s"))
    out = s.join(F.broadcast(bdf), on="f", how="inner")
    return out.select("id", F.col("oy").alias("y"), F.col("ox").alias("x"), F.col("f").alias("c"), (F.col("s") + F.col("b")).alias("v"))


def activate(cells: DataFrame, fn: str) -> DataFrame:
    """Element-wise activation (relu, tanh, sigmoid) or its derivative (relu_grad, …)."""
    return cells.withColumn("v", A.scalar(fn, F.col("v")))


def softmax_cells(vec: DataFrame, key: str = "id", idx: str = "j") -> DataFrame:
    """Row-wise softmax over (id, j, v); the window group is one example's classes."""
    w = Window.partitionBy(key)
    z = vec.withColumn("_e", F.exp(F.col("v") - F.max("v").over(w)))
    return z.withColumn("v", F.col("_e") / F.sum("_e").over(w)).drop("_e")


def pool(cells: DataFrame, k: int, stride: int, h: int, w: int, mode: str = "avg") -> DataFrame:
    """Per-channel mean or max over K×K windows; the ragged edge is dropped."""
    if mode not in ("avg", "max"):
        raise ValueError("mode must be 'avg' or 'max'")
    oh, ow = (h - k) // stride + 1, (w - k) // stride + 1
    if stride == k:
        src = cells.where((F.col("y") < oh * k) & (F.col("x") < ow * k)).select(
            "id", F.floor(F.col("y") / k).cast("bigint").alias("oy"), F.floor(F.col("x") / k).cast("bigint").alias("ox"), "c", "v"
        )
    else:
        src = im2col(cells, k, k, stride, h, w)
    g = src.groupBy("id", "oy", "ox", "c")
    red = g.agg((F.sum("v") / F.lit(float(k * k))).alias("v")) if mode == "avg" else g.agg(F.max("v").alias("v"))
    return red.select("id", F.col("oy").alias("y"), F.col("ox").alias("x"), "c", "v")


def dense(vec: DataFrame, wdf: DataFrame, bdf: DataFrame, act: str | None = None, n_params: int | None = None) -> DataFrame:
    """(id, i, v) × W(i, j) + b(j) → (id, j, v), then the activation (softmax is row-wise)."""
    n = n_params if n_params is not None else MAX_PARAM_ROWS
    s = vec.join(_bcast(wdf, n), on="i", how="inner").groupBy("id", "j").agg(F.sum(F.col("v") * F.col("w")).alias("s"))
    z = s.join(F.broadcast(bdf), on="j", how="inner").select("id", "j", (F.col("s") + F.col("b")).alias("v"))
    if act is None or act == "linear":
        return z
    if act == "softmax":
        return softmax_cells(z)
    return z.withColumn("v", A.scalar(act, F.col("v")))


def with_channel(df: DataFrame, data_col: str, h: int, w: int, c: int = 1, out: str = "data") -> DataFrame:
    """Narrow to float32 and attach the (H, W, C) shape of each packed row (adds the channel axis)."""
    return df.withColumn(out, F.col(data_col).cast("array<float>")).withColumns(
        {"h": F.lit(h), "w": F.lit(w), "c": F.lit(c)}
    )
