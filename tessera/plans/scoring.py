"""Batch scoring of packed tensor rows: Arrow batches in, NumPy forward pass, Arrow out.

The model travels once per executor as a broadcast variable (its size is the parameter
count, checked against a limit); rows stream through ``mapInArrow`` so list columns are read
as one flat buffer per batch with no per-row Python objects.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from . import kernels as K

MAX_BROADCAST_PARAMS = 50_000_000  # doubles (400 MB); larger models do not fit this design


def check_model_size(params) -> int:
    n = K.n_params(params)
    if n > MAX_BROADCAST_PARAMS:
        raise ValueError(f"model has {n} parameters; above the broadcast limit {MAX_BROADCAST_PARAMS}")
    return n


def arrow_matrix(rb: pa.RecordBatch, col: str, width: int) -> np.ndarray:
    """A list<float|double> column of fixed width → (n, width) float64 without per-row objects."""
    arr = rb.column(rb.schema.get_field_index(col))
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    if n == 0:
        return np.zeros((0, width))
    if arr.null_count:
        raise ValueError(f"{col}: null arrays cannot be scored")
    offs = arr.offsets.to_numpy()
    if not np.all(np.diff(offs) == width):
        raise ValueError(f"{col}: every array must hold {width} values")
    vals = arr.values.to_numpy(zero_copy_only=False)[offs[0]:offs[-1]]
    return vals.astype(np.float64, copy=False).reshape(n, width)


def arrow_list(mat: np.ndarray) -> pa.ListArray:
    n, k = mat.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k, dtype=np.int32)), pa.array(mat.ravel(), pa.float64()))


def score(
    df: DataFrame,
    layers: list[dict],
    params: list[dict | None],
    in_shape: tuple,
    data_col: str = "data",
    keep: list[str] | None = None,
    probs_col: str = "probs",
    pred_col: str = "predicted",
) -> DataFrame:
    """Add class probabilities and the arg-max class to every row (one pass, no shuffle)."""
    keep = list(keep or [])
    check_model_size(params)
    spark = df.sparkSession
    ship_package(spark)
    bc = spark.sparkContext.broadcast((layers, params))
    width = int(np.prod(in_shape))
    shape = tuple(in_shape)
    src = df.select(*keep, F.col(data_col))
    out_fields = [f for f in src.schema.fields if f.name in keep]
    from pyspark.sql import types as T

    schema = T.StructType(
        out_fields
        + [T.StructField(probs_col, T.ArrayType(T.DoubleType(), False)), T.StructField(pred_col, T.LongType())]
    )

    def run(batches):
        lys, prm = bc.value
        for rb in batches:
            x = arrow_matrix(rb, data_col, width).reshape((-1,) + shape)
            p = K.predict_proba(x, lys, prm)
            cols = [rb.column(rb.schema.get_field_index(k)) for k in keep]
            yield pa.RecordBatch.from_arrays(
                cols + [arrow_list(p), pa.array(p.argmax(axis=1).astype(np.int64))], names=keep + [probs_col, pred_col]
            )

    return src.mapInArrow(run, schema)


def feature_maps(df: DataFrame, layers: list[dict], params, in_shape: tuple, upto: int, data_col: str = "data",
                 id_col: str = "id") -> DataFrame:
    """Output of layer ``upto`` (0-based) for every row, as cells (id, y, x, c, v)."""
    check_model_size(params)
    spark = df.sparkSession
    ship_package(spark)
    bc = spark.sparkContext.broadcast((layers[: upto + 1], params[: upto + 1]))
    width = int(np.prod(in_shape))
    shape = tuple(in_shape)
    schema = "id bigint, y bigint, x bigint, c bigint, v double"

    def run(batches):
        lys, prm = bc.value
        for rb in batches:
            x = arrow_matrix(rb, data_col, width).reshape((-1,) + shape)
            a, _ = K.forward(x, lys, prm)
            ids = rb.column(rb.schema.get_field_index(id_col)).to_numpy(zero_copy_only=False).astype(np.int64)
            if a.ndim == 2:
                a = a[:, None, None, :]
            n, h, w, c = a.shape
            yy, xx, cc = np.meshgrid(np.arange(h), np.arange(w), np.arange(c), indexing="ij")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(ids, h * w * c)),
                    pa.array(np.tile(yy.ravel(), n).astype(np.int64)),
                    pa.array(np.tile(xx.ravel(), n).astype(np.int64)),
                    pa.array(np.tile(cc.ravel(), n).astype(np.int64)),
                    pa.array(a.reshape(-1).astype(np.float64)),
                ],
                names=["id", "y", "x", "c", "v"],
            )

    return df.select(F.col(id_col).cast("bigint").alias(id_col), data_col).mapInArrow(run, schema)
