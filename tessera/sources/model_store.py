"""Model table sink / source: layer specs and parameters as a Parquet table.

Schema: ``layer_idx int, layer_type string, spec string (JSON), param string,
shape array<int>, values array<double>`` — one row per layer (``param`` = 'none' for
parameter-free layers) or per parameter tensor. The table is model-sized.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "layer_idx int, layer_type string, spec string, param string, shape array<int>, values array<double>"


def model_frame(spark: SparkSession, layers: list[dict], params: list) -> DataFrame:
    rows = []
    for i, (ly, p) in enumerate(zip(layers, params)):
        spec = json.dumps(ly, sort_keys=True)
        if p is None:
            rows.append((i, ly["type"], spec, "none", [], []))
            continue
        for name in ("W", "b"):
            arr = np.asarray(p[name], dtype=float)
            rows.append((i, ly["type"], spec, name, [int(s) for s in arr.shape], arr.ravel().tolist()))
    return spark.createDataFrame(rows, SCHEMA)


def save_model(spark: SparkSession, path: str, layers: list[dict], params: list, extra: dict | None = None) -> None:
    """Persist the layer list and trainable parameters (overwrite). ``extra`` maps names to
    arrays stored as rows with ``layer_idx = -1`` (e.g. optimizer state for a resumable run)."""
    df = model_frame(spark, layers, params)
    if extra:
        rows = [(-1, "state", "{}", k, [int(x) for x in np.shape(v)], np.ravel(np.asarray(v, dtype=float)).tolist())
                for k, v in extra.items()]
        df = df.unionByName(spark.createDataFrame(rows, SCHEMA))
    df.coalesce(1).write.mode("overwrite").parquet(path)


def load_extra(spark: SparkSession, path: str) -> dict:
    """The ``layer_idx = -1`` rows written by :func:`save_model` as arrays."""
    rows = spark.read.parquet(path).where("layer_idx = -1").collect()
    return {r["param"]: np.asarray(r["values"], dtype=float).reshape(tuple(r["shape"])) for r in rows}


def load_model(spark: SparkSession, path: str, expect_layers: list[dict] | None = None):
    """Read back; check layer count and each layer's type against ``expect_layers`` when given."""
    rows = spark.read.parquet(path).where("layer_idx >= 0").collect()  # model-sized
    by_layer: dict[int, dict] = {}
    for r in rows:
        d = by_layer.setdefault(r["layer_idx"], {"type": r["layer_type"], "spec": json.loads(r["spec"]), "p": {}})
        if r["param"] != "none":
            d["p"][r["param"]] = np.asarray(r["values"], dtype=float).reshape(tuple(r["shape"]))
    idx = sorted(by_layer)
    if idx != list(range(len(idx))):
        raise ValueError("model table has gaps in layer_idx")
    layers = [by_layer[i]["spec"] for i in idx]
    if expect_layers is not None:
        if len(expect_layers) != len(layers):
            raise ValueError(f"model has {len(layers)} layers, expected {len(expect_layers)}")
        for i, (a, b) in enumerate(zip(expect_layers, layers)):
            if a["type"] != b["type"]:
                raise ValueError(f"layer {i}: stored type {b['type']} differs from expected {a['type']}")
    params = [({"W": by_layer[i]["p"]["W"], "b": by_layer[i]["p"]["b"]} if by_layer[i]["p"] else None) for i in idx]
    return layers, params
