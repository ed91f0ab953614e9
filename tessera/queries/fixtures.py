"""Stand-in inputs built from the given tables, identically in Spark and in DuckDB SQL.

These only shape rows into the schema a job expects (nulls injected by a fixed rule, arrays
viewed as 8×8×1 images, parameters from a fixed formula); they do none of the jobs' work.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table

IMG_H, IMG_W, IMG_C = 8, 8, 1
N_CLASSES = 10

# Fixed fixture rules (FIXTURES.md §C).
CUSTOMER_NULLS_SQL = """
SELECT c_custkey, c_nationkey,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer
"""

CELLS_SQL = """
SELECT CAST(vec_id AS BIGINT) AS id,
       CAST(pos // 8 AS BIGINT) AS y,
       CAST(pos % 8 AS BIGINT) AS x,
       CAST(0 AS BIGINT) AS c,
       CAST(v AS DOUBLE) AS v
FROM (SELECT vec_id, unnest(embedding) AS v, unnest(range(0, len(embedding))) AS pos FROM embeddings)
"""


def customer_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        "c_nationkey",
        F.when(F.col("c_custkey") % 11 == 0, None).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_custkey") % 13 == 0, None).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )


def image_cells(spark: SparkSession, sf_dir: str, partition: bool = True) -> DataFrame:
    from ..operators.tensor import to_cells

    e = read_table(spark, sf_dir, "embeddings")
    return to_cells(e, "vec_id", "embedding", IMG_H, IMG_W, IMG_C, partition=partition)


def conv_weights(n_filters: int = 2, channels: int = 1, k: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Filters ``((f·5 + dy·7 + dx·3) % 11 − 5) / 10`` and biases ``(f + 1) / 20``."""
    w = np.zeros((n_filters, channels, k, k))
    for f in range(n_filters):
        for c in range(channels):
            for dy in range(k):
                for dx in range(k):
                    w[f, c, dy, dx] = ((f * 5 + dy * 7 + dx * 3) % 11 - 5) / 10
    b = np.array([(f + 1) / 20 for f in range(n_filters)])
    return w, b


def dense_weights(n_in: int, n_out: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights ``((i·7 + j·3) % 11 − 5) / 10`` and biases ``((j·5) % 7 − 3) / 10``."""
    i = np.arange(n_in)[:, None]
    j = np.arange(n_out)[None, :]
    w = ((i * 7 + j * 3) % 11 - 5) / 10
    b = ((np.arange(n_out) * 5) % 7 - 3) / 10
    return w.astype(float), b.astype(float)


def conv_weights_sql(n_filters: int = 2, k: int = 3) -> str:
    return f"""
SELECT CAST(f AS BIGINT) AS f, CAST(0 AS BIGINT) AS c, CAST(dy AS BIGINT) AS dy, CAST(dx AS BIGINT) AS dx,
       CAST(((f*5 + dy*7 + dx*3) % 11 - 5) AS DOUBLE) / 10 AS w
FROM range({n_filters}) a(f), range({k}) b(dy), range({k}) d(dx)
"""


def conv_bias_sql(n_filters: int = 2) -> str:
    return f"SELECT CAST(f AS BIGINT) AS f, CAST(f + 1 AS DOUBLE) / 20 AS b FROM range({n_filters}) a(f)"


def dense_weights_sql(n_in: int, n_out: int) -> str:
    return f"""
SELECT CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, CAST(((i*7 + j*3) % 11 - 5) AS DOUBLE) / 10 AS w
FROM range({n_in}) a(i), range({n_out}) b(j)
"""


def dense_bias_sql(n_out: int) -> str:
    return f"SELECT CAST(j AS BIGINT) AS j, CAST(((j*5) % 7 - 3) AS DOUBLE) / 10 AS b FROM range({n_out}) a(j)"
