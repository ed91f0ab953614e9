"""Data-quality checks as one aggregate per table (the reference's inline guards)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_finite(c) -> F.Column:
    """Neither NaN nor an infinity (NULL for a null)."""
    return ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def probability_sums(df: DataFrame, probs: str, tolerance: float = 1e-6) -> DataFrame:
    """One row (n_rows, n_off): rows whose probability vector is null, has a value that is not finite
    or outside [0, 1], or does not sum to 1 within ``tolerance``."""
    p = F.transform(F.col(probs), lambda v: v.cast("double"))
    total = F.aggregate(p, F.lit(0.0), lambda a, v: a + v)
    bad = F.col(probs).isNull() | F.exists(p, lambda v: v.isNull() | ~is_finite(v) | (v < 0) | (v > 1)) | (F.abs(total - 1) > tolerance)
    return df.agg(F.count("*").alias("n_rows"), F.count_if(F.coalesce(bad, F.lit(True))).alias("n_off"))


def dq_summary(df: DataFrame, array_shapes: dict[str, int] | None = None) -> DataFrame:
    """One row per column: rows, nulls, values that are not finite (``n_nan``), min and max of the
    finite values (numeric), all from a single pass.

    ``array_shapes`` maps an array column to its expected length; mismatches are reported in
    ``n_nan`` of that column as ``bad_shape`` rows (size ≠ expected).
    """
    array_shapes = array_shapes or {}
    aggs = [F.count(F.lit(1)).alias("_rows")]
    meta = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f.name)
        numeric = isinstance(f.dataType, T.NumericType)
        floating = isinstance(f.dataType, (T.DoubleType, T.FloatType))
        aggs.append(F.count_if(c.isNull()).alias(f"z{i}"))
        if floating:
            aggs.append(F.count_if(~is_finite(c)).alias(f"nan{i}"))
        elif f.name in array_shapes:
            aggs.append(F.count_if(F.size(c) != array_shapes[f.name]).alias(f"nan{i}"))
        else:
            aggs.append(F.lit(0).cast("bigint").alias(f"nan{i}"))
        if numeric:
            finite = F.when(is_finite(c), c) if floating else c  # NaN would otherwise be the maximum
            aggs += [F.min(finite).cast("double").alias(f"lo{i}"), F.max(finite).cast("double").alias(f"hi{i}")]
        else:
            aggs += [F.lit(None).cast("double").alias(f"lo{i}"), F.lit(None).cast("double").alias(f"hi{i}")]
        meta.append((i, f.name))
    wide = df.agg(*aggs)
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("col_name"),
                    F.col("_rows").cast("bigint").alias("n_rows"),
                    F.col(f"z{i}").cast("bigint").alias("n_null"),
                    F.col(f"nan{i}").cast("bigint").alias("n_nan"),
                    F.col(f"lo{i}").alias("min_value"),
                    F.col(f"hi{i}").alias("max_value"),
                )
                for i, name in meta
            ]
        )
    )
    return wide.select(rows.alias("s")).select("s.*")


def assert_clean(df: DataFrame, cols: list[str] | None = None, lo: float | None = None, hi: float | None = None) -> None:
    """Raise when listed columns hold nulls/NaNs or leave [lo, hi] (one aggregate job)."""
    cols = cols or df.columns
    summary = dq_summary(df.select(*cols)).collect()
    for r in summary:
        if r["n_null"] or r["n_nan"]:
            raise ValueError(f"{r['col_name']}: {r['n_null']} nulls, {r['n_nan']} non-finite or bad-shape values")
        if lo is not None and r["min_value"] is not None and r["min_value"] < lo:
            raise ValueError(f"{r['col_name']}: minimum {r['min_value']} < {lo}")
        if hi is not None and r["max_value"] is not None and r["max_value"] > hi:
            raise ValueError(f"{r['col_name']}: maximum {r['max_value']} > {hi}")


def observe_quality(df: DataFrame, name: str, cols: list[str] | None = None):
    """Attach the same checks to a job that runs anyway (``DataFrame.observe``): row count,
    nulls/NaNs per column, numeric min/max — collected as a side effect of the next action,
    with no extra pass. Returns (observed DataFrame, Observation); read ``obs.get`` after the action."""
    from pyspark.sql import Observation

    cols = cols or df.columns
    exprs = [F.count(F.lit(1)).alias("rows")]
    for f in df.schema.fields:
        if f.name not in cols:
            continue
        bad = F.col(f.name).isNull()
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            bad = bad | ~is_finite(F.col(f.name))
        exprs.append(F.count_if(bad).alias(f"{f.name}__bad"))
        if isinstance(f.dataType, T.NumericType):
            x = F.col(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                x = F.when(is_finite(x), x)
            exprs += [F.min(x).cast("double").alias(f"{f.name}__min"), F.max(x).cast("double").alias(f"{f.name}__max")]
    obs = Observation(name)
    return df.observe(obs, *exprs), obs
