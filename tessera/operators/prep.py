"""Tabular feature preparation: kinds, nulls, invalid zeros, outliers, scaling, encoding.

Each operator is ``fit`` (one aggregate job → a few driver scalars) followed by a lazy
projection that stays inside whole-stage codegen. No operator joins statistics back onto the
data and none collects rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stats import frequency_extremes, medians, moments, null_counts, quantiles

MAX_INLINE_LEVELS = 64  # levels looked up through a literal array inside the projection
MAX_LITERAL_LEVELS = 100_000  # collected level list → broadcast (value, code) table; above: code table join


# ----------------------------------------------------------------------------- kinds
def numeric_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """Columns of a numeric type (booleans, dates, strings are not numeric)."""
    ex = set(exclude or [])
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in ex]


def categorical_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    ex = set(exclude or [])
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType) and f.name not in ex]


def column_kinds(df: DataFrame) -> DataFrame:
    """(ordinal, col_name, data_type, kind) for every column — the numeric / categorical split."""
    spark = df.sparkSession
    rows = [
        (i + 1, f.name, f.dataType.simpleString(), "numeric" if isinstance(f.dataType, T.NumericType) else "categorical")
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, "ordinal bigint, col_name string, data_type string, kind string")


# ----------------------------------------------------------------------------- nulls
def drop_null_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop a row from the whole table when any listed column is null (or NaN)."""
    if not cols:
        return df
    cond = F.lit(True)
    for c in cols:
        x = F.col(c)
        bad = x.isNull()
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            bad = bad | F.isnan(x)
        cond = cond & ~bad
    return df.where(cond)


def fit_numeric_fill(df: DataFrame, cols: list[str], strategy: str, nulls: dict[str, int] | None = None,
                     approx: bool = False) -> dict[str, float | None]:
    """Fill value of every column, so nulls that first come at transform are filled too. With
    ``nulls`` (counts measured earlier) only columns that had nulls are fitted."""
    if strategy not in ("mean", "median"):
        raise ValueError("strategy must be 'mean' or 'median'")
    missing = [c for c in cols if nulls is None or nulls.get(c, 0) > 0]
    if not missing:
        return {}
    if strategy == "mean":
        return {c: m["mean"] for c, m in moments(df, missing).items()}
    return medians(df, missing, approx=approx)


def apply_fill(df: DataFrame, fills: dict[str, object], as_double: bool = True, keep_type: list[str] | None = None) -> DataFrame:
    """Nulls (and NaNs) → the fill value; columns become double, those in ``keep_type`` keep their
    type (their fill value is rounded to it)."""
    exprs = []
    for f in df.schema.fields:
        c = f.name
        if c in (keep_type or []) and fills.get(c) is not None:
            x = F.when(~F.isnan(c), F.col(c)) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(c)
            value = round(fills[c]) if isinstance(f.dataType, T.IntegralType) else fills[c]
            exprs.append(F.coalesce(x, F.lit(value).cast(f.dataType)).alias(c))
        elif c in fills and fills[c] is not None:
            x = F.col(c).cast("double") if as_double else F.col(c)
            if as_double and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                x = F.when(F.isnan(x), None).otherwise(x)
            exprs.append(F.coalesce(x, F.lit(fills[c]).cast("double" if as_double else f.dataType)).alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(*exprs)


def impute_numeric(df: DataFrame, cols: list[str], strategy: str = "mean") -> DataFrame:
    """Numeric nulls: 'drop' the row, or fill with the column 'mean' / 'median' (result double)."""
    if strategy == "drop":
        return drop_null_rows(df, cols)
    return apply_fill(df, fit_numeric_fill(df, cols, strategy, null_counts(df, cols)), as_double=True)


def fit_categorical_fill(df: DataFrame, cols: list[str], strategy: str, nulls: dict[str, int] | None = None) -> dict[str, object]:
    """Fill value of every column; with ``nulls`` (counts measured earlier) of those with nulls."""
    missing = [c for c in cols if nulls is None or nulls.get(c, 0) > 0]
    return frequency_extremes(df, missing, "most" if strategy == "most" else "less")


def apply_categorical_fill(df: DataFrame, fills: dict[str, object]) -> DataFrame:
    exprs = []
    for f in df.schema.fields:
        c = f.name
        if c in fills and fills[c] is not None:
            exprs.append(F.coalesce(F.col(c), F.lit(fills[c]).cast(f.dataType)).alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(*exprs)


def impute_categorical(df: DataFrame, cols: list[str], strategy: str = "most") -> DataFrame:
    """Categorical nulls: 'drop' the row, or fill each column with its 'most' / 'less' frequent value."""
    if strategy == "drop":
        return drop_null_rows(df, cols)
    if strategy not in ("most", "less"):
        raise ValueError("strategy must be 'drop', 'most' or 'less'")
    return apply_categorical_fill(df, fit_categorical_fill(df, cols, strategy, null_counts(df, cols)))


# ----------------------------------------------------------------------------- zeros, outliers
def fit_zero_medians(df: DataFrame, cols: list[str], approx: bool = False) -> dict[str, float | None]:
    """Median of the non-zero values of each column."""
    return medians(df, cols, where={c: F.col(c) != 0 for c in cols}, approx=approx)


def apply_zero_replace(df: DataFrame, med: dict[str, float | None]) -> DataFrame:
    exprs = []
    for c in df.columns:
        if c in med and med[c] is not None:
            x = F.col(c).cast("double")
            exprs.append(F.when(x == 0, F.lit(med[c])).otherwise(x).alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(*exprs)


def zeros_to_median(df: DataFrame, cols: list[str]) -> DataFrame:
    """Listed columns: 0 → median of the column's non-zero values."""
    return apply_zero_replace(df, fit_zero_medians(df, cols))


def fit_outliers(df: DataFrame, cols: list[str], strategy: str, approx: bool = False) -> dict[str, dict[str, float]]:
    """Tukey fences (Q1 − 1.5·IQR, Q3 + 1.5·IQR) and the replacement (mean or median, with outliers)."""
    if strategy == "keep" or not cols:
        return {}
    mean: dict = {}
    q = quantiles(df, cols, [0.25, 0.5, 0.75], means=mean, approx=approx)
    out = {}
    for c in cols:
        q1, q2, q3 = q[c]
        if q1 is None:
            continue
        iqr = q3 - q1
        centre = mean[c] if strategy == "mean" else q2
        out[c] = {"lower": q1 - 1.5 * iqr, "upper": q3 + 1.5 * iqr, "centre": centre}
    return out


def apply_outliers(df: DataFrame, fences: dict[str, dict[str, float]]) -> DataFrame:
    exprs = []
    for c in df.columns:
        if c in fences:
            fz = fences[c]
            x = F.col(c).cast("double")
            out = (x < F.lit(fz["lower"])) | (x > F.lit(fz["upper"]))
            exprs.append(F.when(out, F.lit(fz["centre"])).otherwise(x).alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(*exprs)


def treat_outliers(df: DataFrame, cols: list[str], strategy: str = "keep") -> DataFrame:
    """Outliers outside the Tukey fences → column mean / median; 'keep' leaves them."""
    if strategy not in ("keep", "mean", "median"):
        raise ValueError("strategy must be 'keep', 'mean' or 'median'")
    return apply_outliers(df, fit_outliers(df, cols, strategy))


# ----------------------------------------------------------------------------- scaling
def fit_scaler(df: DataFrame, cols: list[str], strategy: str = "standardisation") -> dict[str, tuple[float, float]]:
    """(shift, scale) per column: mean/std_pop or min/(max−min). Zero spread keeps scale 1."""
    mom = moments(df, cols)
    out = {}
    for c, m in mom.items():
        if strategy in ("standardisation", "standard"):
            shift, spread = m["mean"], m["std"]
        elif strategy in ("normalisation", "minmax"):
            shift, spread = m["min"], (None if m["max"] is None else m["max"] - m["min"])
        else:
            raise ValueError("strategy must be 'standardisation' or 'normalisation'")
        out[c] = (shift, spread if spread else 1.0)
    return out


def apply_scaler(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    exprs = []
    for c in df.columns:
        if c in params and params[c][0] is not None:
            shift, spread = params[c]
            exprs.append(((F.col(c).cast("double") - F.lit(shift)) / F.lit(spread)).alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(*exprs)


def standardise(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x − mean) / std_pop; a constant column becomes 0."""
    return apply_scaler(df, fit_scaler(df, cols, "standardisation"))


def minmax_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x − min) / (max − min); a constant column becomes 0."""
    return apply_scaler(df, fit_scaler(df, cols, "normalisation"))


def scale(df: DataFrame, cols: list[str], strategy: str = "standardisation", exclude: list[str] | None = None) -> DataFrame:
    """Scale numeric columns except ``exclude`` (the target is set aside, then kept as is)."""
    ex = set(exclude or [])
    return apply_scaler(df, fit_scaler(df, [c for c in cols if c not in ex], strategy))


# ----------------------------------------------------------------------------- encoding
def fit_levels(df: DataFrame, col: str, limit: int | None = None) -> list | None:
    """Sorted distinct non-null values, or None when there are more than ``limit``."""
    limit = MAX_LITERAL_LEVELS if limit is None else limit
    vals = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).limit(limit + 1).collect()]
    return None if len(vals) > limit else vals


def level_index(col: str, levels: list) -> Column:
    """0-based position of the value in the sorted level list (stays in codegen); NULL if it is not
    in the list, as with any number of levels."""
    at = F.array_position(F.array(*[F.lit(v) for v in levels]), F.col(col)) if levels else F.lit(None)
    return (F.nullif(at, F.lit(0)) - 1).cast("bigint")


def level_codes(df: DataFrame, col: str) -> DataFrame:
    """``(value, code)`` of all distinct values, ranked in Spark: for level lists of any length."""
    from .ranking import exact_row_number

    ranks = exact_row_number(df.select(col).where(F.col(col).isNotNull()).distinct(), [col], out="_rank")
    return ranks.select(F.col(col).alias("value"), (F.col("_rank") - 1).cast("bigint").alias("code"))


def label_encode(df: DataFrame, col: str, out: str | None = None, levels: list | DataFrame | None = None) -> DataFrame:
    """Value → rank in sorted distinct order (0-based, bigint); NULL for a null or unseen value.

    ``levels`` is a fitted level list or a ``level_codes`` table (default: fitted here). Up to
    ``MAX_INLINE_LEVELS`` levels are encoded by a literal array lookup inside the projection, longer
    lists by a broadcast hash join, code tables by a shuffle join; the codes are the same.
    """
    out = out or col
    levels = levels if levels is not None else fit_levels(df, col)
    if isinstance(levels, list) and len(levels) <= MAX_INLINE_LEVELS:
        return df.withColumn(out, level_index(col, levels))
    if isinstance(levels, list):
        dtype = df.schema[col].dataType
        codes = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(levels)], T.StructType(
            [T.StructField("_lv", dtype), T.StructField("_code", T.LongType())]))
        codes = F.broadcast(codes)  # at most MAX_LITERAL_LEVELS rows
    else:
        codes = (levels if levels is not None else level_codes(df, col)).select(F.col("value").alias("_lv"), F.col("code").alias("_code"))
    joined = df.join(codes, F.col(col) == F.col("_lv"), "left")
    return joined.withColumn(out, F.col("_code")).drop("_lv", "_code")


def ordinal_encode(df: DataFrame, cols: list[str]) -> DataFrame:
    """Listed columns → rank code as double (sorted distinct order)."""
    for c in cols:
        df = label_encode(df, c, out=c).withColumn(c, F.col(c).cast("double"))
    return df


def onehot_columns(col: str, levels: list) -> list[Column]:
    return [(F.col(col) == F.lit(v)).cast("double").alias(f"{col}_{v}") for v in levels]


def onehot_encode(df: DataFrame, cols: list[str], levels: dict[str, list] | None = None) -> DataFrame:
    """Each listed column → one 0/1 double column per sorted level, named ``col_level``. The width
    is the number of levels; for columns too wide for that use :func:`onehot_sparse`."""
    levels = dict(levels or {})
    for c in cols:
        if c not in levels:
            levels[c] = [r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().orderBy(c).collect()]
    exprs = []
    for c in df.columns:
        if c in cols:
            exprs += onehot_columns(c, levels[c])
        else:
            exprs.append(F.col(c))
    return df.select(*exprs)


def onehot_sparse(df: DataFrame, cols: list[str], levels: dict[str, list | DataFrame] | None = None) -> DataFrame:
    """Each listed column → ``struct(index, value)``: the one position that is not zero (NULL index
    and 0.0 for a null or unseen value). Any number of levels; rows keep their width."""
    for c in cols:
        df = label_encode(df, c, out=c, levels=(levels or {}).get(c))
        df = df.withColumn(c, F.struct(F.col(c).alias("index"), F.col(c).isNotNull().cast("double").alias("value")))
    return df


def encode_categoricals(df: DataFrame, cols: list[str], ordinal: list[str] | None = None) -> DataFrame:
    """Ordinal encoding for listed columns, one-hot for the other categorical columns."""
    ordinal = [c for c in (ordinal or []) if c in cols]
    df = ordinal_encode(df, ordinal)
    return onehot_encode(df, [c for c in cols if c not in ordinal])


# ----------------------------------------------------------------------------- alignment
def align_columns(left: DataFrame, right: DataFrame, key: str, check_unique: bool = True) -> DataFrame:
    """Column-wise concatenation of two projections of one table, aligned on a row key.

    Inside one job we never split a table, so this join is only needed when two separately
    prepared projections must be put side by side: a full outer equi-join on the key, like an
    index-aligned concat. The key must be unique on both sides (a repeated key would pair its
    rows); ``check_unique`` verifies that with one aggregate per side before joining.
    """
    if check_unique:
        for side, name in ((left, "left"), (right, "right")):
            if side.groupBy(key).count().where(F.col("count") > 1).limit(1).count():
                raise ValueError(f"{name} side has repeated values of {key!r}; alignment needs a unique row key")
    return left.join(right, on=key, how="full_outer")


def features_target(
    df: DataFrame, target: str, features: list[str] | None = None, out: str = "features", keep: list[str] | None = None
) -> DataFrame:
    """Project features (as one array<double>) and the target; ``keep`` columns pass through."""
    keep = list(keep or [])
    feats = features or [c for c in df.columns if c != target and c not in keep]
    return df.select(*keep, F.array(*[F.col(c).cast("double") for c in feats]).alias(out), F.col(target))
