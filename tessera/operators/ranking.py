"""Exact row numbers without a single-task window.

``row_number() over (partition by g order by k)`` puts every row of a group in one task, and
an unpartitioned ``row_number()`` puts the whole table in one task. With few groups (class
labels) or one hot group that does not scale. Two exact, deterministic plans instead:

* **Hash-ordered keys** (splits, folds, epoch shuffles order by an md5 hex digest): the first
  ``L`` hex digits of the digest form a bucket that is monotone in the sort order. Rows are
  numbered inside each (group, bucket) by a window — a hot group is spread over 16^L buckets —
  and a small (group, bucket) count table, turned into offsets by a window over that table
  and broadcast after a size check, shifts them to the group-wide number.
* **One numeric key** (ids, integer labels): value-range buckets from approximate quantiles
  (MLlib ``Bucketizer``), the same window-per-bucket + offsets plan, no checkpoint.
* **Any other order**: a range partitioning on (group, keys) and a sort within partitions;
  each row's in-partition position (``monotonically_increasing_id``) plus the count of the
  group's rows in earlier partitions is its number. Range bounds come from sampling, so the
  sorted data is cut from its lineage with ``checkpoint()`` (reliable, in the shared
  checkpoint folder): the counted partitions and the numbered ones are the same even if an
  executor is lost.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, shuffle_partitions
from .common import bounded_side, join_null_safe

DEFAULT_HEX_DIGITS = 3  # 4096 buckets per group


def _stage_order(df: DataFrame, order_by: list):
    order_cols, staged = [], df
    for i, o in enumerate(order_by):
        if isinstance(o, str):
            order_cols.append(o)
        else:
            name = f"_ord{i}"
            staged = staged.withColumn(name, o)
            order_cols.append(name)
    return staged, order_cols


def _attach_offsets(df: DataFrame, offsets: DataFrame, keys: list[str]) -> DataFrame:
    return join_null_safe(df, bounded_side(offsets), keys)


def bucket_counts(df: DataFrame, hex_col: str, partition_by: list[str] | None = None, hex_digits: int = DEFAULT_HEX_DIGITS,
                  with_rows: bool = False):
    """Rows per (group, digest-prefix bucket): one aggregate over the data, materialised as a
    bounded join side. Summing it over buckets gives the group sizes without another scan."""
    partition_by = list(partition_by or [])
    b = df.groupBy(*partition_by, F.substring(F.col(hex_col), 1, hex_digits).alias("_bkt")).agg(
        F.count(F.lit(1)).alias("_cnt")
    )
    return bounded_side(b, with_rows=with_rows)


def hash_row_number(
    df: DataFrame,
    hex_key,
    tie_breaker: str,
    partition_by: list[str] | None = None,
    out: str = "rn",
    hex_digits: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Row number ordered by (``hex_key``, ``tie_breaker``) within ``partition_by``, where
    ``hex_key`` is a lowercase hex digest (uniformly distributed). ``counts`` may carry the
    :func:`bucket_counts` table already computed with the same digits."""
    partition_by = list(partition_by or [])
    L = hex_digits or DEFAULT_HEX_DIGITS
    staged, (kcol,) = _stage_order(df, [hex_key])
    staged = staged.withColumn("_bkt", F.substring(F.col(kcol), 1, L))
    grp = partition_by + ["_bkt"]
    if counts is None:
        counts = bucket_counts(staged, kcol, partition_by, L)
    w_off = (Window.partitionBy(*partition_by) if partition_by else Window.partitionBy()).orderBy("_bkt")
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_cnt").over(w_off.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select(*grp, "_off")
    local = staged.withColumn("_loc", F.row_number().over(Window.partitionBy(*grp).orderBy(kcol, tie_breaker)))
    res = _attach_offsets(local, offsets, grp)
    res = res.withColumn(out, (F.col("_off") + F.col("_loc")).cast("bigint"))
    drop = ["_bkt", "_off", "_loc"] + ([kcol] if kcol.startswith("_ord") else [])
    return res.drop(*drop)


def exact_row_number(
    df: DataFrame,
    order_by: list,
    partition_by: list[str] | None = None,
    out: str = "rn",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = 1-based row number within ``partition_by`` ordered by ``order_by``.

    ``order_by`` must make the order total (end it with a unique id), exactly as a
    deterministic ``row_number`` needs. Columns may be names or Column expressions; all sort
    ascending.
    """
    partition_by = list(partition_by or [])
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n_parts = num_partitions or shuffle_partitions(spark)
    staged, order_cols = _stage_order(df, order_by)
    keys = partition_by + order_cols
    ranged = staged.repartitionByRange(n_parts, *keys).sortWithinPartitions(*keys)
    tagged = ranged.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.checkpoint(eager=True)

    counts = tagged.groupBy("_pid", *partition_by).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    w = Window.partitionBy(*partition_by).orderBy("_pid") if partition_by else Window.orderBy("_pid")
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select("_pid", *partition_by, "_off", "_first")
    joined = _attach_offsets(tagged, offsets, ["_pid", *partition_by])
    res = joined.withColumn(out, (F.col("_off") + F.col("_mid") - F.col("_first") + 1).cast("bigint"))
    drop = ["_pid", "_mid", "_off", "_first"] + [c for c in order_cols if c.startswith("_ord")]
    return res.drop(*drop)


TARGET_BUCKET_ROWS = 2_000_000


def hex_digits_for(n_rows: int, target_per_bucket: int = TARGET_BUCKET_ROWS) -> int:
    """Hex digits so that a group of ``n_rows`` is split into buckets of ≲ target rows."""
    if n_rows <= target_per_bucket:
        return 1
    return max(1, min(8, math.ceil(math.log(n_rows / target_per_bucket, 16))))


def ranked_buckets(df: DataFrame, hex_col: str, partition_by: list[str]):
    """Bucket counts at the default digits (one scan), refined only when the largest group
    would leave buckets above the target size. Returns (counts, digits, group sizes)."""
    L = DEFAULT_HEX_DIGITS
    counts, rows = bucket_counts(df, hex_col, partition_by, L, with_rows=True)
    sizes = counts.groupBy(*partition_by).agg(F.sum("_cnt").alias("n")) if partition_by else counts.agg(F.sum("_cnt").alias("n"))
    if rows is not None:  # the bounded count table is already on the driver
        per: dict = {}
        for r in rows:
            k = tuple(r[c] for c in partition_by)
            per[k] = per.get(k, 0) + r["_cnt"]
        biggest = max(per.values(), default=0)
    else:
        biggest = sizes.agg(F.max("n")).first()[0] or 0
    need = hex_digits_for(biggest)
    if need > L:
        L = need
        counts = bucket_counts(df, hex_col, partition_by, L)
    return counts, L, sizes


def numeric_row_number(
    df: DataFrame,
    key: str,
    partition_by: list[str] | None = None,
    out: str = "rn",
    tie_breaker: str | None = None,
    n_rows: int | None = None,
) -> DataFrame:
    """Row number ordered by one numeric ``key`` (then ``tie_breaker``) within ``partition_by``,
    without a checkpoint: value-range buckets from approximate quantiles of the key (any
    boundaries give the exact answer; good ones only balance the work), a window inside each
    (group, bucket), and offsets from the small (group, bucket) count table. A group holding
    a third of the rows is spread over many buckets as long as its keys differ."""
    from pyspark.ml.feature import Bucketizer

    partition_by = list(partition_by or [])
    n = n_rows if n_rows is not None else df.count()
    n_buckets = max(1, min(1 << 16, math.ceil(n / TARGET_BUCKET_ROWS) * 16))
    kd = "_kd"
    staged = df.withColumn(kd, F.col(key).cast("double"))
    if n_buckets > 1:
        probs = [i / n_buckets for i in range(1, n_buckets)]
        bounds = staged.agg(F.percentile_approx(kd, probs, max(10_000, 10 * n_buckets))).first()[0] or []
        splits = [-float("inf")] + sorted(set(float(b) for b in bounds)) + [float("inf")]
    else:
        splits = [-float("inf"), float("inf")]
    staged = Bucketizer(splits=splits, inputCol=kd, outputCol="_bkt", handleInvalid="keep").transform(staged)
    grp = partition_by + ["_bkt"]
    counts = bounded_side(staged.groupBy(*grp).agg(F.count(F.lit(1)).alias("_cnt")))
    w_off = (Window.partitionBy(*partition_by) if partition_by else Window.partitionBy()).orderBy("_bkt")
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_cnt").over(w_off.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select(*grp, "_off")
    order = [key] + ([tie_breaker] if tie_breaker else [])
    local = staged.withColumn("_loc", F.row_number().over(Window.partitionBy(*grp).orderBy(*order)))
    res = _attach_offsets(local, offsets, grp)
    return res.withColumn(out, (F.col("_off") + F.col("_loc")).cast("bigint")).drop("_bkt", "_off", "_loc", kd)
