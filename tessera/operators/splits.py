"""Repeatable splits, stratified folds, epoch shuffles and mini-batch assignment.

Membership is decided by a seeded hash key ``md5(concat_ws('-', seed, id))`` (with the epoch
for shuffles), ranked exactly within each class by :func:`hash_row_number` — numbered inside
(class, digest-prefix) buckets and shifted by bucket offsets, not a single-task window, so a
class holding a third of the rows is still spread over many tasks. Per-class quotas come from a class-count table (one row per class) that is
broadcast only after its size is checked.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_side, join_null_safe
from .ranking import DEFAULT_HEX_DIGITS, hash_row_number, hex_digits_for, numeric_row_number, ranked_buckets


def resolve_seed(seed: int | None) -> int:
    """``None`` asks for a different split each run (the reference's non-repeatable option)."""
    if seed is None:
        import secrets

        return secrets.randbelow(2**31)
    return int(seed)


def split_key(id_col: str, seed: int, *extra) -> Column:
    parts = [F.lit(str(seed))] + [F.lit(str(e)) for e in extra] + [F.col(id_col).cast("string")]
    return F.md5(F.concat_ws("-", *parts))


def _attach(df: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """Join a small per-class table; broadcast only after its row count is checked."""
    return join_null_safe(df, bounded_side(small), on)


def _quota_table(counts: DataFrame, label: str, frac: float, n_col: str = "n", out: str = "quota") -> DataFrame:
    """Largest-remainder quotas: total ``ceil(frac·N)``, each class ``floor(frac·n)`` plus one
    for the classes with the largest fractional parts (ties → smaller label)."""
    w_all = Window.partitionBy()
    exact = F.lit(float(frac)) * F.col(n_col).cast("double")
    t = (
        counts.withColumn("_exact", exact)
        .withColumn("_base", F.floor(F.col("_exact")).cast("bigint"))
        .withColumn("_rem", F.col("_exact") - F.col("_base"))
        .withColumn("_target", F.ceil(F.lit(float(frac)) * F.sum(F.col(n_col)).over(w_all).cast("double")).cast("bigint"))
        .withColumn("_left", F.col("_target") - F.sum("_base").over(w_all))
        .withColumn("_ord", F.row_number().over(Window.orderBy(F.col("_rem").desc(), F.col(label))))
        .withColumn(out, (F.col("_base") + F.when(F.col("_ord") <= F.col("_left"), 1).otherwise(0)).cast("bigint"))
    )
    return t.drop("_exact", "_base", "_rem", "_target", "_left", "_ord")


def stratified_split(
    df: DataFrame, label: str, id_col: str, test_size: float = 0.2, seed: int = 42, stratify: bool = True, out: str = "set"
) -> DataFrame:
    """Two-way split: ``out`` = 'test' for the first quota rows of each class in hash order.

    ``stratify=False`` ranks all rows together (test = first ``ceil(test_size·n)``).
    """
    if not 0 < test_size < 1:
        raise ValueError("test_size must be in (0, 1)")
    return three_way_split(df, label, id_col, 0.0, test_size, seed, stratify, out)


def three_way_split(
    df: DataFrame,
    label: str,
    id_col: str,
    val_size: float = 0.2,
    test_size: float = 0.2,
    seed: int = 42,
    stratify: bool = True,
    out: str = "set",
) -> DataFrame:
    """Test first (``test_size`` of all rows), then validation from the rest with fraction
    ``val_size / (1 − test_size)``; each quota by largest remainder per class.

    The plan has no exchange of data rows: each row's digest is compared with its class's cut
    digests. Rows that repeat an id share a digest and go to the same set."""
    if not (0 <= val_size < 1 and 0 < test_size < 1 and val_size + test_size < 1):
        raise ValueError("sizes must be fractions with val + test < 1")
    seed = resolve_seed(seed)
    grp = "_g"
    staged = df.withColumn(grp, F.col(label) if stratify else F.lit(0)).withColumn("_key", split_key(id_col, seed))
    # One scan gives the (class, bucket) counts; class sizes are their sums.
    bcounts, digits, counts = ranked_buckets(staged, "_key", [grp])
    q = _quota_table(counts, grp, test_size, out="q_test")
    if val_size > 0:
        q = q.withColumn("n_rest", F.col("n") - F.col("q_test"))
        q = _quota_table(q, grp, val_size / (1.0 - test_size), n_col="n_rest", out="q_val").drop("n_rest")
    else:
        q = q.withColumn("q_val", F.lit(0).cast("bigint"))
    cuts = _cut_keys(staged, bcounts, digits, grp, q.select(grp, F.col("q_test").alias("_c0"), (F.col("q_test") + F.col("q_val")).alias("_c1")))
    res = _attach(staged, cuts, [grp]).withColumn(
        out, F.when(F.col("_key") <= F.col("_k0"), "test").when(F.col("_key") <= F.col("_k1"), "val").otherwise("train")
    )
    return res.drop(grp, "_key", "_k0", "_k1")


def _cut_keys(staged: DataFrame, bcounts: DataFrame, digits: int, grp: str, quotas: DataFrame) -> DataFrame:
    """``(grp, _k0, _k1)``: the digest of the last row of each quota (``_c0``, ``_c1``), null for an
    empty one. Bucket counts tell which digest-prefix bucket holds it; only the digests of those
    buckets (at most two per class) are ranked. The data itself is then compared with the cut,
    without a shuffle."""
    before = F.sum("_cnt").over(Window.partitionBy(grp).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1))
    offsets = bcounts.withColumn("_off", F.coalesce(before, F.lit(0)))
    both = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"_c{i}").alias("c")) for i in (0, 1)])).alias("e")
    edges = join_null_safe(offsets, quotas, [grp]).select(grp, "_bkt", "_off", "_cnt", both).where("e.c > _off AND e.c <= _off + _cnt")
    edges = bounded_side(edges.select(grp, "_bkt", F.col("e.i").alias("_i"), (F.col("e.c") - F.col("_off")).alias("_want")))
    narrow = staged.select(grp, "_key", F.substring("_key", 1, digits).alias("_bkt"))
    inside = join_null_safe(narrow, edges.select(grp, "_bkt").distinct(), [grp, "_bkt"])
    ranked = inside.withColumn("_rn", F.row_number().over(Window.partitionBy(grp, "_bkt").orderBy("_key")))
    hits = join_null_safe(ranked, edges, [grp, "_bkt"]).where("_rn = _want")
    found = hits.groupBy(grp).agg(*[F.max(F.when(F.col("_i") == i, F.col("_key"))).alias(f"_k{i}") for i in (0, 1)])
    # a class whose quotas are both empty has no cut: all its rows come after
    none = [F.lit(None).cast("string").alias(f"_k{i}") for i in (0, 1)]
    return found.unionByName(quotas.where("_c1 = 0").select(grp, *none))


def split_uniform(id_col: str, seed: int, *extra) -> Column:
    """A seeded uniform number in [0, 1) per row: the first 13 hex digits (52 bits, exact in a
    double) of the split digest."""
    return F.conv(F.substring(split_key(id_col, seed, *extra), 1, 13), 16, 10).cast("double") / float(16**13)


def hash_split(df: DataFrame, id_col: str, val_size: float, test_size: float, seed: int | None = 42, out: str = "set") -> DataFrame:
    """Approximate split with no shuffle at all: threshold a seeded uniform per row (expected,
    not exact, fractions) — the scale path when exact quotas are not needed."""
    u = split_uniform(id_col, resolve_seed(seed))
    return df.withColumn(out, F.when(u < test_size, "test").when(u < test_size + val_size, "val").otherwise("train"))


def kfold(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int | None = 42, out: str = "fold",
          shuffle: bool = True, place: str | None = None) -> DataFrame:
    """Stratified k folds: ``(offset(label) + rank − 1) % k`` with ``offset`` = rows of smaller
    labels, so every fold holds a near-equal share of every class and totals differ by ≤ 1.
    ``place`` names a column for a row's 0-based position within its fold (see :func:`fold_batches`).

    Rows are ranked within their class by the seeded hash (``shuffle=True``) or by ``id_col``
    (``shuffle=False``: folds follow the stored order)."""
    if k < 2:
        raise ValueError("k must be at least 2")
    if shuffle:
        staged = df.withColumn("_key", split_key(id_col, resolve_seed(seed)))
        bcounts, digits, counts = ranked_buckets(staged, "_key", [label])
    else:
        counts = bounded_side(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")))
    offs = counts.withColumn(
        "_off",
        F.coalesce(F.sum("n").over(Window.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).select(label, "_off")
    if shuffle:
        ranked = hash_row_number(staged, "_key", id_col, [label], out="_rn", hex_digits=digits, counts=bcounts).drop("_key")
    else:
        ranked = numeric_row_number(df, id_col, [label], out="_rn")
    joined = _attach(ranked, offs, [label])
    at = (F.col("_off") + F.col("_rn") - 1).cast("bigint")
    if place is not None:
        joined = joined.withColumn(place, quotient(at, k))
    return joined.withColumn(out, at % k).drop("_off", "_rn")


def quotient(x: Column, n: int) -> Column:
    """Whole-number division of a non-negative bigint, exact at any size."""
    return ((x - x % n) / n).cast("bigint")


def epoch_order(df: DataFrame, id_col: str, seed: int, epoch: int, out: str = "pos", n_rows: int | None = None) -> DataFrame:
    """A fresh permutation per epoch: 1-based position in ``md5(seed-epoch-id)`` order."""
    staged = df.withColumn("_key", split_key(id_col, seed, epoch))
    if n_rows is not None:
        digits = max(DEFAULT_HEX_DIGITS, hex_digits_for(n_rows))
        return hash_row_number(staged, "_key", id_col, out=out, hex_digits=digits).drop("_key")
    bcounts, digits, _ = ranked_buckets(staged, "_key", [])
    return hash_row_number(staged, "_key", id_col, out=out, hex_digits=digits, counts=bcounts).drop("_key")


def assign_batches(df: DataFrame, id_col: str, seed: int, epoch: int, batch_size: int, out: str = "batch",
                   n_rows: int | None = None) -> DataFrame:
    """Consecutive slices of the epoch order; the last short batch is kept."""
    ordered = epoch_order(df, id_col, seed, epoch, out="_pos", n_rows=n_rows)
    return ordered.withColumn(out, ((F.col("_pos") - 1) / F.lit(batch_size)).cast("bigint")).drop("_pos")


FEISTEL_ROUNDS = 6
MAX_WALK = 64


def dense_positions(df: DataFrame, id_col: str, out: str = "at") -> DataFrame:
    """0-based position in id order: numbered once, permuted by :func:`keyed_order` for every epoch."""
    return numeric_row_number(df, id_col, out=out).withColumn(out, (F.col(out) - 1).cast("bigint"))


def feistel_sides(n_rows: int) -> tuple[int, int]:
    """The smallest near-square ``a * b`` that holds ``n_rows`` positions."""
    a = max(1, math.isqrt(max(0, n_rows - 1)) + 1)
    return a, max(1, -(-n_rows // a))


def keyed_order(at: str, n_rows: int, seed: int, epoch: int) -> Column:
    """A fresh permutation of 0 .. ``n_rows - 1`` per seed and epoch, as an expression of a dense position.

    A keyed Feistel network over ``a * b >= n_rows`` cells: in turn, the row of a cell moves by a digest
    of its column and the column by a digest of its row, which any key leaves reversible. A cell
    beyond the rows walks on until it lands inside. Fewer than ``a`` cells lie outside, so a walk
    ends within ``MAX_WALK`` steps up to 4,096 rows, and beyond that practically always; one that
    does not raises an error. No row moves: epochs need no shuffle.
    """
    a, b = feistel_sides(n_rows)

    def digest(i, x):
        text = F.concat_ws("-", F.lit(str(seed)), F.lit(str(epoch)), i.cast("string"), x.cast("string"))
        return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")

    def turn(s, i):
        by_row = i % 2 == 0
        return F.struct(
            F.when(by_row, (s["r"] + digest(i, s["c"])) % a).otherwise(s["r"]).alias("r"),
            F.when(by_row, s["c"]).otherwise((s["c"] + digest(i, s["r"])) % b).alias("c"),
        )

    def walk(x):
        begin = F.struct(F.floor(x / b).cast("bigint").alias("r"), (x % b).alias("c"))
        rounds = F.sequence(F.lit(0), F.lit(FEISTEL_ROUNDS - 1))
        return F.aggregate(rounds, begin, turn, lambda s: s["r"] * b + s["c"])

    # the first step is taken from the position itself, the others only by cells outside
    first = walk(F.col(at).cast("bigint"))
    landed = F.aggregate(F.sequence(F.lit(1), F.lit(min(MAX_WALK, a))), first, lambda x, _: F.when(x < n_rows, x).otherwise(walk(x)))
    return F.when(landed < n_rows, landed).otherwise(F.raise_error(F.lit("a walk of the epoch order did not end")).cast("bigint"))


def keyed_batches(at: str, n_rows: int, seed: int, epoch: int, batch_size: int) -> Column:
    """Batch of a dense position in the keyed epoch order; the last short batch is kept."""
    return F.floor(keyed_order(at, n_rows, seed, epoch) / F.lit(batch_size)).cast("bigint")


def fold_sizes(n_rows: int, k: int) -> list[int]:
    """Rows per fold of :func:`kfold` over ``n_rows`` rows."""
    return [(n_rows - r + k - 1) // k for r in range(k)]


def fold_batch_count(n_rows: int, k: int, batch_size: int | None, batches: int | None) -> int:
    """Batches per epoch of :func:`fold_batches`."""
    if batches is not None or batch_size is None:
        return max(1, min(batches or 1, n_rows // k))
    return max(1, -(-max(fold_sizes(n_rows, k)) * (k - 1) // batch_size))


def fold_batches(fold: str, place: str, n_rows: int, k: int, seed: int, epoch: int, batch_size: int | None = None,
                 batches: int | None = None) -> Column:
    """One mini-batch number per row that serves the training sets of all ``k`` folds at once.

    Every fold's rows are put into a keyed order of their own (:func:`keyed_order` of the place within
    the fold) and cut alike, so a batch holds the same number of rows of each fold. Leaving one fold
    out leaves ``batch_size`` rows, exactly where ``k - 1`` divides it and to within a row per fold
    elsewhere; the last batch may be short. ``batches`` asks for so many near-equal batches instead.
    A map-only expression: no row moves between epochs, and no fold has a copy of the rows.
    """
    count = fold_batch_count(n_rows, k, batch_size, batches)
    out = F.lit(0).cast("bigint")
    if count == 1:
        return out
    for r, size in enumerate(fold_sizes(n_rows, k)):
        if size == 0:
            continue
        pos = keyed_order(place, size, seed, epoch * k + r)
        by_count = batches is not None or batch_size is None
        batch = quotient(pos * count, size) if by_count else quotient(pos * (k - 1), batch_size)
        out = F.when(F.col(fold) == r, batch).otherwise(out)
    return out


def hash_batches(df: DataFrame, id_col: str, seed: int, epoch: int, n_batches: int, out: str = "batch") -> DataFrame:
    """Scale path for mini-batches: batch = floor(u · n_batches) for a seeded per-epoch uniform u;
    no shuffle, batch sizes equal only in expectation."""
    return df.withColumn(out, F.floor(split_uniform(id_col, seed, epoch) * n_batches).cast("bigint"))


def label_onehot(label_col: str, n_classes: int) -> Column:
    """Integer label → array<double> of width ``n_classes`` (fixed from the whole data)."""
    return F.transform(F.sequence(F.lit(0), F.lit(n_classes - 1)), lambda k: F.when(k == F.col(label_col), 1.0).otherwise(0.0))
