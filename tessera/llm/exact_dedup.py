"""Exact duplicates by composable polynomial fingerprints.

The fingerprint of bytes ``b0 .. bn-1`` is ``sum(b_i * r**(n-1-i)) mod (2**61 - 1)``. Fingerprints
compose: ``F(x + y) = F(x) * r**len(y) + F(y)``. A text longer than one chunk becomes one row per
chunk, dealt to all tasks and hashed in parallel; each chunk's fingerprint is shifted by the length
behind it and the shifted terms are summed, which commutes, so the partial sums of the shuffle do
the combining. Rows equal in fingerprint and length are then compared chunk by chunk with their
group's chosen row, so no decision rests on a hash alone: a row that differs moves on to the next
round, where the rows that still differ choose a row of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, prepare, scratch, text_hash, text_or_empty, with_row_key

P = (1 << 61) - 1
RADIX = 1_152_921_504_606_846_883  # a fixed radix below P
CHUNK = 1 << 16  # bytes of a chunk
HALF = (1 << 30) - 1


def _mul(a, b):
    """a * b mod 2**61 - 1 on uint64 arrays with operands below 2**61."""
    u = np.uint64
    a, b = np.asarray(a, u), np.asarray(b, u)
    al, ah, bl, bh = a & u(0xFFFFFFFF), a >> u(32), b & u(0xFFFFFFFF), b >> u(32)
    low, mid, high = al * bl, al * bh + ah * bl, ah * bh
    total = (low & u(P)) + (low >> u(61)) + (high << u(3)) + (mid >> u(29)) + ((mid & u((1 << 29) - 1)) << u(32))
    total = (total & u(P)) + (total >> u(61))
    return np.where(total >= P, total - u(P), total)


def _powers(n: int) -> np.ndarray:
    """RADIX**(n-1) .. RADIX**0, by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([_mul(out, np.uint64(pow(RADIX, len(out), P))), out])
    return out[len(out) - n :]


_TABLE: list[np.ndarray] = []


def chunk_fingerprint(data: bytes) -> int:
    """Polynomial fingerprint of up to ``CHUNK`` bytes; the powers are split so sums fit 64 bits."""
    if not _TABLE:
        w = _powers(CHUNK)
        _TABLE.extend([w & np.uint64(HALF), w >> np.uint64(30)])
    b = np.frombuffer(data, np.uint8).astype(np.uint64)
    low, high = (int((b * w[CHUNK - len(b) :]).sum()) for w in _TABLE)  # each below 2**55
    return (low + (high << 30)) % P


def combine(left: int, right: int, right_length: int) -> int:
    """Fingerprint of two adjoining pieces."""
    return (left * pow(RADIX, right_length, P) + right) % P


def _cut(rows: DataFrame) -> DataFrame:
    """``rows`` (.., _text) as one row per chunk: ``size`` (bytes of the text), ``part``, ``data``."""
    data = rows.withColumn("data", F.encode("_text", "UTF-8")).drop("_text").withColumn("size", F.octet_length("data").cast("long"))
    last = F.greatest(F.lit(0), F.ceil(F.col("size") / F.lit(CHUNK)).cast("int") - 1)
    parts = data.withColumn("part", F.explode(F.sequence(F.lit(0), last)))
    return parts.withColumn("data", F.expr(f"substring(data, part * {CHUNK} + 1, {CHUNK})"))


def fingerprint_rows(rows: DataFrame) -> DataFrame:
    """``(ROW, sha, size, fp)`` for every row of ``rows`` (ROW, sha, _text)."""

    def run(batches):
        for b in batches:
            terms = []
            for n, k, d in zip(*[b.column(c).to_pylist() for c in (4, 5, 6)]):
                terms.append(combine(chunk_fingerprint(d), 0, n - k * CHUNK - len(d)))
            # 30-bit halves, so that their sums stay within a long
            halves = [pa.array([t & HALF for t in terms], pa.int64()), pa.array([t >> 30 for t in terms], pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns[:6], *halves], names=[*ROW, "sha", "size", "part", "low", "high"])

    schema = "_row_id long, _row_null boolean, _row_hash long, sha string, size long, part int, low long, high long"
    order = [*ROW, "sha", "size", "part", "data"]
    long_text = F.octet_length("_text") > CHUNK
    short = _cut(rows.where(~long_text)).select(*order).mapInArrow(run, schema)
    parts = _cut(rows.where(long_text)).select(*order).repartition(*ROW, "part").mapInArrow(run, schema)
    key = [*ROW, "sha", "size"]
    # repeated rows (equal id and text) share their chunks: combine once, return as many rows
    once = parts.groupBy(*key, "part").agg(F.max("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("copies"))
    whole = once.groupBy(*key).agg(F.sum("low").alias("low"), F.sum("high").alias("high"), F.max("copies").alias("copies"))
    joined = whole.withColumn("copy", F.explode(F.expr("sequence(1, copies)"))).select(*key, "low", "high")
    fp = f"CAST((CAST(high AS DECIMAL(20,0)) * {1 << 30} + low) % {P} AS BIGINT) AS fp"
    return short.select(*key, "low", "high").unionByName(joined).selectExpr(*key, fp)


HOT_SHARE = 1_000  # a group with one in so many rows is hot: there are at most as many of them
SALTS = 64  # tasks that a hot group's chunks are dealt to


def _hot_limit(fps: DataFrame) -> int:
    """Rows from which a group counts as hot."""
    return max(HOT_SHARE, fps.count() // HOT_SHARE)


def _join_groups(rows: DataFrame, groups: DataFrame, key: list[str], n_col: str, limit: int, how: str) -> DataFrame:
    """Join rows with one row per group: hot groups, at most ``HOT_SHARE``, by broadcast, so that no task
    gets all rows of one; the others by shuffle."""
    hot, cold = F.broadcast(groups.where(F.col(n_col) >= limit)), groups.where(F.col(n_col) < limit)
    return rows.join(hot, key, how).unionByName(rows.join(hot.select(*key), key, "left_anti").join(cold, key, how))


def _salted(rows: DataFrame, hot: DataFrame, salt) -> DataFrame:
    """``rows`` with ``salt`` where their group is hot, 0 elsewhere."""
    marked = rows.join(F.broadcast(hot.select("fp", "size", F.lit(True).alias("_hot"))), ["fp", "size"], "left")
    return marked.withColumn("salt", F.when(F.col("_hot"), salt).otherwise(F.lit(0))).drop("_hot")


def _settle(rows: DataFrame, members: DataFrame, hot: DataFrame) -> DataFrame | None:
    """Compare the rows of each (fp, size) group with its chosen row, chunk by chunk; ``hot`` has the
    groups whose chunks are dealt to ``SALTS`` tasks, each with the chosen row's.

    Returns ``(ROW, size, fp, level)`` of the rows that are not equal to their group's first chosen
    row, ``level`` 1 and up by round; None if there are none (no collision).
    """
    texts = rows.select(*ROW, "_text").join(members.select(*ROW, "fp").distinct(), ROW)
    chunks = scratch(_salted(_cut(texts), hot, F.pmod(F.xxhash64(*ROW), F.lit(SALTS)).cast("int")), "copies")
    todo, moved, level = members.select(*ROW, "size", "fp").distinct(), None, 0
    while True:
        chosen = todo.groupBy("fp", "size").agg(F.max(F.struct(~F.col("_row_null"), *ROW)).alias("k")).select("fp", "size", *[F.col(f"k.{c}").alias(c) for c in ROW])
        mine = chunks if not level else chunks.join(todo, [*ROW, "size", "fp"], "left_semi")
        model = chunks.join(chosen, [*ROW, "size", "fp"], "left_semi").groupBy("fp", "size", "part").agg(F.max("data").alias("model"))
        copies = _salted(model, hot, F.lit(SALTS)).withColumn("salt", F.explode(F.expr("sequence(0, greatest(salt - 1, 0))")))
        same = mine.join(copies, ["fp", "size", "part", "salt"]).groupBy(*ROW, "size", "fp").agg(F.bool_and(F.col("data") == F.col("model")).alias("same"))
        todo = scratch(same.where("NOT same").select(*ROW, "size", "fp"), "differing")
        if todo.isEmpty():
            return moved
        level += 1
        step = todo.withColumn("level", F.lit(level))
        moved = step if moved is None else moved.join(todo, [*ROW, "size", "fp"], "left_anti").unionByName(step)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, keep_id, group_size, kept, text_sha256)`` for every input row.

    Texts are equal when their bytes are; a null text counts as empty. The largest id of a group
    stays; null ids stay only in a group without others (``keep_id`` null). Rows equal in id and
    text are one document: they carry the same values, and ``group_size`` counts each of them. An
    empty table gives an empty one; other columns are not read.
    """
    prepare(docs.sparkSession)
    rows = with_row_key(docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text")), "_id", text_hash("_text")).drop("_id").withColumn("sha", F.sha2(F.col("_text"), 256))
    fps = scratch(fingerprint_rows(rows.select(*ROW, "sha", "_text")), "fingerprints")
    limit = _hot_limit(fps)
    groups = scratch(fps.groupBy("fp", "size").agg(F.count("*").alias("n")).where("n > 1"), "groups")
    moved = _settle(rows, _join_groups(fps, groups, ["fp", "size"], "n", limit, "left_semi"), groups.where(F.col("n") >= limit))
    if moved is None:
        placed = fps.withColumn("level", F.lit(0))
    else:
        placed = fps.join(moved, [*ROW, "size", "fp"], "left").withColumn("level", F.coalesce("level", F.lit(0)))
    key = ["fp", "size", "level"]
    real = F.when(~F.col("_row_null"), F.col("_row_id"))
    best = scratch(placed.groupBy(*key).agg(F.max(real).alias("keep_id"), F.count("*").alias("group_size")), "groups")
    return _join_groups(placed, best, key, "group_size", limit, "inner").select(real.alias("id"), "keep_id", "group_size", real.eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))
