"""Small-side handling shared by operators: bounded tables become plan literals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOCAL_ROWS = 100_000  # small tables up to this size become a local relation (no cache to leak)
BROADCAST_ROWS = 2_000_000  # beyond this a small side is joined with a shuffle


def bounded_side(df: DataFrame, with_rows: bool = False):
    """Materialise a (usually tiny) derived table once and return a join side for it.

    Up to ``LOCAL_ROWS`` rows: collected and rebuilt as a local relation, broadcast — the
    big input that produced it is scanned once and nothing stays cached. Up to
    ``BROADCAST_ROWS``: kept cached and broadcast. Larger: returned as is, for a shuffle join.
    ``with_rows`` also returns the collected rows (or None when the table was too large).
    """
    cached = df.cache()
    rows = cached.limit(LOCAL_ROWS + 1).collect()
    if len(rows) <= LOCAL_ROWS:
        local = df.sparkSession.createDataFrame(rows, df.schema)
        cached.unpersist()
        side = F.broadcast(local)
        return (side, rows) if with_rows else side
    n = cached.count()
    side = F.broadcast(cached) if n <= BROADCAST_ROWS else cached
    return (side, None) if with_rows else side


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner equi-join on ``keys`` where NULL matches NULL (``<=>``), so rows whose group key is
    null (e.g. an unlabelled row) keep their group instead of vanishing. The right side's
    hints (a checked broadcast) are kept."""
    from functools import reduce

    renamed = right.select(*[F.col(k).alias(f"_rk_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_rk_{k}"]) for k in keys])
    return left.join(renamed, cond, "inner").drop(*[f"_rk_{k}" for k in keys])
