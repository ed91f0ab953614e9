"""Column statistics computed as distributed aggregates.

Every statistic is one aggregate job with map-side partial aggregation; only scalars (or a
bounded list of counts) reach the driver. Exact quantiles are selected between two values of a
mergeable sketch, so no task ever holds all distinct values of a column, which Spark's built-in
exact ``percentile`` would do on a global aggregate.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SELECT_BINS = 8_192  # values of a bracket that exact selection collects
SELECT_PARTS = 400  # even steps at which a sketch is asked
SKETCH_SIZE = 4_000  # values of a sketch's largest level
SKETCH_ERROR = 0.002  # of the ranks; more is rare, found out and searched again
MERGERS = 64  # tasks that merge the sketches of all others
BRACKETS = 128  # brackets counted in a scan
APPROX_ACCURACY = 20_000


def _finite(c: str):
    """The column as double with NaN read as missing (pandas skips both)."""
    x = F.col(c).cast("double")
    return F.nanvl(x, F.lit(None).cast("double"))


def moments(df: DataFrame, cols: list[str]) -> dict[str, dict[str, float | None]]:
    """mean, population std, min, max and non-null count for each column, in one pass."""
    if not cols:
        return {}
    aggs = []
    for i, c in enumerate(cols):
        x = _finite(c)
        aggs += [
            F.avg(x).alias(f"m{i}"),
            F.stddev_pop(x).alias(f"s{i}"),
            F.min(x).alias(f"lo{i}"),
            F.max(x).alias(f"hi{i}"),
            F.count(x).alias(f"n{i}"),
        ]
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *aggs).first()
    return {
        c: {
            "mean": row[f"m{i}"],
            "std": row[f"s{i}"],
            "min": row[f"lo{i}"],
            "max": row[f"hi{i}"],
            "n": row[f"n{i}"],
            "rows": row["_rows"],
        }
        for i, c in enumerate(cols)
    }


def null_counts(df: DataFrame, cols: list[str]) -> dict[str, int]:
    """Nulls (and NaNs for floating columns) per column, in one pass."""
    if not cols:
        return {}
    from pyspark.sql import types as T

    aggs = []
    for i, c in enumerate(cols):
        bad = F.col(c).isNull()
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            bad = bad | F.isnan(F.col(c))
        aggs.append(F.count_if(bad).alias(f"z{i}"))
    row = df.agg(*aggs).first()
    return {c: int(row[f"z{i}"]) for i, c in enumerate(cols)}


@dataclass
class ColumnProfile:
    """What one scan tells about a numeric column; ``grid`` has approximate quantiles at even steps."""

    n: int
    low: float | None
    high: float | None
    grid: list[float]


def _scan(df: DataFrame):
    """The one place where selection reads the data: an aggregate of bounded size, collected."""
    return df.collect()


def _grid(sketch, parts: int):
    """Quantiles of a sketch at ``parts`` even steps; the ends are the smallest and largest value."""
    steps = F.array(*[F.lit(i / parts) for i in range(parts + 1)])
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, steps))


def profile_columns(df: DataFrame, values: dict[str, object], counted: dict[str, object] | None = None, parts: int = SELECT_PARTS) -> tuple[dict[str, ColumnProfile], dict[str, tuple[int, float | None]], int]:
    """One scan over expressions by name: their profiles, count and mean of the expressions in
    ``counted`` (default: ``values``), and the number of rows.

    Sketches are merged in two levels, so that no task merges those of all tasks.
    """
    counted = values if counted is None else counted
    aggs = [F.count(F.lit(1)).alias("_rows")]
    merge = [F.sum("_rows").alias("_rows")]
    for i, x in enumerate(values.values()):
        aggs.append(F.kll_sketch_agg_double(x, F.lit(SKETCH_SIZE)).alias(f"_k{i}"))
        merge.append(F.kll_merge_agg_double(f"_k{i}").alias(f"_k{i}"))
    for i, x in enumerate(counted.values()):
        aggs += [F.count(x).alias(f"_n{i}"), F.sum(x).alias(f"_s{i}")]
        merge += [F.sum(f"_n{i}").alias(f"_n{i}"), F.sum(f"_s{i}").alias(f"_s{i}")]
    some = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("_part")).agg(*aggs).agg(*merge)
    grids = [F.struct(F.kll_sketch_get_n_double(f"_k{i}").alias("n"), _grid(F.col(f"_k{i}"), parts).alias("q")).alias(f"_q{i}") for i in range(len(values))]
    row = _scan(some.select("_rows", *grids, *[f"_{k}{i}" for i in range(len(counted)) for k in "ns"]))[0]
    means = {c: (row[f"_n{i}"] or 0, row[f"_s{i}"] / row[f"_n{i}"] if row[f"_n{i}"] else None) for i, c in enumerate(counted)}
    profiles = {}
    for i, c in enumerate(values):
        q = list(row[f"_q{i}"]["q"] or [])
        profiles[c] = ColumnProfile(row[f"_q{i}"]["n"] or 0, q[0] if q else None, q[-1] if q else None, q)
    return profiles, means, row["_rows"] or 0


@dataclass
class _Bracket:
    """Ranks of a column known to lie in ``low`` .. ``high``."""

    column: str
    low: float
    high: float
    ranks: set[int]


def _brackets(c: str, low: float, high: float, grid: list[float], n: int, ranks: dict[int, float]) -> list[_Bracket]:
    """The parts of ``low`` .. ``high`` that hold the ranks; ``ranks`` has their places among ``n`` values."""
    parts = len(grid) - 1
    slack = 1 + math.ceil(parts * SKETCH_ERROR)
    out: dict[tuple[float, float], _Bracket] = {}
    for r, place in ranks.items():
        at = place * parts / max(1, n - 1)
        i, j = math.floor(at) - slack, math.ceil(at) + slack
        ends = grid[i] if i >= 0 else low, grid[j] if j <= parts else high
        out.setdefault(ends, _Bracket(c, *ends, set())).ranks.add(r)
    return list(out.values())


def _inside(x, b: _Bracket):
    return (x > F.lit(b.low)) & (x < F.lit(b.high))


def select_ranks(df: DataFrame, values: dict[str, object], profiles: dict[str, ColumnProfile], ranks: dict[str, set[int]], bins: int = SELECT_BINS, parts: int = SELECT_PARTS) -> dict[str, dict[int, float]]:
    """Exact order statistics (rank 0 is the smallest value) of profiled columns.

    The profile's sketch brackets each rank between two values of the data. One scan counts the rows
    below and at the ends exactly, which settles ranks at the ends and shows a bracket that missed.
    One more collects the values strictly inside the others; a bracket with more than ``bins`` values
    is sketched instead, and narrowed again. A bracket holds about a hundredth of the rows, of any
    distribution, and each further sketch takes a hundredth of that.
    """
    found: dict[str, dict[int, float]] = {c: {} for c in ranks}
    todo: list[_Bracket] = []
    for c, wanted in ranks.items():
        if wanted:
            p = profiles[c]
            todo += _brackets(c, p.low, p.high, p.grid, p.n, {r: r for r in wanted})
    while todo:
        now, todo = todo[:BRACKETS], todo[BRACKETS:]
        ends = list(dict.fromkeys((b.column, v) for b in now for v in (b.low, b.high)))
        below = [F.count_if(values[c] < F.lit(v)).alias(f"b{k}") for k, (c, v) in enumerate(ends)]
        row = _scan(df.agg(*below, *[F.count_if(values[c] == F.lit(v)).alias(f"e{k}") for k, (c, v) in enumerate(ends)]))[0]
        rows_below = {end: row[f"b{k}"] for k, end in enumerate(ends)}
        rows_to = {end: row[f"b{k}"] + row[f"e{k}"] for k, end in enumerate(ends)}
        few, many = [], []
        for b in now:
            p, low, high = profiles[b.column], (b.column, b.low), (b.column, b.high)
            first, last = rows_to[low], rows_below[high]  # ranks strictly inside
            inner = {r for r in b.ranks if first <= r < last}
            for r in b.ranks - inner:
                if rows_below[low] <= r < first:
                    found[b.column][r] = float(b.low)
                elif last <= r < rows_to[high]:
                    found[b.column][r] = float(b.high)
                else:  # the sketch missed: look on that side of the bracket
                    side = (p.low, b.low) if r < first else (b.high, p.high)
                    many.append((_Bracket(b.column, *side, {r}), *((rows_to[low], 0) if r < first else (p.n, rows_below[high]))))
            if inner:
                found_in = _Bracket(b.column, b.low, b.high, inner), last - first, first
                (few if last - first <= bins else many).append(found_in)
        if few:
            at = [F.when(_inside(values[b.column], b), F.struct(F.lit(k).alias("k"), values[b.column].alias("v"))) for k, (b, _, _) in enumerate(few)]
            some = F.greatest(*[F.coalesce(_inside(values[b.column], b), F.lit(False)) for b, _, _ in few]) if len(few) > 1 else _inside(values[few[0][0].column], few[0][0])
            inside: dict[int, list] = {}
            for k, v in _scan(df.where(some).select(F.explode(F.array_compact(F.array(*at))).alias("s")).select("s.k", "s.v")):
                inside.setdefault(k, []).append(v)
            for k, (b, _, first) in enumerate(few):
                got = sorted(inside[k])
                found[b.column].update({r: float(got[r - first]) for r in b.ranks})
        if many:  # sketch what is inside; a side that a bracket missed is bounded by values of the data, too
            x = {str(k): F.when(_inside(values[b.column], b), values[b.column]) for k, (b, _, _) in enumerate(many)}
            sketched, _, _ = profile_columns(df, x, {}, parts)
            for k, (b, _, first) in enumerate(many):
                p = sketched[str(k)]
                if p.n:
                    todo += _brackets(b.column, b.low, b.high, p.grid, p.n, {r: r - first for r in b.ranks})
                else:
                    todo.append(b)  # only its ends are left
    return found


def _interpolated(order: dict[int, float], n: int, p: float) -> float | None:
    if not n:
        return None
    h = (n - 1) * p
    a, b = order[math.floor(h)], order[math.ceil(h)]
    return a if a == b else a + (b - a) * (h - math.floor(h))


def quantile_ranks(n: int, probs: list[float]) -> set[int]:
    """Ranks between which the quantiles of ``n`` values lie."""
    return {r for p in probs for r in (math.floor((n - 1) * p), math.ceil((n - 1) * p))} if n else set()


def exact_quantiles(
    df: DataFrame,
    cols: list[str],
    probs: list[float],
    *,
    where: dict[str, object] | None = None,
    means: dict | None = None,
    bins: int = SELECT_BINS,
) -> dict[str, list[float | None]]:
    """Exact linear-interpolated quantiles (pandas ``quantile`` / SQL ``quantile_cont``).

    One scan profiles all columns (``profile_columns``), then ``select_ranks`` takes the order
    statistics between two sketched values, with two more scans, whatever the values' range. The driver receives at most ``bins`` values for each open bracket. ``where`` maps a column to a
    predicate restricting which values count. Nulls and NaNs are ignored. Returns
    ``{col: [q(p) for p in probs]}``; a dict passed as ``means`` receives each column's mean.
    """
    if not cols:
        return {}
    where = where or {}
    values = {c: F.when(where[c], _finite(c)) if c in where else _finite(c) for c in cols}
    profiles, counted, _ = profile_columns(df, values)
    if means is not None:
        means.update({c: mean for c, (_, mean) in counted.items()})
    order = select_ranks(df, values, profiles, {c: quantile_ranks(p.n, probs) for c, p in profiles.items()}, bins)
    return {c: [_interpolated(order[c], profiles[c].n, p) for p in probs] for c in cols}


def quantiles(
    df: DataFrame,
    cols: list[str],
    probs: list[float],
    *,
    approx: bool = False,
    where: dict[str, object] | None = None,
    means: dict | None = None,
    accuracy: int = APPROX_ACCURACY,
) -> dict[str, list[float | None]]:
    """Exact quantiles (default) or, with ``approx=True``, one ``percentile_approx`` pass whose
    rank error is at most n/accuracy (no interpolation between neighbours)."""
    if not approx:
        return exact_quantiles(df, cols, probs, where=where, means=means)
    if not cols:
        return {}
    where = where or {}

    def val(c):
        x = _finite(c)
        return F.when(where[c], x) if c in where else x

    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.percentile_approx(val(c), list(probs), accuracy).alias(f"q{i}"), F.avg(val(c)).alias(f"mu{i}")]
    row = df.agg(*aggs).first()
    if means is not None:
        means.update({c: row[f"mu{i}"] for i, c in enumerate(cols)})
    return {c: (list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(probs)) for i, c in enumerate(cols)}


def medians(df: DataFrame, cols: list[str], where: dict | None = None, approx: bool = False) -> dict[str, float | None]:
    q = quantiles(df, cols, [0.5], where=where, approx=approx)
    return {c: v[0] for c, v in q.items()}


def frequency_extremes(df: DataFrame, cols: list[str], which: str = "most") -> dict[str, object]:
    """Most (or least) frequent non-null value of each column; ties go to the smallest value.

    All columns are counted in one shuffle: rows are unpivoted to (column, value), counted
    with map-side partial aggregation (a hot value collapses before the shuffle), then the
    winner per column is a second small aggregate ``min(struct(order, value))``.
    """
    if not cols:
        return {}
    if which not in ("most", "less"):
        raise ValueError("which must be 'most' or 'less'")
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v")) for c in cols])
    ).alias("s")
    counted = df.select(pairs).select("s.k", "s.v").where(F.col("v").isNotNull()).groupBy("k", "v").count()
    order = -F.col("count") if which == "most" else F.col("count")
    best = counted.groupBy("k").agg(F.min(F.struct(order.alias("o"), F.col("v").alias("v"))).alias("m"))
    got = {r["k"]: r["m"]["v"] for r in best.collect()}
    return {c: got.get(c) for c in cols}
