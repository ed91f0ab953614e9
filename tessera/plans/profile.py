"""Fitted statistics of the numeric preparation steps from three scans of the raw columns.

Filling nulls, replacing zeros and taking fences change a column by putting copies of one known value
beside values that stay as they are. So no step needs a scan of the step before it: with the raw
values' order statistics and counts of nulls and zeros, every later median and quartile is an order
statistic of the raw values with inserted copies. The first scan profiles and counts, the others
select all ranks that any step can need, for whatever value the copies get.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import prep
from ..operators.stats import _finite, profile_columns, quantile_ranks, select_ranks

QUARTILES = [0.25, 0.5, 0.75]


@dataclass
class Multiset:
    """Selected order statistics of ``n`` values, and copies (value, count) put beside them."""

    order: dict[int, float]
    n: int
    copies: list[tuple[float, int]]

    @property
    def size(self) -> int:
        return self.n + sum(k for _, k in self.copies)

    def at(self, rank: int) -> float:
        """The value of a rank: a raw value if it lies between the copies before and after it."""
        before = 0
        for value, count in sorted(self.copies):
            own = rank - before
            if 0 <= own < self.n and self.order[own] <= value:
                return self.order[own]
            after = own - count
            if after < 0 or after < self.n and self.order[after] < value:
                return value
            before += count
        return self.order[rank - before]

    def quantile(self, p: float) -> float | None:
        if not self.size:
            return None
        h = (self.size - 1) * p
        a, b = self.at(math.floor(h)), self.at(math.ceil(h))
        return a if a == b else a + (b - a) * (h - math.floor(h))


def shifted(ranks: set[int], counts: list[int], n: int) -> set[int]:
    """Raw ranks that can stand at ``ranks`` when some of the copies lie before them."""
    sums = {sum(some) for k in range(len(counts) + 1) for some in combinations(counts, k)}
    return {r - s for r in ranks for s in sums if 0 <= r - s < n}


def fit_numeric(df: DataFrame, num: list[str], treated: list[str], fill: str, zeros: list[str], outliers: str):
    """``(fills, zero medians, fences, null counts)`` as by fitting step after step.

    ``treated`` columns get nulls filled by ``fill`` ("mean", "median"; "none" where rows were dropped)
    and Tukey fences if ``outliers`` is "mean" or "median" (the replacement); zeros of ``zeros``
    become the median of the column's other values.
    """
    plain = {c: _finite(c) for c in num}
    values = {c: F.when(x != 0, x) if c in zeros else x for c, x in plain.items()}
    profiles, counted, rows = profile_columns(df, values, plain)
    n_null = {c: rows - counted[c][0] for c in num}
    nulls = {c: n_null[c] if c in treated and fill != "none" else 0 for c in num}
    n_zero = {c: counted[c][0] - profiles[c].n for c in num}
    average = {c: counted[c][1] for c in num}
    ranks: dict[str, set[int]] = {}
    for c in num:
        n, m, z = profiles[c].n, nulls[c], n_zero[c]
        need: set[int] = set()
        if c in treated and fill == "median":
            need |= shifted(quantile_ranks(n + z, [0.5]), [z], n)
        if c in zeros:
            need |= shifted(quantile_ranks(n, [0.5]), [], n) | shifted(quantile_ranks(n + m, [0.5]), [m], n)
        if c in treated and outliers != "keep":
            need |= shifted(quantile_ranks(n + m + z, QUARTILES), [m, z], n)
        if need:
            ranks[c] = need
    order = select_ranks(df, values, profiles, ranks) if ranks else {}
    fills, medians, fences = {}, {}, {}
    for c in num:
        n, m, z = profiles[c].n, nulls[c], n_zero[c]
        raw, copies = order.get(c, {}), []
        if c in treated and fill != "none":
            fills[c] = average[c] if fill == "mean" else Multiset(raw, n, [(0.0, z)]).quantile(0.5)
            if m and fills[c] is not None:
                if fills[c] == 0 and c in zeros:
                    z += m  # the filled values are zeros, too
                else:
                    copies.append((fills[c], m))
        if c in zeros:
            medians[c] = Multiset(raw, n, copies).quantile(0.5)
            copies = copies + [(0.0 if medians[c] is None else medians[c], z)]
        if c in treated and outliers != "keep":
            all_values = Multiset(raw, n, copies)
            q1, q2, q3 = [all_values.quantile(p) for p in QUARTILES]
            if q1 is not None:
                total = (average[c] or 0.0) * counted[c][0] + sum(v * k for v, k in copies)  # replaced zeros add nothing to it
                mean = total / all_values.size if any(k for _, k in copies) else average[c]
                fences[c] = {"lower": q1 - 1.5 * (q3 - q1), "upper": q3 + 1.5 * (q3 - q1), "centre": mean if outliers == "mean" else q2}
    return fills, medians, fences, n_null


def fit_categories(df: DataFrame, cols: list[str], treated: list[str], fill: str) -> tuple[dict, dict]:
    """``(fills, levels)``: the most or least frequent value of the ``treated`` columns (none for
    "drop") and each column's sorted values, None above ``prep.MAX_LITERAL_LEVELS``.

    String columns are counted together, in one shuffle of (column, value) with partial counts; the
    counts give both. Columns of other types are fitted one by one in their own order.
    """
    text = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    fills: dict[str, object] = {}
    levels: dict[str, list | None] = {c: [] for c in text}
    if text:
        pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col(c).alias("v")) for i, c in enumerate(text)])).alias("s")
        counted = df.select(pairs).select("s.k", "s.v").where("v IS NOT NULL").groupBy("k", "v").agg(F.count("*").alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            order = -F.col("n") if fill == "most" else F.col("n")
            best = counted.groupBy("k").agg(F.min(F.struct(order.alias("o"), "v")).alias("m"), F.count("*").alias("size")).collect()
            size = {r["k"]: r["size"] for r in best}
            if fill != "drop":
                fills = {text[r["k"]]: r["m"]["v"] for r in best if text[r["k"]] in treated}
                fills.update({c: None for c in text if c in treated and c not in fills})
            few = [k for k, n in size.items() if n <= prep.MAX_LITERAL_LEVELS]
            levels.update({text[k]: None for k in size if k not in few})
            if few:  # at most MAX_LITERAL_LEVELS rows a column
                for r in counted.where(F.col("k").isin(few)).select("k", "v").orderBy("k", "v").collect():
                    levels[text[r["k"]]].append(r["v"])
        finally:
            counted.unpersist()
    others = [c for c in cols if c not in text]
    if others:
        if fill != "drop":
            fills.update(prep.fit_categorical_fill(df, [c for c in others if c in treated], fill))
        levels.update({c: prep.fit_levels(df, c) for c in others})
    return fills, levels
