"""Mixing documents to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. The values that a target names are
categories of their own, all others share the category ``*``, so there are no more cells than the
targets' sizes multiplied, whatever the corpus holds. Token sums per cell are raked: in turn each
margin is scaled to its target until all fit; a cell can give at most the tokens it has. The budget is
the largest, up to ``keep_share`` of all tokens, at which every margin is met: targets come before
size. A cell's share of its tokens is the sampling probability of its documents, and a document is kept if the
hash of its id and text, as a number in [0, 1), lies below.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_hash, text_or_empty

REST = "*"
MARGINS = ("source", "lang", "topic")
#: Topics by literal markers (lower case), in order of preference; a text without any is "general".
TOPICS = {
    "legal": ("license", "copyright", "warranty"),
    "contact": ("@", "+1 ("),
    "tables": (" | ",),
    "settings": ("password", "secret", "api_key", "token="),
}


def n_tokens(text: Column) -> Column:
    """Words of a text: runs without white space (x20, x09-x0D)."""
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def topic_of(text: Column, topics: dict[str, tuple[str, ...]]) -> Column:
    """The topic whose markers occur most often; earlier topics win ties."""
    names = F.array(*[F.lit(t) for t in topics])

    def found(folded: Column) -> Column:
        def times(m: str) -> Column:
            return (F.octet_length(folded) - F.octet_length(F.replace(folded, F.lit(m), F.lit("")))) / len(m.encode())

        return F.array(*[sum((times(m) for m in markers), F.lit(0.0)) for markers in topics.values()])

    def best(counts: Column) -> Column:
        most = F.array_max(counts)
        return F.when(most == 0, F.lit("general")).otherwise(F.element_at(names, F.array_position(counts, most).cast("int")))

    # the inner arrays bind the folded text and its counts, so each is worked out once
    return F.element_at(F.transform(F.transform(F.array(F.lower(text)), found), best), 1)


def fill(available: np.ndarray, target: np.ndarray, budget: float) -> np.ndarray:
    """Tokens per value: ``budget`` by target share, values without enough giving all they have and
    the others the rest in proportion."""
    out, open_ = np.zeros(len(target)), target > 0
    open_ &= available > 0
    left = min(budget, available[open_].sum())
    while open_.any():
        want = left * target[open_] / target[open_].sum()
        short = want >= available[open_]
        at = np.flatnonzero(open_)
        if not short.any():
            out[at] = want
            break
        out[at[short]] = available[at[short]]
        left -= available[at[short]].sum()
        open_[at[short]] = False
        if left <= 0:
            break
    return out


def rake(cells: np.ndarray, targets: list[np.ndarray], budget: float, sweeps: int = 500, close: float = 1e-9) -> np.ndarray:
    """Kept tokens per cell (array of one axis per margin) by iterative proportional fitting."""
    wanted = [fill(cells.sum(axis=tuple(j for j in range(cells.ndim) if j != k)), t, budget) for k, t in enumerate(targets)]
    kept = cells * (budget / cells.sum()) if cells.sum() else cells.copy()
    for _ in range(sweeps):
        before = kept
        for k, want in enumerate(wanted):
            have = kept.sum(axis=tuple(j for j in range(kept.ndim) if j != k))
            factor = np.divide(want, have, out=np.zeros_like(want), where=have > 0)
            kept = np.minimum(cells, kept * factor.reshape([-1 if j == k else 1 for j in range(kept.ndim)]))
        if np.abs(kept - before).max(initial=0.0) <= close * budget:
            break
    return kept


def largest_gap(kept: np.ndarray, targets: list[np.ndarray]) -> float:
    """The largest difference between a wanted and a reached share over all margins."""
    total = kept.sum()
    if not total:
        return 0.0
    reached = [kept.sum(axis=tuple(j for j in range(kept.ndim) if j != k)) / total for k in range(kept.ndim)]
    return float(max(np.abs(r - t).max() for r, t in zip(reached, targets)))


def rake_to_targets(cells: np.ndarray, targets: list[np.ndarray], keep_share: float, close: float = 1e-3, halvings: int = 12) -> np.ndarray:
    """Kept tokens per cell at the largest budget, up to ``keep_share`` of all tokens, whose reached shares
    lie within ``close`` of the targets. Values without tokens leave their shares to the others. Targets that no
    budget meets (a value that occurs only beside another one) are raked at the largest budget that each value
    alone allows."""
    sums = [cells.sum(axis=tuple(j for j in range(cells.ndim) if j != k)) for k in range(cells.ndim)]
    present = [np.where(have > 0, t, 0.0) for have, t in zip(sums, targets)]
    if not cells.sum() or any(not t.sum() for t in present):
        return np.zeros_like(cells)
    present = [t / t.sum() for t in present]
    limit = min(keep_share * cells.sum(), *[(have[t > 0] / t[t > 0]).min() for have, t in zip(sums, present)])
    best = rake(cells, present, limit)
    if largest_gap(best, present) <= close:
        return best
    low, high, found = 0.0, limit, None
    for _ in range(halvings):
        middle = (low + high) / 2
        kept = rake(cells, present, middle)
        if largest_gap(kept, present) <= close:
            low, found = middle, kept
        else:
            high = middle
    return best if found is None else found


def mix(
    docs: DataFrame,
    targets: dict[str, dict[str, float]],
    keep_share: float = 0.8,
    topics: dict[str, tuple[str, ...]] = TOPICS,
    seed: int = 17,
    text_col: str = "text",
    id_col: str = "doc_id",
    source_col: str = "source",
    lang_col: str = "lang",
) -> DataFrame:
    """``(row, source, lang, topic, n_tokens, probability, kept, largest_gap)``: ``row`` is the input row
    as a struct, so any column names are safe; every input row is returned. ``largest_gap`` is the largest
    difference between a wanted and an expected share over all target values, the same in every row.

    ``targets`` maps each of ``source``, ``lang`` and ``topic`` to the token share of its values;
    ``*`` stands for all values not named (without it they get nothing); shares of values that the
    corpus lacks go to the others and show in ``largest_gap``. ``keep_share`` is the most of all tokens to
    keep; a value with few tokens lowers it until its target is met. Null sources, languages and texts count as not
    named, not named, and empty; a text without words has the probability of its cell. Equal rows
    share one decision. An empty table gives an empty one.
    """

    def category(value: Column, margin: str) -> Column:
        named = [v for v in targets[margin] if v != REST]
        return F.when(value.isin(named), value).otherwise(F.lit(REST)) if named else F.lit(REST)

    text = text_or_empty(text_col)
    placed = docs.select(
        F.struct(*docs.columns).alias("row"),
        category(F.col(source_col).cast("string"), "source").alias("source"),
        category(F.col(lang_col).cast("string"), "lang").alias("lang"),
        F.xxhash64(F.col(id_col), text_hash(text_col), F.lit(seed)).alias("_draw"),
        # a one-row generator: what is worked out from the text is not pushed into later filters again
        F.explode(F.array(F.struct(topic_of(text, topics).alias("topic"), n_tokens(text).alias("n_tokens")))).alias("_f"),
    ).select("row", "source", "lang", "_draw", category(F.col("_f.topic"), "topic").alias("topic"), "_f.n_tokens")
    sums = placed.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("n")).collect()  # one row per cell, bounded by the targets
    names = [sorted({*targets[m], REST}) for m in MARGINS]
    cells = np.zeros([len(x) for x in names])
    for r in sums:
        cells[tuple(x.index(r[m]) for x, m in zip(names, MARGINS))] = r["n"]
    wanted = [np.array([targets[m].get(v, 0.0) for v in x]) for x, m in zip(names, MARGINS)]
    wanted = [t / t.sum() if t.sum() else t for t in wanted]
    kept = rake_to_targets(cells, wanted, keep_share)
    gap = F.lit(largest_gap(kept, wanted))
    share = np.divide(kept, cells, out=np.zeros_like(kept), where=cells > 0)
    # a literal map in the plan: as many entries as there are cells
    table = F.create_map(*itertools.chain(*[(F.lit("\x00".join(v)), F.lit(float(share[tuple(x.index(y) for x, y in zip(names, v))]))) for v in itertools.product(*names)]))
    probability = F.element_at(table, F.concat_ws("\x00", *MARGINS))
    draw = F.shiftrightunsigned("_draw", 11) / F.lit(float(1 << 53))
    return placed.withColumn("probability", probability).select("row", *MARGINS, "n_tokens", "probability", (draw < F.col("probability")).alias("kept"), gap.alias("largest_gap"))
