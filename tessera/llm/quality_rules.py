"""Quality rules with robust multivariate outliers.

Each document gives a vector of transformed statistics. Per language and source the minimum covariance
determinant estimate is searched: the ``share`` of rows whose covariance has the smallest determinant
gives mean and covariance. Each of ``STARTS`` is improved by two concentration steps (the rows nearest
by the present estimate give the next one); the start of lowest determinant goes on until the
determinant falls in no group. Rows whose Mahalanobis distance exceeds the chi-square cutoff are
rejected. Everything is grouped sums over distance bins and joins with the table of estimates: no
group is gathered, however large.

No scale is set by hand. All statistics vary from text to text (rare marks are counted together with
punctuation, repeats by what they do to distinct, top and adjacent words), so a group's own covariance
says what is usual. It is blended with a diagonal target, the quartile ranges of all groups, that weighs
like ``weight`` rows and so vanishes as a group grows; small groups stay well-conditioned by it. A
variance never falls below a statistic's resolution, the square of what one more count changes in it: where
nearly all texts have the same count, one more is no outlier.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, scratch, text_or_empty
from .stats import COUNTS, with_counts

PAD = 100  # words of an average text that every text is padded with, so short texts vary less
BINS = 1024  # bins per unit in which quartiles are counted
FINE = 32  # bins per doubling of a distance
STARTS = ("quartiles", "all rows", "half of the rows")
GROUP = ["_lang", "_source"]
KEY = [*GROUP, "_start"]
SALTS = 32  # a group's rows meet the table of estimates in so many parts, however hot the group


def vector(more: int = 0) -> list[Column]:
    """Word length, punctuation and other marks, upper case, top word (logs of padded rates), distinct
    words (their log over the log of the words), and words equal to the one before (root of a rate);
    with ``more`` added to each count."""
    n = F.col("n_words") + PAD
    return [
        F.log((F.col("word_chars") + more + 5 * PAD) / n),
        F.log((F.col("n_stops") + F.col("n_symbols") + F.col("n_bang") + more + 0.15 * PAD) / n),
        F.log((F.col("n_upper") + more + 0.09 * PAD) / n),
        F.log((F.col("n_top") + more + 0.05 * PAD) / n),
        F.log(F.col("n_distinct") + more + PAD) / F.log(n),
        F.sqrt((F.col("n_adjacent") + more + 0.005 * PAD) / n),
    ]


def gamma_p(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function by its series."""
    term = total = 1.0 / a
    k = a
    while abs(term) > 1e-16 * abs(total):
        k += 1
        term *= x / k
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a)) if x > 0 else 0.0


def chi2_quantile(p: float, d: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if gamma_p(d / 2, mid / 2) < p else (low, mid)
    return high


def _quartiles(rows: DataFrame) -> DataFrame:
    """Per group and statistic ``k``: rows ``n``, median ``q2`` and normal scale ``sd`` from counted bins."""
    cells = rows.select(*GROUP, F.posexplode("x").alias("k", "v")).withColumn("bin", F.floor(F.col("v") * BINS))
    counted = cells.groupBy(*GROUP, "k", "bin").agg(F.count("*").alias("n"))
    so_far = F.sum("n").over(Window.partitionBy(*GROUP, "k").orderBy("bin"))
    total = F.sum("n").over(Window.partitionBy(*GROUP, "k"))
    reach = counted.select(*GROUP, "k", "bin", so_far.alias("c"), total.alias("t"))
    at = [F.min(F.when(F.col("c") >= F.ceil(F.col("t") * q), F.col("bin"))).alias(f"q{i}") for i, q in enumerate((0.25, 0.5, 0.75), 1)]
    marks = reach.groupBy(*GROUP, "k").agg(F.max("t").alias("n"), *at)
    return marks.select(*GROUP, "k", "n", ((F.col("q2") + 0.5) / BINS).alias("q2"), ((F.col("q3") - F.col("q1")) / (BINS * 1.349)).alias("sd"))


def _distance(d: int) -> Column:
    """Squared Mahalanobis distance of ``x`` from the joined ``mean`` and ``inverse``."""
    diff = [F.col("x")[i] - F.col("mean")[i] for i in range(d)]
    return sum(
        (diff[i] * diff[j] * F.col("inverse")[i * d + j] * (1 if i == j else 2) for i in range(d) for j in range(i, d)),
        F.lit(0.0),
    )


def _moments(d: int) -> list[Column]:
    """Sums of ``x`` and of its products, as one array each."""
    sums = [F.sum(F.col("x")[i]) for i in range(d)]
    products = [F.sum(F.col("x")[i] * F.col("x")[j]) for i in range(d) for j in range(i, d)]
    return [F.array(*sums).alias("sums"), F.array(*products).alias("products")]


def _estimates(moments: DataFrame, target: np.ndarray, resolution: np.ndarray, weight: float, factor: float) -> DataFrame:
    """``(mean, inverse, log_det)`` per row of ``n``, ``sums`` and ``products``: mean, and the inverse and
    the log determinant of the covariance blended with the diagonal ``target``, with variances of at
    least ``resolution``."""
    d = len(target)

    @F.pandas_udf("struct<mean:array<double>,inverse:array<double>,log_det:double>")
    def solve(n: pd.Series, sums: pd.Series, products: pd.Series) -> pd.DataFrame:
        if not len(n):
            return pd.DataFrame({"mean": [], "inverse": [], "log_det": []})
        n = n.to_numpy(float)[:, None]
        mean = np.stack(sums.to_list()) / n
        flat = np.stack(products.to_list()) / n
        cov = np.zeros((len(n), d, d))
        at = [(i, j) for i in range(d) for j in range(i, d)]
        for k, (i, j) in enumerate(at):
            cov[:, i, j] = cov[:, j, i] = flat[:, k] - mean[:, i] * mean[:, j]
        blended = (n[:, :, None] * factor * cov + weight * np.diag(target)) / (n[:, :, None] + weight)
        own = np.arange(d)
        blended[:, own, own] = np.maximum(blended[:, own, own], resolution)
        inverse = np.linalg.inv(blended).reshape(len(n), -1)
        return pd.DataFrame({"mean": list(mean), "inverse": list(inverse), "log_det": np.linalg.slogdet(blended)[1]})

    others = [c for c in moments.columns if c not in ("n", "sums", "products")]
    return moments.select(*others, solve("n", "sums", "products").alias("e")).select(*others, "e.mean", "e.inverse", "e.log_det")


def _spread(estimates: DataFrame) -> DataFrame:
    """One copy of each estimate (one per group and start) for every salt."""
    return estimates.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _starts(rows: DataFrame, marks: DataFrame, target: np.ndarray, resolution: np.ndarray, weight: float) -> DataFrame:
    """The first estimates of every group, one per name of ``STARTS``: median and target, moments of all
    rows, moments of the half that a hash draws. Their determinants count for nothing."""
    d = len(target)
    inverse = F.array(*[F.lit(float(1 / target[i]) if i == j else 0.0) for i in range(d) for j in range(d)])
    middle = marks.groupBy(*GROUP).agg(F.array_sort(F.collect_list(F.struct("k", "q2"))).alias("s"))
    first = middle.select(*GROUP, F.lit(STARTS[0]).alias("_start"), F.transform("s", lambda s: s["q2"]).alias("mean"), inverse.alias("inverse"))
    halved = rows.where(F.col("_salt") % 2 == 0).withColumn("_start", F.lit(STARTS[2]))
    both = rows.withColumn("_start", F.lit(STARTS[1])).unionByName(halved)
    moments = both.groupBy(*KEY).agg(F.count("*").alias("n"), *_moments(d))
    return first.unionByName(_estimates(moments, target, resolution, weight, 1.0).drop("log_det")).withColumn("log_det", F.lit(float("inf")))


def _concentrate(rows: DataFrame, now: DataFrame, target: np.ndarray, resolution: np.ndarray, share: float, weight: float, factor: float) -> DataFrame:
    """One concentration step: per group and start the estimate from the ``share`` of rows nearest by
    ``now`` where that lowers the determinant (``moved``), else ``now`` itself.

    Rows are summed by distance bin, so one reading of the rows is enough. The bin in which the share is
    reached counts in part, which makes every subset equally large and determinants comparable.
    """
    d = len(target)
    far = rows.join(_spread(now.drop("log_det", "moved")), [*GROUP, "_salt"]).select(*KEY, "x", _distance(d).alias("distance"))
    binned = far.groupBy(*KEY, F.floor(F.log2(F.col("distance") + 1e-6) * FINE).alias("bin")).agg(F.count("*").alias("n"), *_moments(d))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*KEY).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wanted = F.ceil(F.sum("n").over(Window.partitionBy(*KEY)) * share)
    part = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("wanted") - F.col("before")) / F.col("n")))
    weighed = binned.withColumns({"before": before, "wanted": wanted}).withColumn("part", part).where("part > 0")

    def total(col: str, size: int) -> Column:
        return F.array(*[F.sum(F.col(col)[i] * F.col("part")) for i in range(size)]).alias(col)

    near = weighed.groupBy(*KEY).agg(F.sum(F.col("n") * F.col("part")).alias("n"), total("sums", d), total("products", d * (d + 1) // 2))
    new = _estimates(near, target, resolution, weight, factor)
    old = now.select(*KEY, F.struct("mean", "inverse", "log_det").alias("old"))
    lower = F.col("log_det") < F.col("old.log_det") - 1e-7
    best = F.when(lower, F.struct("mean", "inverse", "log_det")).otherwise(F.col("old"))
    return scratch(new.join(old, KEY).select(*KEY, best.alias("e"), lower.alias("moved")).select(*KEY, "e.*", "moved"), "estimates")


def robust_distances(rows: DataFrame, resolution: list[float], share: float = 0.75, weight: float = 10.0, max_steps: int = 50) -> DataFrame:
    """``rows`` (``GROUP`` columns without nulls, ``x`` array of doubles, as many as ``resolution`` has) plus
    ``distance``: squared Mahalanobis distance from the group's minimum covariance determinant estimate.
    ``resolution`` holds the least variance of each statistic, above 0. The search ends when no group's
    determinant falls any more, or after ``max_steps`` steps."""
    resolution, d = np.array(resolution, float), len(resolution)
    columns = rows.columns
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int"))
    factor = share / gamma_p((d + 2) / 2, chi2_quantile(share, d) / 2)  # consistency at the normal
    marks = scratch(_quartiles(rows), "quartiles")
    target = resolution.copy()
    for r in marks.groupBy("k").agg((F.sum(F.col("n") * F.col("sd") * F.col("sd")) / F.sum("n")).alias("v")).collect():  # d rows
        target[r["k"]] = max(target[r["k"]], r["v"])
    now = scratch(_starts(rows, marks, target, resolution, weight), "estimates")
    for _ in range(2):
        now = _concentrate(rows, now, target, resolution, share, weight, factor)
    best = F.min_by(F.struct("_start", "mean", "inverse", "log_det"), F.struct("log_det", "_start"))
    now = scratch(now.groupBy(*GROUP).agg(best.alias("e")).select(*GROUP, "e.*"), "estimates")
    for _ in range(max_steps):
        now = _concentrate(rows, now, target, resolution, share, weight, factor)
        if not now.where("moved").head(1):
            break
    return rows.join(_spread(now.select(*GROUP, "mean", "inverse")), [*GROUP, "_salt"]).select(*columns, _distance(d).alias("distance"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", tail: float = 1e-6) -> DataFrame:
    """``(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance,
    kept)`` per input row.

    ``base_failed``: fewer than 10 words, or over 20 % of the words in repeated 5-word windows.
    ``kept`` is false for those and for rows beyond the chi-square quantile of ``1 - tail``; rows that
    fail the base rules take no part in the estimates. Null texts count as empty, null languages and
    sources form groups of their own, null ids are returned, repeated rows repeat, an empty table
    gives an empty one; other columns are not read.
    """
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        # a prefix tells a null from any real name
        F.coalesce(F.concat(F.lit("="), F.col(lang_col).cast("string")), F.lit("")).alias("_lang"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("_source"),
        text_or_empty(text_col).alias("_text"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    counted = with_counts(rows, "_text").withColumn("base_failed", failed).withColumn("x", F.array(*vector()))
    counted = counted.withColumn("step", F.array(*[b - a for a, b in zip(vector(), vector(1))]))
    table = scratch(counted.select("id", *GROUP, *[c for c in COUNTS[:6] if c != "n_lines"], "base_failed", "x", "step"), "counts")
    d = len(vector())
    tested = table.where("NOT base_failed").drop("step")
    steps = table.where("NOT base_failed").agg(*[F.avg(F.col("step")[i] * F.col("step")[i]) for i in range(d)]).first()  # one row
    fit = robust_distances(tested, [1.0 if v is None else v for v in steps])
    cutoff = chi2_quantile(1 - tail, d)
    base = ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = fit.select(*base, "distance", (F.col("distance") <= cutoff).alias("kept"))
    return judged.unionByName(table.where("base_failed").select(*base, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept")))
