"""Classification metrics as DataFrame aggregations.

Inputs are prediction tables: one row per example with an actual label, a predicted label
and optionally a probability vector. Every metric is a grouped aggregate with partial
aggregation; the confusion matrix is a (set, actual, predicted) count completed with zero
cells over the union of labels of each set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import safe_div
from .common import bounded_side

CLIP_EPS = 1e-15


def argmax(probs: str | Column) -> Column:
    """0-based index of the largest element; first index on ties."""
    p = F.col(probs) if isinstance(probs, str) else probs
    return (F.array_position(p, F.array_max(p)) - 1).cast("bigint")


def true_class_prob(probs: str, label: str) -> Column:
    return F.element_at(F.col(probs), (F.col(label) + 1).cast("int"))


def cross_entropy_terms(probs: str, label: str, eps_mode: str = "clip") -> Column:
    """Per-row −ln p(true class): 'clip' to [ε, 1−ε] (CNN form) or 'add' ε (MLP form)."""
    p = true_class_prob(probs, label).cast("double")
    if eps_mode == "clip":
        p = F.greatest(F.least(p, F.lit(1.0 - CLIP_EPS)), F.lit(CLIP_EPS))
    elif eps_mode == "add":
        p = p + F.lit(CLIP_EPS)
    else:
        raise ValueError("eps_mode must be 'clip' or 'add'")
    return -F.ln(p)


def cross_entropy(df: DataFrame, probs: str, label: str, eps_mode: str = "clip", by: list[str] | None = None) -> DataFrame:
    by = by or []
    return df.groupBy(*by).agg(F.avg(cross_entropy_terms(probs, label, eps_mode)).alias("loss"))


def accuracy(df: DataFrame, actual: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    by = by or []
    return df.groupBy(*by).agg(F.avg((F.col(actual) == F.col(predicted)).cast("double")).alias("accuracy"))


def pair_counts(df: DataFrame, actual: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """(by…, actual, predicted, n): the one aggregate over the prediction rows that every
    metric below derives from; materialised as a bounded side (≤ sets × K² rows)."""
    by = by or []
    a, p = F.col(actual).cast("bigint"), F.col(predicted).cast("bigint")
    rows = df.where(a.isNotNull() & p.isNotNull())  # an unlabelled row is not classified: no metric counts it
    return bounded_side(rows.groupBy(*by, a.alias("actual"), p.alias("predicted")).agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def confusion(df: DataFrame, actual: str, predicted: str, by: list[str] | None = None,
              counts: DataFrame | None = None) -> DataFrame:
    """Long confusion matrix ``(by…, actual, predicted, n)`` with zero cells kept.

    The data is scanned once for the pair counts; the label union of each group and the
    zero-completed K×K grid (labels exploded twice — a generator, not a cross join) are built
    from that table. Scores need no zero cells and use the pair counts instead.
    """
    by = by or []
    counts = counts if counts is not None else pair_counts(df, actual, predicted, by)
    labs = counts.select(*by, F.explode(F.array("actual", "predicted")).alias("lab")).distinct()
    labels = labs.groupBy(*by).agg(F.array_sort(F.collect_set("lab")).alias("labs"))
    grid = labels.select(*by, F.explode("labs").alias("actual"), F.col("labs")).select(
        *by, "actual", F.explode("labs").alias("predicted")
    )
    return grid.join(counts, on=[*by, "actual", "predicted"], how="left").select(
        *by, "actual", "predicted", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")
    )


def per_class_scores(conf: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per-class precision, recall, F1 (0 when undefined) from pair counts; zero cells may be missing.

    Each cell (actual a, predicted p, n) adds n to class a's actual total, to class p's
    predicted total and, when a = p, to its true positives — one grouped aggregate, no joins.
    """
    by = by or []
    z = F.lit(0).cast("bigint")
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(z)
    parts = F.explode(F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("act"), z.alias("pred"), hit.alias("tp")),
        F.struct(F.col("predicted").alias("label"), z.alias("act"), F.col("n").alias("pred"), z.alias("tp")),
    ))
    s = conf.select(*by, parts.alias("s")).select(*by, "s.*").groupBy(*by, "label").agg(
        F.sum("tp").alias("tp"), F.sum("pred").alias("pred_n"), F.sum("act").alias("act_n")
    )
    fp = F.col("pred_n") - F.col("tp")
    fn = F.col("act_n") - F.col("tp")
    return s.select(
        *by,
        "label",
        F.coalesce(safe_div(F.col("tp").cast("double"), F.col("pred_n").cast("double")), F.lit(0.0)).alias("precision"),
        F.coalesce(safe_div(F.col("tp").cast("double"), F.col("act_n").cast("double")), F.lit(0.0)).alias("recall"),
        F.coalesce(safe_div((2 * F.col("tp")).cast("double"), (2 * F.col("tp") + fp + fn).cast("double")), F.lit(0.0)).alias("f1"),
    )


def macro_scores(df: DataFrame, actual: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """Accuracy and macro precision / recall / F1 per group, as in the reference report."""
    keys = list(by or [])
    if not keys:  # one group: give it a constant key so the two summaries join on it
        df = df.withColumn("_all", F.lit(0))
        keys = ["_all"]
    counts = pair_counts(df, actual, predicted, keys)
    pcs = per_class_scores(counts, keys)
    macro = pcs.groupBy(*keys).agg(
        F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1")
    )
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    acc = counts.groupBy(*keys).agg((F.sum(hit).cast("double") / F.sum("n").cast("double")).alias("accuracy"))
    res = macro.join(acc, on=keys, how="inner")
    return res.drop("_all") if not by else res


def metrics_long(df: DataFrame, actual: str, predicted: str, by: list[str]) -> DataFrame:
    """(by…, metric, value) rows for accuracy, precision, recall, F1."""
    m = macro_scores(df, actual, predicted, by)
    return m.select(
        *by,
        F.explode(
            F.array(
                *[F.struct(F.lit(name).alias("metric"), F.col(name).alias("value")) for name in ("accuracy", "precision", "recall", "f1")]
            )
        ).alias("s"),
    ).select(*by, "s.metric", "s.value")


def metrics_report(df: DataFrame, actual: str, predicted: str, set_col: str = "set", sets=("train", "val", "test")) -> DataFrame:
    """Metric rows × one column per set (pivot with the set values listed, so no extra pass)."""
    long = metrics_long(df, actual, predicted, [set_col])
    return long.groupBy("metric").pivot(set_col, list(sets)).agg(F.first("value"))
