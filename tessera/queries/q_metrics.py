"""Queries for classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..operators import metrics, splits
from ..sources.tables import read_table
from . import register
from .q_splits import SEED, split_sql

# labels: quality is the actual class, toxic stands in for the predicted class.
LAB = "SELECT doc_id, CAST(quality AS BIGINT) AS actual, CAST(toxic AS BIGINT) AS predicted FROM labels"


def _labels(spark, sf):
    return read_table(spark, sf, "labels").select(
        "doc_id", F.col("quality").cast("bigint").alias("actual"), F.col("toxic").cast("bigint").alias("predicted")
    )


def _labels_with_sets(spark, sf):
    return splits.three_way_split(_labels(spark, sf), "actual", "doc_id", 0.2, 0.2, SEED)


def _conf_sql(src: str, by: str) -> str:
    bysel = f"{by}, " if by else ""
    byon = f" USING ({by}, actual, predicted)" if by else " USING (actual, predicted)"
    labs_by = f"{by}, " if by else ""
    return f"""
src AS ({src}),
labs AS (SELECT DISTINCT {labs_by}lab FROM (SELECT {bysel}actual AS lab FROM src UNION ALL SELECT {bysel}predicted FROM src)),
grid AS (SELECT {"a." + by + ", " if by else ""}a.lab AS actual, b.lab AS predicted FROM labs a JOIN labs b ON {"a." + by + " = b." + by if by else "TRUE"}),
cnt AS (SELECT {bysel}actual, predicted, count(*) AS n FROM src GROUP BY ALL),
conf AS (SELECT {bysel}actual, predicted, CAST(coalesce(n, 0) AS BIGINT) AS n FROM grid LEFT JOIN cnt{byon})"""


def _prf_sql(by: str) -> str:
    bysel = f"{by}, " if by else ""
    g = f"GROUP BY {by}" if by else ""
    return f""",
tp AS (SELECT {bysel}actual AS label, n AS tp FROM conf WHERE actual = predicted),
pt AS (SELECT {bysel}predicted AS label, sum(n) AS pn FROM conf GROUP BY ALL),
act_t AS (SELECT {bysel}actual AS label, sum(n) AS an FROM conf GROUP BY ALL),
pc AS (SELECT {bysel}label,
              coalesce(CAST(tp AS DOUBLE) / nullif(pn, 0), 0.0) AS precision,
              coalesce(CAST(tp AS DOUBLE) / nullif(an, 0), 0.0) AS recall,
              coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + (pn - tp) + (an - tp), 0), 0.0) AS f1
       FROM tp JOIN pt USING ({bysel}label) JOIN act_t USING ({bysel}label)),
macro AS (SELECT {bysel}avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1 FROM pc {g}),
acc AS (SELECT {bysel}avg(CAST(actual = predicted AS DOUBLE)) AS accuracy FROM src {g})"""


@register("metric_confusion", "WITH " + _conf_sql(LAB, "") + "\nSELECT actual, predicted, n FROM conf")
def q_metric_confusion(spark, sf):
    return metrics.confusion(_labels(spark, sf), "actual", "predicted")


@register(
    "metric_macro_prf",
    "WITH " + _conf_sql(LAB, "") + _prf_sql("")
    + "\nSELECT round(precision, 6) + 0.0 AS precision, round(recall, 6) + 0.0 AS recall, round(f1, 6) + 0.0 AS f1, "
    "round(accuracy, 6) + 0.0 AS accuracy FROM macro, acc",
)
def q_metric_macro_prf(spark, sf):
    m = metrics.macro_scores(_labels(spark, sf), "actual", "predicted")
    return m.select(*[r6(c).alias(c) for c in ("precision", "recall", "f1", "accuracy")])


@register("metric_accuracy", f"WITH src AS ({LAB}) SELECT round(avg(CAST(actual = predicted AS DOUBLE)), 6) + 0.0 AS accuracy FROM src")
def q_metric_accuracy(spark, sf):
    return metrics.accuracy(_labels(spark, sf), "actual", "predicted").select(r6("accuracy").alias("accuracy"))


_SETS_SRC = split_sql(LAB, "doc_id", "actual", 0.2, 0.2, SEED, "doc_id, actual, predicted")


@register(
    "metric_confusion_by_set",
    "WITH s0 AS (WITH " + _SETS_SRC + "), " + _conf_sql('SELECT "set", actual, predicted FROM s0', '"set"')
    + '\nSELECT "set", actual, predicted, n FROM conf',
)
def q_metric_confusion_by_set(spark, sf):
    return metrics.confusion(_labels_with_sets(spark, sf), "actual", "predicted", ["set"])


@register(
    "metric_report",
    "WITH s0 AS (WITH " + _SETS_SRC + "), " + _conf_sql('SELECT "set", actual, predicted FROM s0', '"set"') + _prf_sql('"set"')
    + """,
lng AS (SELECT "set", metric, value FROM (
          SELECT "set", 'accuracy' AS metric, accuracy AS value FROM acc
          UNION ALL SELECT "set", 'precision', precision FROM macro
          UNION ALL SELECT "set", 'recall', recall FROM macro
          UNION ALL SELECT "set", 'f1', f1 FROM macro))
SELECT metric,
       round(max(value) FILTER (WHERE "set" = 'train'), 6) + 0.0 AS train,
       round(max(value) FILTER (WHERE "set" = 'val'), 6) + 0.0 AS val,
       round(max(value) FILTER (WHERE "set" = 'test'), 6) + 0.0 AS test
FROM lng GROUP BY metric""",
)
def q_metric_report(spark, sf):
    rep = metrics.metrics_report(_labels_with_sets(spark, sf), "actual", "predicted")
    return rep.select("metric", *[r6(c).alias(c) for c in ("train", "val", "test")])


@register(
    "predict_argmax",
    "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS predicted FROM embeddings",
)
def q_predict_argmax(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return e.select("vec_id", metrics.argmax("embedding").alias("predicted"))


@register(
    "cv_grid_best",
    """
WITH cnt AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
off AS (SELECT label, coalesce(sum(n) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM cnt),
r AS (SELECT vec_id, label, embedding, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('-', '42', CAST(vec_id AS VARCHAR))), vec_id) AS rn FROM embeddings),
folds AS (SELECT vec_id, label, embedding, CAST((o + rn - 1) % 3 AS BIGINT) AS fold FROM r JOIN off USING (label)),
grid AS (SELECT * FROM (VALUES (0, 0), (1, 8), (2, 16), (3, 24)) g(grid_idx, start)),
scored AS (SELECT grid_idx, fold,
                  avg(CAST(CAST(list_position(embedding[start + 1:start + 10], list_max(embedding[start + 1:start + 10])) - 1 AS BIGINT) = label AS DOUBLE)) AS accuracy
           FROM folds JOIN grid ON TRUE GROUP BY grid_idx, fold)
SELECT CAST(grid_idx AS BIGINT) AS grid_idx, fold, round(accuracy, 6) + 0.0 AS accuracy
FROM scored ORDER BY accuracy DESC, grid_idx, fold LIMIT 1
""",
)
def q_cv_grid_best(spark, sf):
    """Best cell of a scores table (strict '>' in grid order ⇒ highest accuracy, first grid cell).

    The scores here are per-fold accuracies of four fixed arg-max readers (a 10-wide window of
    the embedding at offsets 0, 8, 16, 24) — a grid whose scoring is pure SQL, so the
    selection rule itself gets an exact oracle; the trained grid is ``cv_grid_scores``.
    """
    from ..plans.crossval import best_cell

    e = read_table(spark, sf, "embeddings")
    f = splits.kfold(e, "label", "vec_id", 3, SEED)
    starts = [0, 8, 16, 24]
    cells = f.select(
        "label", "fold",
        F.explode(F.array(*[F.struct(F.lit(i).cast("bigint").alias("grid_idx"), F.lit(s).alias("start")) for i, s in enumerate(starts)])).alias("g"),
        "embedding",
    ).select("label", "fold", "g.grid_idx", F.slice("embedding", F.col("g.start") + 1, 10).alias("win"))
    scores = cells.groupBy("grid_idx", "fold").agg(
        F.avg((metrics.argmax("win") == F.col("label")).cast("double")).alias("accuracy")
    )
    best = best_cell(scores.withColumn("accuracy", r6("accuracy")), by="single")
    return best.select("grid_idx", "fold", "accuracy")
