"""Metrics on a hand-worked example (macro averages over the union of labels, 0 when undefined)."""

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import metrics


def test_macro_scores_hand_worked(spark):
    # actual:    0 0 1 1 2 2 2
    # predicted: 0 1 1 1 0 3 2   (class 3 is predicted but never actual)
    rows = list(zip([0, 0, 1, 1, 2, 2, 2], [0, 1, 1, 1, 0, 3, 2]))
    df = spark.createDataFrame(rows, "actual bigint, predicted bigint")
    conf = {(r.actual, r.predicted): r.n for r in metrics.confusion(df, "actual", "predicted").collect()}
    assert len(conf) == 16 and conf[(2, 3)] == 1 and conf[(3, 3)] == 0
    m = metrics.macro_scores(df, "actual", "predicted").first()
    # per class (tp, predicted, actual): 0:(1,2,2) 1:(2,3,2) 2:(1,1,3) 3:(0,1,0)
    p = [1 / 2, 2 / 3, 1 / 1, 0.0]
    r = [1 / 2, 2 / 2, 1 / 3, 0.0]
    f1 = [2 * 1 / (2 + 1 + 1), 2 * 2 / (4 + 1 + 0), 2 * 1 / (2 + 0 + 2), 0.0]
    assert np.isclose(m.precision, np.mean(p)) and np.isclose(m.recall, np.mean(r)) and np.isclose(m.f1, np.mean(f1))
    assert np.isclose(m.accuracy, 4 / 7)


def test_cross_entropy_modes(spark):
    df = spark.createDataFrame([([0.0, 1.0], 0), ([0.25, 0.75], 1)], "probs array<double>, label bigint")
    clip = df.agg(F.avg(metrics.cross_entropy_terms("probs", "label", "clip"))).first()[0]
    add = df.agg(F.avg(metrics.cross_entropy_terms("probs", "label", "add"))).first()[0]
    assert np.isclose(clip, (-np.log(1e-15) - np.log(0.75)) / 2)
    assert np.isclose(add, (-np.log(1e-15) - np.log(0.75 + 1e-15)) / 2)
    assert metrics.accuracy(df.withColumn("pred", metrics.argmax("probs")), "label", "pred").first()[0] == 0.5


def test_more_than_two_thousand_labels(spark):
    from tessera.operators.metrics import macro_scores

    df = spark.range(2001).select(F.col("id").alias("a"), F.when(F.col("id") < 1, F.lit(1)).otherwise(F.col("id")).alias("p"))
    r = macro_scores(df, "a", "p").first()
    assert abs(r["accuracy"] - 2000 / 2001) < 1e-12 and abs(r["recall"] - 2000 / 2001) < 1e-12
