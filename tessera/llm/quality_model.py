"""Quality classifier: random Fourier features, ridge by normal equations, isotonic calibration.

Document statistics are standardised over the whole corpus and mapped to random Fourier features
``sqrt(2 / D) cos(W z + b)``, which approximate a Gaussian kernel. Labelled rows give one pair of
normal-equation sums per partition; their total is solved for a ridge score. A part of the labelled
rows that the ridge has not seen calibrates the score: counts per fixed score bin are pooled to a
rising step function (pool adjacent violators), read with linear interpolation.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, scratch, text_or_empty
from .stats import with_counts

FEATURES = 192  # random Fourier features
FIT_PARTS = 16  # partitions that sum normal equations; each sends FEATURES**2 numbers to the driver
BINS = 400  # score bins of the calibration, over SPAN
SPAN = (-0.5, 1.5)
SEED = 20_240


def statistics() -> list[Column]:
    """Document statistics: size, word length, rates of marks, repetition. Short texts are padded
    with a few neutral words so that their rates do not swing."""
    n = F.col("n_words") + 5.0

    def rate(c: str) -> Column:
        return F.sqrt(F.col(c) / n)

    return [
        F.log1p("n_words"),
        F.log((F.col("word_chars") + 25) / n),
        rate("n_symbols"),
        F.sqrt(F.col("n_upper") / (F.col("word_chars") + 25)),
        rate("n_bang"),
        rate("n_pipe"),
        rate("n_adjacent"),
        rate("n_repeat_words"),
        rate("n_dup_lines"),
        F.col("n_distinct") / n,
        rate("n_top"),
        rate("n_stops"),
        rate("n_digits"),
    ]


def is_held_out(id_col: Column) -> Column:
    """crc32 of the id as text is a multiple of 5; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def feature_map(d: int, width: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.normal(0, width / np.sqrt(d), (d, FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES)


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, maps) -> np.ndarray:
    z = np.clip((x - mean) / scale, -8, 8)
    return np.concatenate([np.sqrt(2 / FEATURES) * np.cos(z @ maps[0] + maps[1]), np.ones((len(x), 1))], axis=1)


def isotonic(total: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: rising rates per non-empty bin, weighted by its rows."""
    blocks: list[list[float]] = []
    for n, h in zip(total, hits):
        blocks.append([n, h, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n2, h2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n2, blocks[-1][1] + h2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), h / n) for n, h, k in blocks]) if blocks else np.zeros(0)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", with_row: bool = False, max_fit_rows: int = 200_000, ridge: float = 1e-3) -> DataFrame:
    """``(id, held_out, score)`` for every row of ``docs``, with its columns as a struct ``row`` on request.

    ``labels`` has ``id_col`` and ``label_col`` (0 or 1; other values and nulls are left out). Only rows
    with ``held_out`` false are learned from, at most about ``max_fit_rows`` of them, chosen by a hash
    of the id; every statistic of the corpus covers all rows. ``score`` is the calibrated probability
    of label 1; without labels of both classes it is their mean (0.5 without any). Null texts
    count as empty; null ids are scored and never learned from; repeated rows repeat and a label
    repeated for an id counts each time; an empty table gives an empty one. Other columns are
    read only for ``row``, where any name is safe.
    """
    spark = docs.sparkSession
    prepare(spark)
    keep = ["row"] if with_row else []
    rows = docs.select(F.col(id_col).cast("long").alias("id"), *([F.struct(*docs.columns).alias("row")] if with_row else []), text_or_empty(text_col).alias("_text"))
    xs = statistics()
    d = len(xs)
    table = scratch(with_counts(rows, "_text").select("id", *keep, F.array(*[x.cast("double") for x in xs]).alias("x")), "statistics")
    spread = table.agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(d)], *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(d)]).first()
    mean = np.array([spread[f"m{i}"] or 0.0 for i in range(d)])
    scale = np.array([spread[f"s{i}"] or 0.0 for i in range(d)])
    scale[scale < 1e-9] = 1.0
    maps = feature_map(d)

    marked = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)").where(~is_held_out(F.col("id")))
    n = marked.count()
    place = F.pmod(F.xxhash64(F.col("id"), F.lit(SEED)), F.lit(1 << 30)) / (1 << 30)
    part = F.pmod(F.xxhash64(F.col("id"), F.lit(SEED + 1)), F.lit(4))
    chosen = marked.where(place < min(1.0, max_fit_rows / max(n, 1)))
    fit = scratch(table.select("id", "x").join(chosen, "id").withColumn("part", part).repartition(FIT_PARTS), "fit")

    def sums(batches):
        a, b = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), float).reshape(-1, d)
            f = fourier(x, mean, scale, maps)
            a += f.T @ f
            b += f.T @ np.asarray(batch.column(1), float)
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()), pa.array([b.tobytes()], pa.binary())], names=["a", "b"])

    a, b = np.eye(FEATURES + 1) * 1e-9, np.zeros(FEATURES + 1)
    learn = fit.where("part < 3")
    size = learn.count()
    for row in learn.select("x", F.col("y").cast("double").alias("y")).coalesce(FIT_PARTS).mapInArrow(sums, "a binary, b binary").collect():  # FIT_PARTS rows
        a += np.frombuffer(row["a"]).reshape(a.shape)
        b += np.frombuffer(row["b"])
    coef = np.linalg.solve(a + ridge * max(size, 1) / FEATURES * np.diag([1.0] * FEATURES + [0.0]), b)

    @F.pandas_udf("double")
    def raw(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        return pd.Series(fourier(np.stack(x.to_list()), mean, scale, maps) @ coef)

    low, high = SPAN
    bin_of = F.floor((F.least(F.greatest(raw("x"), F.lit(low)), F.lit(high - 1e-9)) - low) / (high - low) * BINS).cast("int")
    counted = fit.where("part = 3").select(bin_of.alias("bin"), "y").groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("hits")).orderBy("bin").collect()  # BINS rows
    both = {r["y"] for r in fit.select("y").distinct().collect()}
    if len(both) < 2 or not counted:
        prior = {0: 0.0, 1: 1.0}[both.pop()] if len(both) == 1 else 0.5
        return table.select("id", *keep, is_held_out(F.col("id")).alias("held_out"), F.lit(prior).alias("score"))
    at = np.array([low + (r["bin"] + 0.5) * (high - low) / BINS for r in counted])
    rate = isotonic(np.array([r["n"] for r in counted], float), np.array([r["hits"] for r in counted], float))

    @F.pandas_udf("double")
    def calibrated(score: pd.Series) -> pd.Series:
        return pd.Series(np.interp(score.to_numpy(float), at, rate))

    return table.select("id", *keep, is_held_out(F.col("id")).alias("held_out"), calibrated(raw("x")).alias("score"))
