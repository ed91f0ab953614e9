"""Queries for image sources and image preparation.

Stand-in input: every ``embeddings`` row becomes an 8×8 grey PNG ``<root>/<label>/<vec_id>.png``
(pixel = floor((v + 0.6) / 1.2 · 255 + 0.5), clipped to 0…255), written by a Spark job into the
shared folder, plus a header-less manifest CSV with a './images/' prefix. The queries then
list, read, decode, join, encode and split those files through the library.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..session import shared_path, ship_package
from ..sources.images import decode_images, image_batch, list_image_dir, read_manifest_csv
from ..sources.png import encode_png, filesystem
from ..sources.tables import read_table
from . import register
from .q_splits import SEED, split_sql

# Decoded images are float32 (as the reference's arrays), so the oracle narrows the same way.
PIXEL_SQL = "CAST(CAST(CAST(greatest(least(floor((CAST(v AS DOUBLE) + 0.6) / 1.2 * 255 + 0.5), 255), 0) AS DOUBLE) / 255 AS FLOAT) AS DOUBLE)"
_MADE: dict[tuple[str, str], str] = {}


def image_folder(spark, sf: str) -> str:
    """Write the stand-in image folder and manifest once per (data, shared folder)."""
    key = (sf, shared_path(spark))
    if key in _MADE:
        return _MADE[key]
    ship_package(spark)
    base = shared_path(spark, "images", uuid.uuid4().hex)
    root = base + "/images"
    e = read_table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    dealt = e.repartition(4 * spark.sparkContext.defaultParallelism)  # a file of the table may be one task's

    def write(batches):
        fs, path = filesystem(root)
        made = set()
        for pdf in batches:
            if pdf.empty:
                continue
            v = np.stack(pdf["embedding"].to_numpy()).astype(np.float32).astype(np.float64)
            px = np.clip(np.floor((v + 0.6) / 1.2 * 255 + 0.5), 0, 255).astype(np.uint8).reshape(-1, 8, 8)
            for vid, lab, p in zip(pdf["vec_id"], pdf["label"], px):
                folder = f"{path}/{int(lab)}"
                if folder not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                with fs.open_output_stream(f"{folder}/{int(vid)}.png") as f:
                    f.write(encode_png(p))
            yield pd.DataFrame({"n": [len(pdf)]})

    dealt.mapInPandas(write, "n bigint").agg(F.sum("n")).collect()
    manifest = e.select(
        F.concat(F.lit("./images/"), F.col("label").cast("string"), F.lit("/"), F.col("vec_id").cast("string"), F.lit(".png")).alias("p"),
        F.col("label").cast("string").alias("l"),
    )
    manifest.write.mode("overwrite").option("header", "false").csv(base + "/manifest")
    _MADE[key] = base
    return base


def _rel(col: str, root: str):
    return F.regexp_replace(F.col(col), "^" + root.replace(".", "\\.") + "/", "")


def _vec_id(col: str = "image_path"):
    return F.regexp_extract(F.col(col), r"/(\d+)\.png$", 1).cast("bigint")


REL_SQL = "SELECT CAST(label AS VARCHAR) || '/' || CAST(vec_id AS VARCHAR) || '.png' AS rel_path, CAST(label AS VARCHAR) AS label FROM embeddings"


@register("src_manifest_csv", REL_SQL)
def q_src_manifest_csv(spark, sf):
    base = image_folder(spark, sf)
    m = read_manifest_csv(spark, base + "/manifest", root=base + "/images", prefix="./images/")
    return m.select(_rel("image_path", base + "/images").alias("rel_path"), "label")


@register("src_image_dir", REL_SQL)
def q_src_image_dir(spark, sf):
    base = image_folder(spark, sf)
    d = list_image_dir(spark, base + "/images")
    return d.select(_rel("image_path", base + "/images").alias("rel_path"), "label")


@register(
    "src_decode_images",
    f"""SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(pos AS BIGINT) AS pos, round({PIXEL_SQL}, 6) + 0.0 AS v
FROM (SELECT vec_id, unnest(embedding) AS v, unnest(range(0, len(embedding))) AS pos FROM embeddings)""",
)
def q_src_decode_images(spark, sf):
    base = image_folder(spark, sf)
    imgs = decode_images(spark, base + "/images", size=(8, 8), mode="gray", flatten=True)
    return imgs.select(_vec_id().alias("vec_id"), F.posexplode("data").alias("pos", "v")).select(
        "vec_id", F.col("pos").cast("bigint").alias("pos"), r6("v").alias("v")
    )


def _resize_sql(n_in: int, n_out: int) -> str:
    """Oracle of decode → colour → bilinear resize (half-pixel centres, edge clamp, round half
    to even, /255 as float32) for the grey stand-in images."""
    last = n_in - 1
    return f"""
WITH px AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(greatest(least(floor((CAST(v AS DOUBLE) + 0.6) / 1.2 * 255 + 0.5), 255), 0) AS DOUBLE)) AS p
            FROM embeddings),
ax AS (SELECT CAST(range AS BIGINT) AS o, (range + 0.5) * (CAST({n_in} AS DOUBLE) / {n_out}) - 0.5 AS f FROM range({n_out})),
ax2 AS (SELECT o, CAST(least(greatest(floor(f), 0), {last}) AS BIGINT) AS i0, CASE WHEN floor(f) < 0 THEN 0.0 ELSE f - floor(f) END AS w0 FROM ax),
ax3 AS (SELECT o, i0, least(i0 + 1, {last}) AS i1, CASE WHEN i0 >= {last} THEN 0.0 ELSE w0 END AS w FROM ax2),
val AS (SELECT vec_id, ya.o AS oy, xa.o AS ox,
               (p[ya.i0 * {n_in} + xa.i0 + 1] * (1 - xa.w) + p[ya.i0 * {n_in} + xa.i1 + 1] * xa.w) * (1 - ya.w)
               + (p[ya.i1 * {n_in} + xa.i0 + 1] * (1 - xa.w) + p[ya.i1 * {n_in} + xa.i1 + 1] * xa.w) * ya.w AS v
        FROM px, ax3 ya, ax3 xa)
SELECT CAST(vec_id AS BIGINT) AS vec_id, oy AS y, ox AS x, CAST(ch AS BIGINT) AS c,
       round(CAST(CAST(greatest(least(round_even(v, 0), 255), 0) / 255 AS FLOAT) AS DOUBLE), 6) + 0.0 AS v
FROM val, range(3) t(ch)
"""


@register("src_decode_resize", _resize_sql(8, 12))
def q_src_decode_resize(spark, sf):
    """Decode as colour (grey replicated to RGB) and resize 8×8 → 12×12, bilinear."""
    base = image_folder(spark, sf)
    imgs = decode_images(spark, base + "/images", size=(12, 12), mode="color")
    e = imgs.select(_vec_id().alias("vec_id"), F.posexplode("data").alias("pos", "v"))
    return e.select(
        "vec_id",
        F.floor(F.col("pos") / 36).cast("bigint").alias("y"),
        (F.floor(F.col("pos") / 3) % 12).cast("bigint").alias("x"),
        (F.col("pos") % 3).cast("bigint").alias("c"),
        r6("v").alias("v"),
    )


@register(
    "prep_image_batch",
    f"""WITH px AS (SELECT vec_id, label, {PIXEL_SQL} AS p FROM (SELECT vec_id, label, unnest(embedding) AS v FROM embeddings))
SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(label AS INTEGER) AS label, CAST(count(*) AS BIGINT) AS n, round(sum(p), 6) + 0.0 AS total
FROM px GROUP BY vec_id, label""",
)
def q_prep_image_batch(spark, sf):
    base = image_folder(spark, sf)
    m = read_manifest_csv(spark, base + "/manifest", root=base + "/images", prefix="./images/")
    imgs = decode_images(spark, base + "/images", size=(8, 8), mode="gray")
    b = image_batch(m, imgs)
    total = F.aggregate(F.transform("data", lambda z: z.cast("double")), F.lit(0.0), lambda a, z: a + z)
    return b.select(_vec_id().alias("vec_id"), "label", F.size("data").cast("bigint").alias("n"), r6(total).alias("total"))


@register(
    "prep_image_sets",
    "WITH " + split_sql(
        f"SELECT vec_id, CAST(label AS INTEGER) AS label, list_sum(list_transform(embedding, lambda v: {PIXEL_SQL})) AS px FROM embeddings",
        "vec_id", "label", 0.2, 0.2, SEED,
        "vec_id, label, round(px, 6) + 0.0 AS total, CAST((SELECT max(label) + 1 FROM embeddings) AS INTEGER) AS n_classes"),
)
def q_prep_image_sets(spark, sf):
    """Image job end to end: manifest → decode → label encode → stratified train/val/test →
    one-hot labels with the class count fixed from the whole data."""
    from ..plans.images import prepare_image_sets

    base = image_folder(spark, sf)
    s = prepare_image_sets(spark, base + "/images", (8, 8), "gray", 0.2, 0.2, SEED,
                           manifest=base + "/manifest", prefix="./images/", id_expr=_vec_id())
    total = F.aggregate(F.transform("data", lambda z: z.cast("double")), F.lit(0.0), lambda a, z: a + z)
    return s.select(F.col("id").alias("vec_id"), "label", "set", r6(total).alias("total"), F.size("y").cast("int").alias("n_classes"))


@register("lenet5_image_run")
def q_lenet5_image_run(spark, sf):
    """The reference notebook's flow on Spark: image folder → grey decode resized to 32×32 →
    stratified 60/20/20 split → LeNet-5 trained with Adam (batch 64, four model copies on
    a seeded order, weights averaged per epoch) → accuracy and macro P/R/F1 per set."""
    from ..operators.metrics import metrics_report
    from ..plans.networks import lenet5
    from ..plans.scoring import score
    from ..plans.training import cnn_config, train_network

    from ..plans.images import prepare_image_sets

    base = image_folder(spark, sf)
    sets = prepare_image_sets(spark, base + "/images", (32, 32), "gray", 0.2, 0.2, SEED, id_expr=_vec_id())
    s = sets.select("id", "label", "data", "set")
    s = s.coalesce(spark.sparkContext.defaultParallelism).cache()  # AQE does not resize cached plans
    k = int(s.agg(F.max("label")).first()[0]) + 1
    layers = lenet5(k)
    cfg = cnn_config(epochs=2, optimizer="adam", learning_rate=0.001, batch_size=64, mode="replicas", replicas=4)
    res = train_network(s.where(F.col("set") == "train"), layers, cfg, (32, 32, 1), k, val_df=s.where(F.col("set") == "val"))
    pred = score(s, res.layers, res.params, (32, 32, 1), keep=["id", "label", "set"])
    rep = metrics_report(pred.withColumn("label", F.col("label").cast("bigint")), "label", "predicted")
    return rep.select("metric", *[r6(c).alias(c) for c in ("train", "val", "test")])
