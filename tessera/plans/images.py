"""The image preparation job: source → decode → labels → train / validation / test sets.

One DataFrame comes out, with a ``set`` column instead of six arrays: rows stay distributed,
and each set is a filter of the same plan (write it partitioned by ``set`` to materialise).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.splits import label_onehot, three_way_split
from ..session import ensure_checkpoint_dir
from ..sources.images import decode_images, encode_manifest, image_batch, image_files, list_image_dir, read_manifest_csv


def prepare_image_sets(
    spark: SparkSession,
    root: str,
    size: tuple[int, int],
    mode: str = "gray",
    val_size: float = 0.2,
    test_size: float = 0.2,
    seed: int | None = 42,
    stratify: bool = True,
    manifest: str | None = None,
    prefix: str | None = None,
    id_expr=None,
) -> DataFrame:
    """Images under ``root`` (class folders, or the rows of a header-less ``manifest`` CSV) →
    (id, image_path, label, label_name, y one-hot, h, w, c, data, set).

    Labels are the sorted class names' ranks; the one-hot width is the number of classes in
    the whole data; sets follow :func:`three_way_split` (test first, then validation from the
    rest). ``id_expr`` gives the row id (default: a hash of the path, stable across runs). An
    image that is missing or cannot be decoded fails the job.
    """
    files = image_files(spark, root)
    listing = (
        read_manifest_csv(spark, manifest, root=root, prefix=prefix) if manifest else list_image_dir(spark, root, files=files)
    )
    # labels, class count and sets need the listing alone, which is kept: it is read for each of them, and
    # listing again would ask the storage for every file. Pixels are decoded once, at the end
    ensure_checkpoint_dir(spark)
    listing = listing.checkpoint(eager=True)
    named = encode_manifest(listing).withColumn("id", id_expr if id_expr is not None else F.xxhash64("image_path"))
    k = int(named.agg(F.max("label")).first()[0]) + 1
    sets = three_way_split(named, "label", "id", val_size, test_size, seed, stratify)
    batch = image_batch(sets, decode_images(spark, root, size=size, mode=mode, files=files))
    return batch.withColumn("y", label_onehot("label", k))
