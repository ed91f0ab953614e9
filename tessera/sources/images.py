"""Image sources: manifest CSV, class-per-folder listing, decode + resize, labelled batches.

Plain PNG files (8 bits a channel, no palette, not interlaced) are unpacked in Arrow batches with
zlib and NumPy, as Spark's ``image`` data source sets up an encoder and a temporary file for each
image; every other file is decoded by that source. Pixel conversion (channel order, grey level,
bilinear resize, /255) is NumPy on images of one shape. Listing uses ``binaryFile`` with only ``path``
selected, so file contents are never read for a listing.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.strings import normalise_path, strip_prefix
from ..session import ship_package
from .png import CHANNELS, PLAIN_KINDS, PLAIN_START, read_scanlines, unfilter

SCANS_PER_TASK = 64  # Spark's scan partitions of small files (some 32 each) that one task takes
TASKS_PER_CORE = 4  # but not fewer tasks than this a core, where Spark has as many
SLICE_VALUES = 1 << 21  # pixel values converted at a time, whatever the Arrow batch holds
LISTED_FILES = 10_000  # files other than plain PNG that are named to Spark's image source one by one
MANIFEST_SCHEMA = T.StructType([T.StructField("image_path", T.StringType()), T.StructField("label", T.StringType())])
# ITU-R BT.601 luma weights for R, G, B (grey level of a colour image).
GREY_WEIGHTS = (0.299, 0.587, 0.114)


def uri_to_path(col) -> F.Column:
    """'file:///x/y' or 'file:/x/y' → '/x/y' (other schemes are kept)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, r"^file:/*", "/")


def origin_to_path(col) -> F.Column:
    """An image's origin is a percent-encoded URI; listings have plain paths. '+' stands for itself."""
    return uri_to_path(F.url_decode(F.replace(F.col(col), F.lit("+"), F.lit("%2B"))))


def in_fewer_tasks(files: DataFrame) -> DataFrame:
    """A scan of many small files with enough files a task. Spark counts the opening of a file as 4 MB, so a
    task gets some 32 of them, less work than starting it. A narrow ``coalesce``: files are not moved."""
    scans = files.rdd.getNumPartitions()
    return files.coalesce(max(1, math.ceil(scans / SCANS_PER_TASK), TASKS_PER_CORE * files.sparkSession.sparkContext.defaultParallelism))


# ----------------------------------------------------------------------------- manifests
def read_manifest_csv(spark: SparkSession, path: str, root: str, prefix: str | None = None) -> DataFrame:
    """Header-less ``image_path,label`` CSV. A known ``prefix`` (e.g. './images/') is dropped when
    present; each path is rooted at ``root`` and normalised. A missing file gives an empty frame;
    any other failure is raised."""
    try:
        df = spark.read.schema(MANIFEST_SCHEMA).option("header", "false").csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    p = F.trim(F.col("image_path"))
    if prefix:
        p = strip_prefix(p, prefix)
    return df.select(normalise_path(F.lit(root), p).alias("image_path"), F.trim(F.col("label")).alias("label"))


def image_files(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """(path, content, …) of the files under ``paths``. The driver lists them here, once for all that is made of it."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        return reader.load(paths)
    except AnalysisException as e:
        raise ValueError(f"no images under {paths}") from e


def list_image_dir(spark: SparkSession, root: str, glob: str | None = None, files: DataFrame | None = None) -> DataFrame:
    """``root/<class>/<file>`` → (image_path, label) with label = the class folder name.

    Only entries exactly two levels below ``root`` count. Raises when nothing is found. ``files`` may carry
    the :func:`image_files` of ``root``.
    """
    found = files if files is not None else image_files(spark, root, glob)
    files = in_fewer_tasks(found.select(uri_to_path("path").alias("image_path")))
    base = root.rstrip("/")
    if base.startswith("file:"):
        base = "/" + base[5:].lstrip("/")
    rel = F.substring(F.col("image_path"), len(base) + 2, 1 << 30)
    parts = F.split(rel, "/")
    out = files.where(F.col("image_path").startswith(base + "/") & (F.size(parts) == 2)).select(
        "image_path", F.element_at(parts, 1).alias("label")
    )
    if out.isEmpty():
        raise ValueError(f"no images under {root}")
    return out


def dataset_summary(df: DataFrame, label: str = "label") -> DataFrame:
    """Row count and distinct label count (one aggregate)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(label).alias("n_labels"))


# ----------------------------------------------------------------------------- decoding
def _bilinear_axis(n_in: int, n_out: int):
    """Source index pairs and weights for half-pixel-centre bilinear resampling."""
    scale = n_in / n_out
    f = (np.arange(n_out) + 0.5) * scale - 0.5
    i0 = np.floor(f).astype(int)
    w = f - i0
    w = np.where(i0 < 0, 0.0, w)
    i0 = np.clip(i0, 0, n_in - 1)
    i1 = np.clip(i0 + 1, 0, n_in - 1)
    w = np.where(i0 >= n_in - 1, 0.0, w)
    return i0, i1, w


def resize_bilinear(img: np.ndarray, h: int, w: int) -> np.ndarray:
    """(H, W, C) float → (h, w, C), bilinear with half-pixel centres, edge clamped."""
    ih, iw = img.shape[:2]
    if (ih, iw) == (h, w):
        return img
    y0, y1, wy = _bilinear_axis(ih, h)
    x0, x1, wx = _bilinear_axis(iw, w)
    top = img[y0][:, x0] * (1 - wx)[None, :, None] + img[y0][:, x1] * wx[None, :, None]
    bot = img[y1][:, x0] * (1 - wx)[None, :, None] + img[y1][:, x1] * wx[None, :, None]
    return top * (1 - wy)[:, None, None] + bot * wy[:, None, None]


def convert_batch(a: np.ndarray, size: tuple[int, int] | None, mode: str, channel_order: str = "rgb") -> np.ndarray:
    """(N, H, W, C) uint8 images of one shape (Spark image source: BGR(A) order) → float32
    (N, h, w, C') in [0, 1]: channel order / grey level, bilinear resize, /255 — vectorised."""
    a = a.astype(np.float64)
    n_channels = a.shape[3]
    if n_channels >= 3:
        bgr = a[..., :3]
        if mode == "gray":
            b, g, r = bgr[..., 0], bgr[..., 1], bgr[..., 2]
            a = np.rint(GREY_WEIGHTS[0] * r + GREY_WEIGHTS[1] * g + GREY_WEIGHTS[2] * b)[..., None]
        else:
            a = bgr if channel_order == "bgr" else bgr[..., ::-1]
    elif mode == "color":
        a = np.repeat(a, 3, axis=3)
    if size is not None and a.shape[1:3] != tuple(size):
        a = np.clip(np.rint(resize_bilinear_batch(a, size[0], size[1])), 0, 255)
    return (a / 255.0).astype(np.float32)


def resize_bilinear_batch(img: np.ndarray, h: int, w: int) -> np.ndarray:
    """(N, H, W, C) → (N, h, w, C) with :func:`resize_bilinear`'s rule."""
    _, ih, iw, _ = img.shape
    y0, y1, wy = _bilinear_axis(ih, h)
    x0, x1, wx = _bilinear_axis(iw, w)
    top = img[:, y0][:, :, x0] * (1 - wx)[None, None, :, None] + img[:, y0][:, :, x1] * wx[None, None, :, None]
    bot = img[:, y1][:, :, x0] * (1 - wx)[None, None, :, None] + img[:, y1][:, :, x1] * wx[None, None, :, None]
    return top * (1 - wy)[None, :, None, None] + bot * wy[None, :, None, None]


def convert_pixels(raw: bytes, height: int, width: int, n_channels: int, size: tuple[int, int] | None, mode: str,
                   channel_order: str = "rgb") -> np.ndarray:
    """One decoded image's bytes → float32 HWC in [0, 1] (see :func:`convert_batch`)."""
    a = np.frombuffer(raw, dtype=np.uint8).reshape(1, height, width, n_channels)
    return convert_batch(a, size, mode, channel_order)[0]


def decode_images(
    spark: SparkSession,
    paths: str | list[str],
    size: tuple[int, int] | None = None,
    mode: str = "gray",
    channel_order: str = "rgb",
    flatten: bool = False,
    files: DataFrame | None = None,
) -> DataFrame:
    """Decode image files → (image_path, h, w, c, data array<float>), values in [0, 1].

    ``mode`` 'gray' gives C=1, 'color' C=3 (RGB unless ``channel_order='bgr'``). Invalid files
    are dropped by the source. ``flatten`` only records that the array is consumed as H·W
    (the layout is row-major either way). ``files`` may carry the :func:`image_files` of ``paths``.
    """
    if mode not in ("gray", "color"):
        raise ValueError("mode must be 'gray' or 'color'")
    ship_package(spark)
    files = in_fewer_tasks((files if files is not None else image_files(spark, paths)).select("path", "content"))
    plain = is_plain_png("content")
    n_others = files.where(~plain).count()
    out = _decode_plain(files.where(plain), size, mode, channel_order)
    if n_others > LISTED_FILES:  # Spark's image source takes a folder or given files
        return _decode_others(spark, paths, size, mode, channel_order)
    if n_others:
        others = [_as_pattern(r.path) for r in files.where(~plain).select("path").collect()]
        out = out.unionByName(_decode_others(spark, others, size, mode, channel_order))
    return out


_DECODED = "image_path string, h int, w int, c int, data array<float>"


def is_plain_png(col: str) -> F.Column:
    """Whether a file's bytes begin as a PNG that :mod:`tessera.sources.png` reads."""
    return (F.substring(col, 1, len(PLAIN_START)) == F.lit(PLAIN_START)) & F.substring(col, 25, 5).isin(PLAIN_KINDS)


def _as_pattern(path: str) -> str:
    """A file's path for a reader that takes patterns."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _decoded_rows(images, size, mode: str, channel_order: str):
    """(path, (H, W, C) pixels or (H, 1 + W·C) PNG lines, C) of images → Arrow batches of decoded rows. At most
    ``SLICE_VALUES`` values (or one image) are converted at a time, those of one shape together."""
    out_c = 1 if mode == "gray" else 3

    def convert(held):
        for key in {k: None for k, _, _ in held}:
            names = [p for k, p, _ in held if k == key]
            a = np.stack([x for k, _, x in held if k == key])
            if a.ndim == 3:  # as Spark's image source has them: BGR(A), or grey alone
                a = unfilter(a, key[-1])
                a = a[..., :1] if key[-1] < 3 else a[..., 2::-1]
            img = convert_batch(a, size, mode, channel_order)
            if not (img.min() >= 0.0 and img.max() <= 1.0):
                raise ValueError("pixel values must lie in [0, 1]")
            n, h, w, _ = img.shape
            offsets = np.arange(n + 1, dtype=np.int32) * (h * w * out_c)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array(np.full(n, v, np.int32)) for v in (h, w, out_c)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(img.ravel(), pa.float32()))],
                names=["image_path", "h", "w", "c", "data"],
            )

    held, values = [], 0
    for path, x, c in images:
        more = max(x.size, size[0] * size[1] * out_c if size is not None else x.size // c * out_c)
        if held and values + more > SLICE_VALUES:
            yield from convert(held)
            held, values = [], 0
        held.append(((*x.shape, c), path, x))
        values += more
    yield from convert(held)


def _decode_plain(files: DataFrame, size, mode: str, channel_order: str) -> DataFrame:
    def images(batches):
        for rb in batches:
            for path, data in zip(rb.column(rb.schema.names.index("image_path")), rb.column(rb.schema.names.index("content"))):
                data = data.as_py()
                lines = read_scanlines(data)
                if lines is not None:
                    yield path.as_py(), lines, CHANNELS[data[25]]

    def run(batches):
        yield from _decoded_rows(images(batches), size, mode, channel_order)

    return files.select(uri_to_path("path").alias("image_path"), "content").mapInArrow(run, _DECODED)


def _decode_others(spark: SparkSession, paths, size, mode: str, channel_order: str) -> DataFrame:
    src = in_fewer_tasks(
        spark.read.format("image").option("dropInvalid", "true").option("recursiveFileLookup", "true").load(paths)
        .select(origin_to_path("image.origin").alias("image_path"), "image.height", "image.width", "image.nChannels", "image.data")
    )

    def images(batches):
        for rb in batches:
            for path, h, w, c, raw in zip(*(rb.column(rb.schema.names.index(k)) for k in ("image_path", "height", "width", "nChannels", "data"))):
                h, w, c = h.as_py(), w.as_py(), c.as_py()
                yield path.as_py(), np.frombuffer(raw.as_buffer(), np.uint8).reshape(h, w, c), c

    def run(batches):
        yield from _decoded_rows(images(batches), size, mode, channel_order)

    return src.mapInArrow(run, _DECODED)


def encode_manifest(manifest: DataFrame, levels: list | None = None) -> DataFrame:
    """Manifest rows with ``label`` (int, 0-based rank of the sorted label names of the whole
    manifest) and ``label_name``; other columns pass through."""
    from ..operators.prep import label_encode

    named = manifest.withColumnRenamed("label", "label_name")
    return label_encode(named, "label_name", out="label", levels=levels).withColumn("label", F.col("label").cast("int"))


def image_batch(manifest: DataFrame, images: DataFrame, levels: list | None = None, unreadable: str = "fail") -> DataFrame:
    """Manifest rows with their decoded images (``h, w, c, data``), joined on the normalised path.

    Labels are fitted on the manifest before decoding, so a lost image never shifts a code. An image
    of the manifest that is missing or cannot be decoded fails the job (``unreadable='fail'``) or is
    returned with null pixels (``'keep'``). Both sides are data-sized: a shuffle equi-join. The hint keeps
    it one, as decoded pixels take far more room than the packed files that Spark sees.
    """
    if unreadable not in ("fail", "keep"):
        raise ValueError("unreadable must be 'fail' or 'keep'")
    enc = manifest if "label_name" in manifest.columns else encode_manifest(manifest, levels)
    j = enc.join(images.hint("shuffle_merge"), on="image_path", how="left")
    if unreadable == "fail":
        why = F.raise_error(F.concat(F.lit("image is missing or cannot be decoded: "), F.col("image_path")))
        j = j.withColumn("data", F.when(F.col("data").isNull(), why.cast("array<float>")).otherwise(F.col("data")))
    return j
