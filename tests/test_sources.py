"""Image sources on hand-made PNG files, manifests, path strings, quality checks."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.strings import normalise_path, strip_prefix
from tessera.operators.quality import assert_clean, dq_summary
from tessera.sources.images import convert_pixels, decode_images, list_image_dir, read_manifest_csv, resize_bilinear
from tessera.sources.png import encode_png


@pytest.fixture(scope="module")
def image_dir():
    d = tempfile.mkdtemp(prefix="tessera-img-")
    os.makedirs(f"{d}/images/ramp")
    os.makedirs(f"{d}/images/colour")
    ramp = np.array([[0, 10, 20, 30], [40, 50, 60, 70], [80, 90, 100, 110]], dtype=np.uint8)  # 3×4 grey
    open(f"{d}/images/ramp/r.png", "wb").write(encode_png(ramp))
    col = np.zeros((2, 2, 3), dtype=np.uint8)
    col[:, :] = [200, 100, 50]  # constant RGB
    open(f"{d}/images/colour/c.png", "wb").write(encode_png(col))
    open(f"{d}/images/colour/bad.png", "wb").write(b"not an image")
    with open(f"{d}/manifest.csv", "w") as f:
        f.write("./images/ramp/r.png,ramp\n./images/colour/c.png,colour\nimages/colour/c.png,colour\n")
    return d


def test_grey_decode_exact(spark, image_dir):
    df = decode_images(spark, f"{image_dir}/images/ramp", mode="gray")
    r = df.collect()[0]
    assert (r.h, r.w, r.c) == (3, 4, 1)
    assert np.allclose(r.data, (np.arange(12) * 10 / 255.0).astype(np.float32))


def test_colour_decode_rgb_and_grey_conversion(spark, image_dir):
    rgb = decode_images(spark, f"{image_dir}/images/colour", mode="color").collect()
    assert len(rgb) == 1  # the invalid file is dropped
    assert np.allclose(np.array(rgb[0].data).reshape(2, 2, 3)[0, 0], np.array([200, 100, 50]) / 255.0, atol=1e-7)
    bgr = decode_images(spark, f"{image_dir}/images/colour", mode="color", channel_order="bgr").collect()
    assert np.allclose(np.array(bgr[0].data).reshape(2, 2, 3)[0, 0], np.array([50, 100, 200]) / 255.0, atol=1e-7)
    grey = decode_images(spark, f"{image_dir}/images/colour", mode="gray").collect()
    assert np.allclose(grey[0].data[0], round(0.299 * 200 + 0.587 * 100 + 0.114 * 50) / 255.0, atol=1e-7)


def test_resize_bilinear_half_pixel():
    img = np.array([[0.0, 100.0], [100.0, 200.0]])[:, :, None]
    up = resize_bilinear(img, 4, 4)[:, :, 0]
    assert up[0, 0] == 0.0 and up[3, 3] == 200.0
    assert np.isclose(up[1, 1], 0.75 * 0.75 * 0 + 2 * 0.75 * 0.25 * 100 + 0.25 * 0.25 * 200)
    assert np.allclose(resize_bilinear(img, 2, 2), img)
    out = convert_pixels(bytes([0, 255, 255, 0]), 2, 2, 1, (1, 1), "gray")
    assert out.shape == (1, 1, 1) and np.isclose(out[0, 0, 0], 128 / 255.0)


def test_manifest_prefix_and_missing(spark, image_dir):
    m = read_manifest_csv(spark, f"{image_dir}/manifest.csv", root=f"{image_dir}", prefix="./")
    paths = sorted(r.image_path for r in m.collect())
    assert paths == sorted([f"{image_dir}/images/ramp/r.png", f"{image_dir}/images/colour/c.png", f"{image_dir}/images/colour/c.png"])
    empty = read_manifest_csv(spark, f"{image_dir}/nope.csv", root=image_dir)
    assert empty.count() == 0


def test_image_dir_listing(spark, image_dir):
    d = list_image_dir(spark, f"{image_dir}/images")
    got = sorted((r.label, os.path.basename(r.image_path)) for r in d.collect())
    assert got == [("colour", "bad.png"), ("colour", "c.png"), ("ramp", "r.png")]
    with pytest.raises(ValueError):
        list_image_dir(spark, f"{image_dir}/images/ramp/..//missing-dir-none")


def test_normalise_path_with_dotdot(spark):
    df = spark.createDataFrame([("a/./b//c/../d",), ("/x/../../y",), ("../z",)], "p string")
    got = [r[0] for r in df.select(normalise_path(F.lit("/root/data"), F.col("p"))).collect()]
    assert got == ["/root/data/a/b/d", "/root/y", "/root/z"]
    s = spark.createDataFrame([("./img/a.png",), ("b.png",)], "p string").select(strip_prefix("p", "./img/")).collect()
    assert [r[0] for r in s] == ["a.png", "b.png"]


def test_dq_summary_and_assert_clean(spark):
    df = spark.createDataFrame([(1.0, "a", [1.0, 2.0]), (float("nan"), None, [1.0])], "x double, s string, a array<double>")
    rows = {r.col_name: r for r in dq_summary(df, array_shapes={"a": 2}).collect()}
    assert rows["x"].n_nan == 1 and rows["s"].n_null == 1 and rows["a"].n_nan == 1
    with pytest.raises(ValueError):
        assert_clean(df.select("x"))
    assert_clean(df.select("s").where("s is not null"))


def test_observe_quality_rides_on_the_main_job(spark):
    from tessera.operators.quality import observe_quality

    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (3.0, "c")], "x double, s string")
    observed, obs = observe_quality(df.where("x > 0 or isnan(x)"), "q1")
    observed.write.format("noop").mode("overwrite").save()
    got = obs.get
    assert got["rows"] == 3 and got["x__bad"] == 1 and got["s__bad"] == 1 and got["x__max"] == 3.0


def test_mixed_shapes_in_one_batch(spark, image_dir):
    rows = {os.path.basename(r.image_path): r for r in
            decode_images(spark, f"{image_dir}/images", size=(2, 2), mode="color").collect()}
    assert set(rows) == {"r.png", "c.png"}
    assert all((r.h, r.w, r.c, len(r.data)) == (2, 2, 3, 12) for r in rows.values())
    ramp = np.array([[0, 10, 20, 30], [40, 50, 60, 70], [80, 90, 100, 110]], dtype=float)[:, :, None]
    want = np.clip(np.rint(resize_bilinear(ramp, 2, 2)), 0, 255) / 255.0
    assert np.allclose(np.array(rows["r.png"].data).reshape(2, 2, 3)[..., 0], want[..., 0], atol=1e-7)


def test_file_names_with_escaped_characters_are_kept(spark, tmp_path):
    from tessera.plans.images import prepare_image_sets
    from tessera.sources.images import image_batch

    names = ["a b.png", "c%20d.png", "e+f.png", "g#h.png", "\u00e9.png"]
    for cls in ("one", "two"):
        (tmp_path / cls).mkdir()
        for n in names:
            (tmp_path / cls / n).write_bytes(encode_png(np.full((2, 2), 7, np.uint8)))
    listed = list_image_dir(spark, str(tmp_path))
    batch = image_batch(listed, decode_images(spark, str(tmp_path)))
    assert sorted(r.image_path for r in batch.collect()) == sorted(str(tmp_path / c / n) for c in ("one", "two") for n in names)
    sets = prepare_image_sets(spark, str(tmp_path), (2, 2))
    assert sets.where("data IS NOT NULL").count() == 10


def test_unreadable_images_fail_or_are_returned_and_shift_no_label(spark, tmp_path):
    from tessera.sources.images import image_batch

    for cls, data in (("bad", b"broken"), ("cls", encode_png(np.zeros((2, 2), np.uint8)))):
        (tmp_path / cls).mkdir()
        (tmp_path / cls / "x.png").write_bytes(data)
    listed, images = list_image_dir(spark, str(tmp_path)), decode_images(spark, str(tmp_path))
    with pytest.raises(Exception, match="cannot be decoded"):
        image_batch(listed, images).collect()
    kept = {r.label_name: (r.label, r.data) for r in image_batch(listed, images, unreadable="keep").collect()}
    assert kept["bad"] == (0, None) and kept["cls"][0] == 1


def test_images_are_decoded_once(spark, image_dir, tmp_path):
    from tessera.plans.images import prepare_image_sets

    (tmp_path / "k").mkdir()
    for i in range(4):
        (tmp_path / "k" / f"{i}.png").write_bytes(encode_png(np.zeros((2, 2), np.uint8)))
    plan = prepare_image_sets(spark, str(tmp_path), (2, 2), stratify=False)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_probability_sums_report_bad_vectors(spark):
    from tessera.operators.quality import probability_sums

    nan, inf = float("nan"), float("inf")
    good = [[0.25, 0.75], [1.0, 0.0], [0.1] * 10]
    bad = [None, [], [0.5, 0.4], [1.5, -0.5], [nan, 1.0], [inf, 0.0], [None, 1.0]]
    df = spark.createDataFrame([(p,) for p in good + bad], "probs array<double>")
    assert tuple(probability_sums(df, "probs").first()) == (10, 7)


def test_predicted_probabilities_are_checked(spark, monkeypatch):
    import __spark_entry__ as E
    from pyspark.sql import functions as F
    from tessera.queries import q_tensor

    from .conftest import SF_SMALL

    rows, off = E.queries()["dq_probabilities"](spark, SF_SMALL).first()
    assert rows > 0 and off == 0
    real = q_tensor.score
    spoilt = lambda *a, **k: real(*a, **k).withColumn("probs", F.transform("probs", lambda p: p * 1.01))
    monkeypatch.setattr(q_tensor, "score", spoilt)
    assert tuple(E.queries()["dq_probabilities"](spark, SF_SMALL).first()) == (rows, rows)


def test_decoded_images_are_never_broadcast(spark, tmp_path):
    from tessera.sources.images import decode_images, image_batch, list_image_dir
    from tessera.sources.png import encode_png, write_bytes

    for i in range(4):
        write_bytes(f"{tmp_path}/imgs/{i % 2}/{i}.png", encode_png(np.full((8, 8), i, np.uint8)))
    root = f"{tmp_path}/imgs"
    got = image_batch(list_image_dir(spark, root), decode_images(spark, root, size=(8, 8)))
    assert got.count() == 4
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [image_path" in plan and "BroadcastHashJoin [image_path" not in plan


def _filtered_png(img, kinds):
    """A plain PNG whose lines are filtered by ``kinds``, written pixel by pixel from the PNG rules."""
    import struct
    import zlib

    from tessera.sources.png import CHANNELS, PLAIN_START, _chunk

    def nearest(a, b, c):
        return min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]

    h, w, n = img.shape
    p = np.pad(img.astype(int), ((1, 0), (1, 0), (0, 0)))
    raw = bytearray()
    for y in range(h):
        raw.append(kinds[y])
        for x in range(w):
            for j in range(n):
                a, b, c = p[y + 1, x, j], p[y, x + 1, j], p[y, x, j]
                raw.append(int(p[y + 1, x + 1, j] - [0, a, b, (a + b) // 2, nearest(a, b, c)][kinds[y]]) % 256)
    kind = {v: k for k, v in CHANNELS.items()}[n]
    head = struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)
    whole = PLAIN_START[:8] + _chunk(b"IHDR", head) + _chunk(b"gAMA", struct.pack(">I", 45455))
    body = zlib.compress(bytes(raw))
    return whole + _chunk(b"IDAT", body[:9]) + _chunk(b"IDAT", body[9:]) + _chunk(b"IEND", b"")


def _odd_png(kind):
    import struct
    import zlib

    from tessera.sources.png import PLAIN_START, _chunk

    if kind == "palette":
        head, more, raw = (2, 2, 8, 3, 0, 0, 0), _chunk(b"PLTE", bytes([10, 20, 30, 200, 100, 50])), b"\0\0\1\0\1\0"
    else:  # one bit a pixel
        head, more, raw = (8, 2, 1, 0, 0, 0, 0), b"", b"\0\xaa\0\x0f"
    return PLAIN_START[:8] + _chunk(b"IHDR", struct.pack(">IIBBBBB", *head)) + more + _chunk(b"IDAT", zlib.compress(raw)) + _chunk(b"IEND", b"")


def test_png_files_are_decoded_as_the_image_source_does(spark, tmp_path, monkeypatch):
    from tessera.sources import images

    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 4):
        for h, w in ((1, 1), (1, 6), (7, 1), (5, 9), (9, 5)):
            img = rng.integers(0, 256, (h, w, n), dtype=np.uint8)
            (tmp_path / f"{n}-{h}x{w}.png").write_bytes(_filtered_png(img, rng.integers(0, 5, h)))
    real = images._decode_others
    monkeypatch.setattr(images, "_decode_others", lambda *a: pytest.fail("plain files need no other decoder"))

    def rows(df):
        return {os.path.basename(r.image_path): (r.h, r.w, r.c, r.data) for r in df.collect()}

    for size, mode, order in ((None, "color", "rgb"), (None, "gray", "rgb"), ((4, 3), "color", "bgr")):
        got, want = rows(decode_images(spark, str(tmp_path), size, mode, order)), rows(real(spark, str(tmp_path), size, mode, order))
        assert len(want) == 20 and got == want


@pytest.mark.parametrize("listed", [10, 1])
def test_other_files_beside_png_are_decoded_by_the_image_source(spark, tmp_path, monkeypatch, listed):
    from tessera.sources import images

    monkeypatch.setattr(images, "LISTED_FILES", listed)
    (tmp_path / "a [1]{x}").mkdir()
    whole = encode_png(np.full((3, 3), 9, np.uint8))
    files = {"plain.png": whole, "a [1]{x}/palette*.png": _odd_png("palette"), "a [1]{x}/bits?.png": _odd_png("bits"), "no.png": b"no"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    got = {os.path.basename(r.image_path): np.rint(np.array(r.data) * 255).astype(int).tolist() for r in decode_images(spark, str(tmp_path)).collect()}
    want = {r.image_path: r.data for r in images._decode_others(spark, str(tmp_path), None, "gray", "rgb").collect()}
    assert got == {os.path.basename(p): np.rint(np.array(d) * 255).astype(int).tolist() for p, d in want.items()}
    assert set(got) == {"plain.png", "palette*.png", "bits?.png"} and got["plain.png"] == [9] * 9 and got["palette*.png"] == [18, 124, 124, 18]


def test_a_damaged_png_is_dropped_like_other_invalid_files(spark, tmp_path):
    whole = encode_png(np.arange(64, dtype=np.uint8).reshape(8, 8))
    (tmp_path / "whole.png").write_bytes(whole)
    (tmp_path / "short.png").write_bytes(whole[:45])
    (tmp_path / "spoilt.png").write_bytes(whole[:41] + b"\xff" * 10 + whole[51:])
    assert [os.path.basename(r.image_path) for r in decode_images(spark, str(tmp_path)).collect()] == ["whole.png"]


def test_many_small_files_take_few_tasks_and_one_listing(spark, tmp_path):
    from tessera.plans.images import prepare_image_sets
    from tessera.sources.images import TASKS_PER_CORE

    for cls in ("one", "two"):
        (tmp_path / cls).mkdir()
        for i in range(60):
            (tmp_path / cls / f"{i}.png").write_bytes(encode_png(np.full((2, 2), i, np.uint8)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # a scan partition a file
    try:
        most = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
        assert most < 120 == spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path)).rdd.getNumPartitions()
        assert list_image_dir(spark, str(tmp_path)).rdd.getNumPartitions() <= most
        assert decode_images(spark, str(tmp_path)).rdd.getNumPartitions() <= most
        sets = prepare_image_sets(spark, str(tmp_path), (2, 2))
        plan = sets._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1  # the decoding alone: labels and sets do not list the folder again
        assert sets.where("data IS NOT NULL").count() == 120
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_image_sets_list_the_folder_once(spark, tmp_path, monkeypatch):
    from tessera.plans import images as plan
    from tessera.sources import images

    for cls in ("one", "two"):
        (tmp_path / cls).mkdir()
        for i in range(10):
            (tmp_path / cls / f"{i}.png").write_bytes(encode_png(np.full((2, 2), i, np.uint8)))
    listed = []
    real = images.image_files
    for where in (images, plan):
        monkeypatch.setattr(where, "image_files", lambda *a, **k: listed.append(a[1]) or real(*a, **k))
    sets = plan.prepare_image_sets(spark, str(tmp_path), (2, 2))
    assert sets.where("data IS NOT NULL").count() == 20 and listed == [str(tmp_path)]


def test_image_slices_of_a_batch_keep_every_row(spark, tmp_path, monkeypatch):
    from tessera.sources import images

    rng, want = np.random.default_rng(6), {}
    for i in range(30):
        img = rng.integers(0, 256, (2 + i % 3, 3), dtype=np.uint8)
        want[f"{i}.png"] = (img.ravel() / 255.0).astype(np.float32).tolist()
        (tmp_path / f"{i}.png").write_bytes(encode_png(img))
    monkeypatch.setattr(images, "SLICE_VALUES", 20)
    found = ((n, images.read_scanlines((tmp_path / n).read_bytes()), 1) for n in sorted(os.listdir(tmp_path)))
    held = list(images._decoded_rows(found, None, "gray", "rgb"))
    got = {p: d for rb in held for p, d in zip(rb.column(0).to_pylist(), rb.column(4).to_pylist())}
    assert got == want and max(rb.num_rows for rb in held) <= 3
