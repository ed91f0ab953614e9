"""Line deduplication against a brute-force version."""

import hashlib
import random
import re

from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import line_dedup

from .common import clashing, frame, odd_rows, rows_of


def key(line):
    line = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
    return re.sub("[A-Z]", lambda m: m[0].lower(), line)


def brute(rows, min_chars=1, min_docs=10, keep_first=False):
    """Rows equal in id and text are one document."""
    holders: dict = {}
    for d, t in set(rows):
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add((d is None, d or 0, line_order(d, t)))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept, first_done = [], set()
        for line in lines:
            k = key(line)
            gone = len(k) >= min_chars and len(holders[k]) >= min_docs
            if gone and keep_first and min(holders[k]) == (d is None, d or 0, line_order(d, t)) and k not in first_done:
                first_done.add(k)
                gone = False
            if not gone:
                kept.append(line)
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def line_order(d, t):
    return t or ""


def got(docs, **options):
    out = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs, **options))
    return rows_of(out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256)))


def shared_lines(seed=5, n=150):
    rng = random.Random(seed)
    common = [f"Common line {i}" for i in range(40)]
    rows = []
    for i in range(n):
        lines = [rng.choice(common) if rng.random() < 0.5 else f"own {i} {k}" for k in range(rng.randrange(12))]
        lines += ["  HOT line\t", "hot LINE"] if i % 3 else []
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    return rows


def test_matches_brute_force(spark):
    rows = shared_lines()
    assert got(frame(spark, rows)) == brute(rows)
    assert got(frame(spark, rows), min_docs=3, min_chars=6) == brute(rows, 6, 3)


def test_keep_first(spark):
    rows = shared_lines(6)
    assert got(frame(spark, rows), keep_first=True) == brute(rows, keep_first=True)


def test_hot_line_is_cut_over_ranges(spark):
    """A line that all documents hold spans many ranges; the result is the same."""
    rows = [(i, "everywhere\nown %d\nrare %d" % (i, i // 9)) for i in range(2000)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = frame(spark, rows, 16)
        runs = line_dedup.stream_runs(line_dedup.line_postings(docs, "doc_id", "text", 1), 10)
        hot = runs.where("kind = 'drop'").groupBy(F.spark_partition_id()).count().count()
        assert hot >= 2
        assert got(docs) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_undecided_rows_stay_below_the_limit(spark):
    rows = [(i, f"a{i % 700}") for i in range(4000)]
    runs = line_dedup.stream_runs(line_dedup.line_postings(frame(spark, rows), "doc_id", "text", 1), 10)
    parts = runs.select(F.spark_partition_id().alias("p"), "kind").groupBy("p", "kind").count().collect()
    assert all(r["count"] <= 2 * 9 for r in parts if r["kind"] == "open")
    assert got(frame(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    rows = [r[:2] for r in odd_rows()]
    expected = brute(rows, 1, 3)
    assert got(frame(spark, odd_rows()), min_docs=3) == expected
    assert got(clashing(frame(spark, odd_rows())), min_docs=3) == expected


def test_repeated_rows_are_one_document(spark):
    """A row repeated 10 times reaches no limit alone; four copies do not lift a line of 7 documents over it."""
    rows = [(1, "only here\nand here")] * 10 + [(2, "seven hold this\nown")] * 4 + [(i, f"seven hold this\nown {i}") for i in range(3, 9)]
    rows += [(None, "ten hold this")] * 3 + [(i, "ten hold this") for i in range(20, 29)]
    expected = brute(rows)
    assert [r[2] for r in expected if r[0] in (1, 2)] == [0] * 14
    assert [r[2] for r in expected if r[0] is None] == [1] * 3
    for parts in (1, 7):
        assert got(frame(spark, rows, parts)) == expected
        named = [(29 if d is None else d, t) for d, t in rows]
        assert got(frame(spark, named, parts), keep_first=True) == brute(named, keep_first=True)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # copies lie in several batches
    try:
        assert got(frame(spark, rows)) == expected
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_pipeline_stage_keeps_repeated_rows(spark):
    rows = [(1, "own a\nown b")] * 10
    assert rows_of(corpus_pipeline.drop_lines(spark, frame(spark, rows), ""), "doc_id", "text") == rows


def test_empty_table(spark):
    assert got(frame(spark, [(1, "a")]).limit(0)) == []


def test_bitmap_is_all_that_returns(spark):
    docs = frame(spark, [(i, "x\nshared") for i in range(12)])
    maps = line_dedup.line_bitmaps(docs)
    assert maps.columns == ["_row_id", "_row_null", "_row_hash", "n_lines", "n_dropped", "bitmap"]
    assert rows_of(maps, "n_lines", "n_dropped") == [(2, 2)] * 12


def test_pipeline_stage_updates_the_text(spark):
    docs = frame(spark, [(i, f"own {i}\nshared") for i in range(12)] + [(100, None)])
    out = corpus_pipeline.drop_lines(spark, docs, "")
    assert out.columns == docs.columns
    assert rows_of(out, "doc_id", "text", "n_chars") == sorted([(i, f"own {i}", len(f"own {i}")) for i in range(12)] + [(100, None, None)], key=repr)
