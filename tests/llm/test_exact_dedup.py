"""Exact duplicates against a brute-force version."""

import hashlib
import random

from pyspark.sql import functions as F

from tessera.llm import exact_dedup as X
from tessera.llm.common import text_hash, with_row_key

from .common import clashing, frame, odd_rows, rows_of


def brute(rows):
    out = []
    for d, t in rows:
        same = [e for e, u in rows if (u or "") == (t or "")]
        ids = [e for e in same if e is not None]
        keep = max(ids) if ids else None
        out.append((d, keep, len(same), d == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def direct(data):
    f = 0
    for b in data:
        f = (f * X.RADIX + b) % X.P
    return f


def test_fingerprint_is_the_polynomial():
    rng = random.Random(1)
    for n in (0, 1, 2, 100, 5000, X.CHUNK):
        data = rng.randbytes(n)
        assert X.chunk_fingerprint(data) == direct(data)
    a, b = rng.randbytes(700), rng.randbytes(901)
    assert X.combine(X.chunk_fingerprint(a), X.chunk_fingerprint(b), len(b)) == direct(a + b)


def test_rows_are_fingerprinted_whole(spark):
    rows = [(1, "a" * 200_000), (2, "b" + "a" * 199_999), (3, "short"), (4, ""), (5, "é" * 40_000)]
    docs = frame(spark, rows).withColumn("_text", F.col("text"))
    keyed = with_row_key(docs, "doc_id", text_hash("text")).withColumn("sha", F.sha2("_text", 256))
    got = {r["_row_id"]: (r["size"], r["fp"]) for r in X.fingerprint_rows(keyed.select("_row_id", "_row_null", "_row_hash", "sha", "_text")).collect()}
    assert got == {d: (len(t.encode()), direct(t.encode())) for d, t in rows}


def test_matches_brute_force(spark):
    rng = random.Random(2)
    texts = [rng.choice(["", "a", "b " * 50_000, "c\n", "c", "é", "b " * 50_000 + "x"]) for _ in range(120)]
    rows = list(zip(rng.sample(range(1000), 120), texts))
    assert rows_of(X.exact_groups(frame(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    rows = [r[:2] for r in odd_rows()]
    assert rows_of(X.exact_groups(frame(spark, odd_rows()))) == brute(rows)
    assert rows_of(X.exact_groups(clashing(frame(spark, odd_rows())))) == brute(rows)


def test_empty_table(spark):
    assert X.exact_groups(frame(spark, [(1, "a")]).limit(0)).count() == 0


def test_equal_fingerprints_with_other_bytes_part(spark, monkeypatch):
    """Every text gets one fingerprint per length: only the comparison can tell them apart."""
    monkeypatch.setattr(X, "fingerprint_rows", lambda rows: rows.select("_row_id", "_row_null", "_row_hash", "sha", F.octet_length("_text").cast("long").alias("size"), F.lit(7).cast("long").alias("fp")))
    rows = [(1, "aa"), (2, "bb"), (3, "aa"), (4, "cc"), (5, "bb"), (6, "a" * 100_000), (7, "a" * 99_999 + "b"), (8, "a" * 100_000), (9, "z")]
    assert rows_of(X.exact_groups(frame(spark, rows))) == brute(rows)


def test_hot_groups_are_split(spark, monkeypatch):
    """Groups from two rows on count as hot: broadcast groups and salted chunks give the same rows."""
    monkeypatch.setattr(X, "HOT_SHARE", 2)
    monkeypatch.setattr(X, "_hot_limit", lambda fps: 2)
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "b " * 50_000, "c", "b " * 50_000 + "x", f"own {i}"])) for i in range(90)]
    assert rows_of(X.exact_groups(frame(spark, rows))) == brute(rows)
    monkeypatch.setattr(X, "fingerprint_rows", lambda rows: rows.select("_row_id", "_row_null", "_row_hash", "sha", F.octet_length("_text").cast("long").alias("size"), F.lit(7).cast("long").alias("fp")))
    assert rows_of(X.exact_groups(frame(spark, rows))) == brute(rows)
