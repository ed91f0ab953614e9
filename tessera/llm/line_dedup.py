"""Line deduplication over range-partitioned line hashes.

One row per distinct line of a document (128-bit key hash, document, its positions) is
range-partitioned and sorted by (hash, document, first position) and streamed. Ranges may cut a
hash that half the corpus holds, so a hot line is spread over as many tasks as its rows need:
a task decides every run that lies inside its range or already reaches the limit, and passes on
only the few rows of undecided runs at its two ends (fewer than the limit each) with one count
per end run. What comes back is a compressed keep bitmap per document, never text.
"""

from __future__ import annotations

import itertools
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, prepare, scratch, text_hash, text_or_empty, with_row_key

STRIP = " \t\n\x0b\x0c\r"
_UPPER = re.compile("[A-Z]+")


def line_key(line: str) -> str:
    """The line without white space at its ends and with A-Z in lower case."""
    line = line.strip(STRIP)
    return line.lower() if line.isascii() else _UPPER.sub(lambda m: m[0].lower(), line)


_POSTING = "h1 long, h2 long, _row_id long, _row_null boolean, _row_hash long, n_lines int, first int, at binary"


def line_postings(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per document and distinct key: hash, row key, line count, positions (uint32)."""

    def run(batches):
        for b in batches:
            for i, text in enumerate(b.column(3).to_pylist()):
                lines = text.split("\n")
                seen: dict[str, list[int]] = {}
                for k, line in enumerate(lines):
                    key = line_key(line)
                    if len(key) >= min_chars:
                        seen.setdefault(key, []).append(k)
                if not seen:
                    continue
                n = len(seen)
                h = np.frombuffer(b"".join([xxhash.xxh3_128_digest(k.encode("utf-8", "surrogatepass")) for k in seen]), ">i8").reshape(-1, 2).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h[:, 0].copy()),
                        pa.array(h[:, 1].copy()),
                        *[pa.array([b.column(c)[i].as_py()] * n, t) for c, t in ((0, pa.int64()), (1, pa.bool_()), (2, pa.int64()))],
                        pa.array([len(lines)] * n, pa.int32()),
                        pa.array([v[0] for v in seen.values()], pa.int32()),
                        pa.array([np.array(v, "<u4").tobytes() for v in seen.values()], pa.binary()),
                    ],
                    names=["h1", "h2", *ROW, "n_lines", "first", "at"],
                )

    def packed(batches):  # few large batches out of many small ones
        held, rows = [], 0
        for b in itertools.chain(run(batches), [None]):
            if b is not None:
                held.append(b)
                rows += b.num_rows
            if held and (b is None or rows >= 8192):
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0

    keyed = with_row_key(docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text")), "_id", text_hash("_text"))
    return keyed.select(*ROW, "_text").mapInArrow(packed, _POSTING)


def _one_per_row(batches):
    """Sorted postings without those equal to the one before in hash and row key (repeated rows of the
    input). Ranges are cut by these columns too, so equal ones always meet in one task."""
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = [b.column(c).to_numpy(zero_copy_only=False) for c in range(2 + len(ROW))]
        new = np.ones(b.num_rows, bool)
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        new[0] = last != [k[0] for k in keys]
        last = [k[-1] for k in keys]
        if new.any():
            yield b if new.all() else b.filter(pa.array(new))


_STREAMED = "kind string, h1 long, h2 long, _row_id long, _row_null boolean, _row_hash long, n_lines int, at binary, n long, lead boolean"


def stream_runs(postings: DataFrame, min_docs: int) -> DataFrame:
    """Stream the sorted runs; a run counts distinct row keys. ``kind`` is 'drop' (the line is in ``min_docs`` documents or more),
    'open' (an undecided row at an end of the range) or 'end' (the count of a run at an end).
    ``lead`` marks the first row of a run in this range."""

    def run(batches):
        # carried between batches: the last run's key, rows so far, held rows (fewer than min_docs)
        key, n, held, head = None, 0, [], True
        out: list[tuple] = []

        def close(last):
            edge = head or last
            if edge:
                out.append(("end", *key, None, None, None, None, None, n, None))
            if edge and n < min_docs:
                out.extend(("open", *key, *r, None, j == 0) for j, r in enumerate(held))

        for b in _one_per_row(batches):
            h1, h2 = np.asarray(b.column(0)), np.asarray(b.column(1))
            new = np.ones(len(h1), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            starts = np.flatnonzero(new)
            lengths = np.diff(np.append(starts, len(h1)))
            rest = [b.column(c) for c in (2, 3, 4, 5, 7)]
            # runs inside the batch that stay below the limit need no work at all
            work = np.flatnonzero(lengths >= min_docs)
            work = np.unique(np.concatenate(([0], work, [len(starts) - 1])))
            for w in work.tolist():
                s, m = int(starts[w]), int(lengths[w])
                k = (int(h1[s]), int(h2[s]))
                if key is not None and k != key:
                    close(False)
                    head = False
                    key = None
                if key is None:
                    key, n, held = k, 0, []
                    head = head and w == 0
                rows = list(zip(*[c.slice(s, m).to_pylist() for c in rest]))
                before, n = n, n + m
                if n < min_docs:
                    held.extend(rows)
                else:
                    rows = held + rows
                    first = 0 if before < min_docs else -1
                    out.extend(("drop", *k, *r, None, j == first) for j, r in enumerate(rows))
                    held = []
                if len(out) >= 8192:
                    yield _rows(out)
                    out.clear()
        if key is not None:
            close(True)
        if out:
            yield _rows(out)

    names = [f.strip().split(" ")[0] for f in _STREAMED.split(",")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.bool_()]

    def _rows(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    order = ["h1", "h2", "_row_id", "_row_null", "_row_hash"]
    return postings.repartitionByRange(*order).sortWithinPartitions(*order, "first").mapInArrow(run, _STREAMED)


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1, min_docs: int = 10, keep_first: bool = False) -> DataFrame:
    """Keep bitmaps of the documents that lose lines: ``(_row_id, _row_null, _row_hash, n_lines,
    n_dropped, bitmap)``; the row key is that of ``with_row_key``.

    A line's key is the line stripped of white space with A-Z lower-cased. Keys of at least
    ``min_chars`` code points found in ``min_docs`` documents or more lose all their lines, or all
    but the first one in (id, position) order with ``keep_first``. ``bitmap`` is the zlib-compressed
    bit array (first line in the highest bit, 1 = kept). A null text is one empty line; empty keys
    always stay when ``min_chars`` is positive; rows equal in id and text are one document; a null
    id is an id of its own; an empty table gives no row; other columns are not read.
    """
    prepare(docs.sparkSession)
    streamed = scratch(stream_runs(line_postings(docs, id_col, text_col, min_chars), min_docs), "line-runs")
    ends = streamed.where("kind = 'end'").groupBy("h1", "h2").agg(F.sum("n").alias("total")).where(F.col("total") >= min_docs)
    opened = streamed.where("kind = 'open'").join(ends, ["h1", "h2"], "left_semi")
    gone = streamed.where("kind = 'drop'").unionByName(opened)
    if keep_first:
        lead = gone.where("lead").groupBy("h1", "h2").agg(F.min(F.struct(*ROW)).alias("k"))
        gone = gone.join(lead, ["h1", "h2"], "left").withColumn("spare", F.coalesce(F.struct(*ROW) == F.col("k"), F.lit(False)))
    else:
        gone = gone.withColumn("spare", F.lit(False))

    def bitmaps(batches):
        for b in batches:
            out = []
            for n, ats, spares in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), b.column(5).to_pylist()):
                bits = np.ones(n, np.uint8)
                for at, spare in zip(ats, spares):
                    bits[np.frombuffer(at, "<u4")[int(spare) :]] = 0
                out.append((int(n - bits.sum()), zlib.compress(np.packbits(bits).tobytes())))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], b.column(3), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())],
                names=[*ROW, "n_lines", "n_dropped", "bitmap"],
            )

    grouped = gone.groupBy(*ROW).agg(F.max("n_lines").alias("n_lines"), F.collect_list("at").alias("ats"), F.collect_list("spare").alias("spares"))
    return grouped.mapInArrow(bitmaps, "_row_id long, _row_null boolean, _row_hash long, n_lines int, n_dropped long, bitmap binary").where("n_dropped > 0")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, kept_text, n_lines, n_dropped)`` for every input row: ``row`` is the input row as a
    struct, ``n_lines`` counts before dropping (both counts are longs)."""

    @F.pandas_udf("string")
    def kept(texts: pd.Series, maps: pd.Series) -> pd.Series:
        out = []
        for t, m in zip(texts, maps):
            if m is not None:
                lines = t.split("\n")
                bits = np.unpackbits(np.frombuffer(zlib.decompress(m), np.uint8), count=len(lines))
                t = "\n".join([lines[i] for i in np.flatnonzero(bits)])
            out.append(t)
        return pd.Series(out, dtype=object)

    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), text_or_empty(text_col).alias("_text"))
    rows = with_row_key(whole, "id", text_hash("_text")).join(bitmaps.select(*ROW, F.col("n_dropped").alias("_gone"), "bitmap"), ROW, "left")
    n_lines = F.length("_text") - F.length(F.replace("_text", F.lit("\n"), F.lit(""))) + 1
    return rows.select("row", kept("_text", "bitmap").alias("kept_text"), n_lines.cast("long").alias("n_lines"), F.coalesce("_gone", F.lit(0)).cast("long").alias("n_dropped"))
