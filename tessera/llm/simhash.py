"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes. Two fingerprints that differ in at most ``d``
bits differ in at most ``d`` bytes, so they share at least ``8 - d`` positional bytes: the
guaranteed minimum of the count filter. A posting is therefore keyed by ``8 - d`` positions
together with their bytes (28 postings a fingerprint for ``d = 2``): only pairs that have
already reached the minimum ever meet, while single-byte postings would hold 1/256 of the
corpus each. A posting list fixes all but ``d`` bytes, so it holds at most ``256**d`` distinct
fingerprints whatever the data. Lists are streamed in key order; inside a list the shared
positional bytes of each pair are tallied from the XOR, pairs at the minimum are kept and
verified by their bit distance, and each list returns a spanning forest of its links (never
all pairs). Copies share a fingerprint and enter the index once.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, prepare, scratch, text_hash, text_or_empty, with_row_key
from .components import connected_components

SEED = 42
BLOCK = 1 << 16  # shingles hashed at a time, so a very long text needs bounded memory


def fingerprint(text: str, words: int) -> int:
    """SimHash of one text as an unsigned 64-bit number; 0 for a text without words."""
    toks = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and x20, x09-x0D only
    if not toks:
        return 0
    joined = b" ".join(toks)
    ends = np.cumsum(np.fromiter(map(len, toks), np.int64, len(toks)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(toks) - words + 1)
    starts, ends = starts[:n], ends[min(words, len(toks)) - 1 :]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for i in range(0, n, BLOCK):
        raw = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[i : i + BLOCK].tolist(), ends[i : i + BLOCK].tolist())])
        counts += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``(id, text_hash, fp)`` of every row, ``fp`` the fingerprint as a signed long."""

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, words) for t in b.column(2).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps)], names=["id", "text_hash", "fp"])

    cols = docs.select(F.col(id_col).cast("long").alias("id"), text_hash(text_col).alias("text_hash"), text_or_empty(text_col).alias("text"))
    return cols.mapInArrow(run, "id long, text_hash long, fp long")


def _masks(max_bits: int) -> list[int]:
    out = []
    for free in itertools.combinations(range(8), max_bits):
        mask = (1 << 64) - 1
        for p in free:
            mask &= ~(0xFF << (8 * p))
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def link_runs(run: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the lists in one sorted block; ``run`` numbers the lists.

    Pairs ``d`` places apart are tallied together for ``d`` = 1, 2, ... up to the longest list.
    """
    n, label = len(fps), np.arange(len(fps))
    if n < 2:
        return fps[:0], fps[:0]
    longest = int(np.bincount(run).max())
    at = np.arange(n)
    for d in range(1, longest):
        at = at[at + d < n]
        at = at[run[at] == run[at + d]]  # only lists longer than d remain
        x = fps[at] ^ fps[at + d]
        tally = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        hit = at[(tally >= 8 - max_bits) & (np.bitwise_count(x) <= max_bits)]
        if len(hit):
            label = _merge(label, hit, hit + d)
    moved = np.flatnonzero(label != np.arange(n))
    return fps[moved], fps[label[moved]]


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            return label
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        np.minimum.at(label, high, low)
        while not (label[label] == label).all():
            label = label[label]


def fingerprint_links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """``(a, b)`` links between distinct fingerprints (column ``fp``) that connect exactly what
    lies within ``max_bits`` of one another."""
    if not 1 <= max_bits <= 2:
        raise ValueError("the index bounds its lists for a distance of 1 or 2 bits")
    postings = F.explode(F.array(*[F.struct(F.lit(i).alias("at"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(_masks(max_bits))]))
    index = distinct.select(postings.alias("p"), "fp").select("p.at", "p.key", "fp").repartition("at", "key").sortWithinPartitions("at", "key", "fp")

    def run(batches):
        held = None
        for b in itertools.chain(batches, [None]):
            if b is not None:
                new = [np.asarray(c) for c in (b.column(0), b.column(1), b.column(2))]
                held = new if held is None else [np.concatenate(z) for z in zip(held, new)]
            if held is None or not len(held[0]):
                continue
            at, key, fp = held
            edge = np.flatnonzero((at[1:] != at[:-1]) | (key[1:] != key[:-1])) + 1
            cut = len(fp) if b is None else int(edge[-1]) if len(edge) else 0
            if cut:
                number = np.zeros(cut, np.int64)
                number[edge[edge < cut]] = 1
                left, right = link_runs(np.cumsum(number), fp[:cut].view(np.uint64), max_bits)
                if len(left):
                    yield pa.RecordBatch.from_arrays([pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], names=["a", "b"])
                held = [c[cut:] for c in held]

    return index.mapInArrow(run, "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 2) -> DataFrame:
    """Near-duplicate groups: one row ``(id, text_hash, fp, root, component_id)`` per input row.

    ``root`` is the group's smallest fingerprint (signed order) and ``component_id`` the smallest
    id of its rows. Fingerprints link at ``max_bits`` or fewer differing bits; groups are what is
    reachable over links. A null or empty text has fingerprint 0 and links like any other; rows
    with a null id keep their place in a group, whose ``component_id`` is null only if all ids are.
    Repeated rows return repeated rows; an empty table an empty one; other columns are not read.
    """
    prepare(docs.sparkSession)
    fps = scratch(fingerprints(docs, id_col, text_col, words), "simhash")
    distinct = fps.groupBy("fp").agg(F.min("id").alias("low"))
    roots = connected_components(fingerprint_links(distinct.select("fp"), max_bits))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = scratch(placed.select("fp", "root").join(lows, "root"), "simhash-groups")
    return fps.join(by_fp, "fp").select("id", "text_hash", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay when each near-duplicate group keeps one row: the smallest id
    (null ids last; ties by text hash; of identical rows any one). Columns as in ``docs``."""
    groups = simhash_groups(docs, id_col, text_col, words, max_bits)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("z"), "id", "text_hash")).alias("k"))
    keep = with_row_key(first.select("k.id", "k.text_hash"), "id", F.col("text_hash")).select(*ROW)
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), text_hash(text_col).alias("text_hash"))
    rows = with_row_key(whole, "id", F.col("text_hash")).select("row", *ROW)
    # the join leaves rows dealt and sorted by ROW, so dropping repeated rows needs no further shuffle
    return rows.join(keep, ROW, "left_semi").dropDuplicates(ROW).select("row.*")
