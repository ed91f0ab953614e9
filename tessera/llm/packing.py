"""Documents packed into training sequences of equal token counts and balanced attention cost.

A piece of ``n`` tokens costs ``linear * n + quadratic * n**2``: projections and feed-forward grow with
its tokens, attention (masked to the document) with their square. Every task packs groups of its own
documents: whole capacities of a long document become sequences at once, what is left of each document
goes, in descending length, to the sequence of lowest cost that has room for it. When none has room
for all of it, the document is cut over the sequences of lowest cost that have room at all, so the
sequences of a group are full. What a group cannot fill a sequence with moves on to the task's next
group; the last group's rest is laid into sequences of power-of-two lengths, which need no padding.
No row is shuffled, and a task holds one group: ``group`` sequences and the document it reads.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, text_or_empty
from .token_store import broadcast_vocabulary, check_end_id, encoder
from .words import LARGE, slices

TASK = 36  # bits of a sequence id below those of the task's number


class Piece(NamedTuple):
    id: int | None
    start: int  # tokens of the document before it
    ids: np.ndarray
    total: int  # tokens of the document


class Packer:
    """Packs the documents of a task, group by group; ``add`` and ``finish`` yield placed pieces."""

    def __init__(self, capacity: int, group: int, linear: float, quadratic: float, first_id: int = 0):
        self.capacity, self.group, self.linear, self.quadratic = capacity, group, linear, quadratic
        self.held: list[Piece] = []
        self.tokens, self.next_id = 0, first_id

    def add(self, doc_id: int | None, ids: np.ndarray):
        whole = len(ids) // self.capacity * self.capacity
        for at in range(0, whole, self.capacity):
            yield Piece(doc_id, at, ids[at : at + self.capacity], len(ids)), self.next_id, 0
            self.next_id += 1
        if whole < len(ids):
            self.held.append(Piece(doc_id, whole, ids[whole:], len(ids)))
            self.tokens += len(ids) - whole
        if self.tokens >= self.group * self.capacity:
            yield from self._pack([self.capacity] * (self.tokens // self.capacity))

    def finish(self):
        rest = self.tokens % self.capacity
        short = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        yield from self._pack([self.capacity] * (self.tokens // self.capacity) + short)

    def _pack(self, sizes: list[int]):
        size = np.array(sizes, np.int64)
        room, cost = size.copy(), np.zeros(len(size))
        pieces, self.held, self.tokens = sorted(self.held, key=lambda p: -len(p.ids)), [], 0
        for p in pieces:
            while p is not None:
                n = len(p.ids)
                fits = room >= n
                if not fits.any():
                    fits = room > 0
                    if not fits.any():
                        self.held.append(p)
                        self.tokens += n
                        break
                k = int(np.where(fits, cost, np.inf).argmin())
                take = min(n, int(room[k]))
                yield Piece(p.id, p.start, p.ids[:take], p.total), self.next_id + k, int(size[k] - room[k])
                room[k] -= take
                cost[k] += self.linear * take + self.quadratic * take * take
                p = Piece(p.id, p.start + take, p.ids[take:], p.total) if take < n else None
        self.next_id += len(size)


def pack_documents(
    docs: DataFrame,
    vocabulary_path: str,
    end_id: int,
    capacity: int = 4096,
    group: int = 512,
    linear: float = 1.0,
    quadratic: float = 1 / 12288,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, start, length, doc_tokens, sequence_id, offset, ids)`` per piece, ``ids`` as little-endian uint32 bytes.

    Each row is a document: its text's ids and ``end_id`` (a null or empty text: the end id alone; rows
    equal in id and text are packed each). Each of its ids lies in one piece, pieces of a sequence
    follow one another from offset 0, and sequences hold ``capacity`` tokens or, at most
    ``log2(capacity)`` of them a task, a smaller power of two. ``capacity`` must be a power of two. ``quadratic`` is the
    attention cost of a token pair in units of a token's other cost (six times the model's width,
    here 2,048). Sequence numbers name the task that packed them. An empty table has no pieces;
    other columns are not read.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    spark = docs.sparkSession
    prepare(spark)
    check_end_id(vocabulary_path, end_id)
    vocab = broadcast_vocabulary(spark, vocabulary_path)

    def table(placed: list):
        columns = zip(*[(p.id, p.start, len(p.ids), p.total, s, o, p.ids.astype("<u4").tobytes()) for p, s, o in placed])
        types = [pa.int64()] * 6 + [pa.binary()]
        names = ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def run(batches):
        enc = encoder(vocab.value)
        packer = Packer(capacity, group, linear, quadratic, TaskContext.get().partitionId() << TASK)
        end = np.array([end_id], enc.dtype)
        for b in batches:
            for part in slices(b, 1, LARGE):
                ids, at = enc.flat(part.column(1))
                out = []
                for doc_id, x, y in zip(part.column(0).to_pylist(), at, at[1:]):
                    out += packer.add(doc_id, np.concatenate([ids[x:y], end]))
                if out:
                    yield table(out)
        if out := list(packer.finish()):
            yield table(out)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def padding(tokens: Column, capacity: int) -> Column:
    """Padding of a sequence: none at a power of two, otherwise up to ``capacity``."""
    return F.when(F.bit_count(tokens) == 1, F.lit(0)).otherwise(F.lit(capacity) - tokens).cast("long")


def sequences(pieces: DataFrame, capacity: int = 4096, linear: float = 1.0, quadratic: float = 1 / 12288) -> DataFrame:
    """``(sequence_id, n_pieces, tokens, padding, cost)`` of packed sequences."""
    length = F.col("length")
    per = pieces.groupBy("sequence_id").agg(F.count("*").alias("n_pieces"), F.sum(length).alias("tokens"), F.sum(linear * length + quadratic * length * length).alias("cost"))
    return per.select("sequence_id", "n_pieces", "tokens", padding(F.col("tokens"), capacity).alias("padding"), "cost")
