"""Byte-level BPE by ranks: a two-tier encoder, and a decoder.

Tier one is a minimal perfect hash over the vocabulary (hash and displace: as many slots as
tokens, one candidate slot per key, verified by comparing bytes); a pre-token that is itself a
token is resolved there. Tier two merges the rest: bytes in a doubly linked list and a heap of
adjacent pairs by (rank, position), so the lowest rank goes first and the leftmost on ties, in
O(n log n) for a pre-token of any length. Short pre-tokens of a batch are merged together, by the same
rule, in numpy (``Merger``).

Pre-tokens of other texts are remembered per worker; the memory is bounded and only saves work. Plain
texts (Latin letters, digits, marks) are cut at their spaces where the pattern allows it, and each
distinct word of a batch is split and looked up once. Plain words are split by the same pattern with
its Unicode classes written out for these characters, which Python's own ``re`` runs; texts with
other characters by ``regex``, as a whole.
"""

from __future__ import annotations

import base64
import re
import sys
from array import array
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, text_or_empty
from .words import LARGE, LONGEST, Recent, slices, split_at_spaces, spread

_LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
TOGETHER = 1 << 16  # pre-tokens of a batch that are merged together
REMEMBERED = 300_000  # pre-tokens of a generation that a worker remembers


class PerfectHash:
    """Minimal perfect hash of a fixed key set with verified lookups."""

    def __init__(self, keys: list[bytes], values: list[int]):
        n = len(keys)
        self.n, self.buckets = n, max(1, n // 2)
        groups: list[list[int]] = [[] for _ in range(self.buckets)]
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        for i, h in enumerate(hashes):
            groups[(h >> 32) % self.buckets].append(i)
        slot_of, free, moves = [-1] * n, [True] * n, [0] * self.buckets
        for g in sorted(range(self.buckets), key=lambda g: -len(groups[g])):
            ids = groups[g]
            if len(ids) < 2:
                break
            d = 0
            while True:
                d += 1
                want = [self._slot(hashes[i], d) for i in ids]
                if len(set(want)) == len(want) and all(free[w] for w in want):
                    break
            moves[g] = d
            for i, w in zip(ids, want):
                slot_of[i], free[w] = w, False
        left = iter([s for s in range(n) if free[s]])
        for g, ids in enumerate(groups):
            if len(ids) == 1:  # a lone key names its slot
                slot_of[ids[0]] = next(left)
                moves[g] = -1 - slot_of[ids[0]]
        self.moves = moves
        self.keys, self.values = [b""] * n, [0] * n
        for k, v, s in zip(keys, values, slot_of):
            self.keys[s], self.values[s] = k, v

    def _slot(self, h: int, d: int) -> int:
        x = (h + d * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF  # one mixing step per displacement
        x = (x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
        return (x >> 24) % self.n

    def get(self, key: bytes) -> int | None:
        h = xxhash.xxh3_64_intdigest(key)
        d = self.moves[(h >> 32) % self.buckets]
        s = -1 - d if d < 0 else self._slot(h, d)
        return self.values[s] if self.keys[s] == key else None


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a rank file (base64 token, space, rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ranks of one pre-token after all merges: heap over linked bytes."""
    n, get = len(piece), ranks.get
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # a part is piece[i:end[i]]; end[i] starts the next
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        j = end[i]
        if j <= i or j >= n or end[j] != stop:  # a part of this pair was merged meanwhile
            continue
        end[i], end[j] = stop, -1
        if stop < n:
            before[stop] = i
            if (r := get(piece[i : end[stop]])) is not None:
                heappush(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := get(piece[p:stop])) is not None:
            heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Merger:
    """Merges of many short pre-tokens at once, with :func:`merge`'s result.

    Pre-tokens of as many parts stand in the rows of a matrix, with the ranks of their adjacent pairs
    beside. Each round merges the lowest rank of every row, the leftmost on ties, so all rows lose one
    part and go on with those that had one part less from the start. Ranks of pairs are found by
    (left rank, right rank): a vocabulary of n tokens has few more pairs than splits of its tokens.
    """

    NONE = np.iinfo(np.int32).max

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.array(sorted(pairs), np.int64)
        self.first = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        # open addressing: a key lies at its slot or in one of the next
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, self.NONE, np.int32)
        at, slot = np.arange(len(keys)), self._slot(keys)
        while len(at):
            free = np.flatnonzero(self.keys[slot] == -1)
            self.keys[slot[free]] = keys[at[free]]  # of several keys for a slot the last stays
            put = self.keys[slot] == keys[at]
            self.ranks[slot[put]] = [pairs[k] for k in keys[at[put]].tolist()]
            at, slot = at[~put], (slot[~put] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's token, ``NONE`` where there is none."""
        keys = left.astype(np.int64) << 32 | right
        slot = self._slot(keys)
        found, out = self.keys[slot], self.ranks[slot]
        at = np.flatnonzero((found != keys) & (found != -1))
        slot = slot[at]
        while len(at):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            found, out[at] = self.keys[slot], self.ranks[slot]
            going = (found != keys[at]) & (found != -1)
            at, slot = at[going], slot[going]
        return out

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each piece, as little-endian uint32. All single bytes must be tokens."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data = self.first[np.frombuffer(b"".join(pieces), np.uint8)]
        begins = np.cumsum(sizes) - sizes
        out: list[bytes] = [b""] * len(pieces)
        rows = np.zeros(0, np.int64)
        parts = ranks = np.zeros((0, 0), np.int32)

        def done(which, matrix):
            packed, step = matrix.astype("<u4").tobytes(), 4 * matrix.shape[1]
            for k, r in enumerate(which.tolist()):
                out[r] = packed[k * step : (k + 1) * step]

        for n in range(int(sizes.max(initial=0)), 0, -1):
            new = np.flatnonzero(sizes == n)
            if len(new):
                fresh = data[begins[new][:, None] + np.arange(n)]
                fresh_ranks = self.rank(fresh[:, :-1].ravel(), fresh[:, 1:].ravel()).reshape(len(new), n - 1)
                rows = np.concatenate([rows, new])
                parts = np.concatenate([parts, fresh]) if len(parts) else fresh
                ranks = np.concatenate([ranks, fresh_ranks]) if len(ranks) else fresh_ranks
            if not len(rows):
                continue
            if n == 1:
                done(rows, parts)
                break
            at = ranks.argmin(axis=1)  # the first of equals
            best = ranks[np.arange(len(rows)), at]
            ended = best == self.NONE
            if ended.any():
                done(rows[ended], parts[ended])
                rows, parts, ranks, at, best = (a[~ended] for a in (rows, parts, ranks, at, best))
            if not len(rows):
                parts = ranks = np.zeros((0, 0), np.int32)
                continue
            here = np.arange(n - 1)
            parts = np.where(here <= at[:, None], parts[:, :-1], parts[:, 1:])
            row = np.arange(len(rows))
            parts[row, at] = best
            ranks = np.where(here[:-1] < at[:, None], ranks[:, :-1], ranks[:, 1:])
            for k, side in ((np.flatnonzero(at > 0), -1), (np.flatnonzero(at < n - 2), 0)):
                left = at[k] + side
                ranks[k, left] = self.rank(parts[k, left], parts[k, left + 1])
        return out


LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff\u0100-\u017f"
_ODD = re.compile("[^\t\n\r\x20-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff\u0100-\u017f]")
_CLASSES = {"\\p{L}": LETTERS, "\\p{N}": "0-9", "\\s": " \t\n\r"}


def plain_pattern(pattern: str) -> str | None:
    """``pattern`` for texts without ``_ODD`` characters, or None if it has other classes."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        name = next((c for c in (*_CLASSES, "\\S") if pattern.startswith(c, i)), None)
        if name == "\\S" and not inside:
            out.append("[^ \t\n\r]")
        elif name in _CLASSES:
            out.append(_CLASSES[name] if inside else f"[{_CLASSES[name]}]")
        elif pattern[i] == "\\" and pattern[i + 1 : i + 2].isalnum():
            return None
        else:
            name = pattern[i : i + 2] if pattern[i] == "\\" else pattern[i]
            inside = name == "[" or inside and name != "]"
            out.append(name)
        i += len(name)
    return "".join(out)


#: A pattern that never matches across a space (x20) between two characters that are not white space,
#: and always begins a match there: texts can be cut at such spaces.
CUT_AT_SPACES = "'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+"
_INK = "\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff\u0100-\u017f"
_WORD = re.compile(f"[{_INK}](?:[\t\n\r{_INK}]*[{_INK}])?")


MARKS = frozenset(".,;:!?")


def plain_letters(word: str) -> bool:
    return word.isalpha() and (word.isascii() or max(word) < "\u0180")


class Encoder:
    """Texts to packed little-endian uint32 ids."""

    def __init__(self, pattern: str, ranks: dict[bytes, int], table: PerfectHash):
        self.ranks, self.table = ranks, table
        self.split = regex.compile(pattern).findall
        plain = plain_pattern(pattern)
        self.split_plain = re.compile(plain).findall if plain else self.split
        self.by_word = pattern == CUT_AT_SPACES
        self.tokens = Recent(self.token, REMEMBERED)
        self.packed = {r: r.to_bytes(4, "little") for r in ranks.values()}
        self.merger = Merger(ranks) if all(bytes([b]) in ranks for b in range(256)) else None

    def token(self, pre: str) -> bytes:
        piece = pre.encode("utf-8")
        whole = self.table.get(piece)
        ids = [whole] if whole is not None else merge(piece, self.ranks)
        return array("I", ids).tobytes() if _LITTLE else np.array(ids, "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.tokens.__getitem__, self.split_plain(text)))

    def _pre_tokens(self, space: str, word: str) -> list[str]:
        """Pre-tokens of a plain word, the space before it included; none for other words."""
        if plain_letters(word):
            return [space + word]
        if word[-1:] in MARKS and plain_letters(word[:-1]):
            return [space + word[:-1], word[-1]]
        return self.split_plain(space + word) if _WORD.fullmatch(word) else []

    def many(self, pres: list[str]) -> list[bytes]:
        """Packed ids of each pre-token: tokens by the perfect hash, short others merged together."""
        pieces = [p.encode("utf-8") for p in pres]
        out = [None if r is None else self.packed[r] for r in map(self.table.get, pieces)]
        short = [k for k, got in enumerate(out) if got is None and self.merger and len(pieces[k]) <= LONGEST]
        if short:
            for k, got in zip(short, self.merger([pieces[k] for k in short])):
                out[k] = got
        return [self.token(p) if got is None else got for p, got in zip(pres, out)]

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.tokens.__getitem__, self.split(text))) if _ODD.search(text) else self._plain(text)

    def batch(self, texts: pa.Array) -> list[bytes]:
        """Packed ids of each text; distinct words of plain texts are looked at once."""
        if not self.by_word:
            return [self.encode(t) for t in texts.to_pylist()]
        codes, at, words = split_at_spaces(texts)
        codes = codes.astype(np.int64)
        heads = [words[c] for c in codes[at[:-1]].tolist()]  # no space before these
        place = {w: len(words) + k for k, w in enumerate(dict.fromkeys(heads))}
        codes[at[:-1]] = [place[w] for w in heads]
        pres = [self._pre_tokens(" ", w) for w in words] + [self._pre_tokens("", w) for w in place]
        distinct = list(dict.fromkeys(chain.from_iterable(pres)))
        known = {}
        for k in range(0, len(distinct), TOGETHER):
            some = distinct[k : k + TOGETHER]
            known.update(zip(some, self.many(some)))
        got = [known[p[0]] if len(p) == 1 else b"".join([known[x] for x in p]) for p in pres]
        del pres, distinct, known
        sizes = np.fromiter(map(len, got), np.int64, len(got)) // 4
        ids, ends = spread(codes, at, sizes, np.frombuffer(b"".join(got), "<u4"))
        odd = np.flatnonzero(np.logical_or.reduceat(sizes[codes] == 0, at[:-1])) if len(codes) else []
        out = [ids[x:y].tobytes() for x, y in zip(ends, ends[1:])]
        for k in odd:  # other characters, or white space beside a space: the pattern on the whole text
            out[k] = self.encode(texts[k].as_py())
        return out


_ENCODERS: dict[tuple, Encoder] = {}
_TABLES: dict[str, np.ndarray] = {}


def vocabulary(spark: SparkSession, path: str):
    """The rank file, read on the driver, and its perfect hash as one broadcast value (its size is
    that of the vocabulary)."""
    ranks = load_ranks(path)
    return spark.sparkContext.broadcast((ranks, PerfectHash(list(ranks), list(ranks.values()))))


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` plus ``out_col``: the text's ids as little-endian uint32 bytes, as by encoding each
    match of ``pattern`` separately without special tokens. A null or empty text has no ids (empty
    bytes); all input columns and rows stay as they are.
    """
    prepare(docs.sparkSession)
    vocab = vocabulary(docs.sparkSession, path)
    key = (path, pattern)

    @F.pandas_udf("binary")
    def ids(texts: pd.Series) -> pd.Series:
        enc = _ENCODERS.get(key)
        if enc is None:
            enc = _ENCODERS[key] = Encoder(pattern, *vocab.value)
        texts = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
        return pd.Series([x for part in slices(texts, 0, LARGE) for x in enc.batch(part.column(0))], dtype=object)

    return docs.withColumn(out_col, ids(text_or_empty(text_col)))


def decode(ids: Column, spark: SparkSession, path: str) -> Column:
    """Bytes of packed ids. Ids beyond the vocabulary fail the task."""
    vocab = vocabulary(spark, path)

    @F.pandas_udf("binary")
    def text(packed: pd.Series) -> pd.Series:
        table = _TABLES.get(path)
        if table is None:
            ranks, _ = vocab.value
            table = _TABLES[path] = np.full(max(ranks.values()) + 1, None, object)
            for t, r in ranks.items():
                table[r] = t
        return packed.map(lambda b: b"".join(table[np.frombuffer(b, "<u4")].tolist()))

    return text(ids)
