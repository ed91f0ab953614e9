"""Counts of whole texts that the quality operators build on."""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5

#: Names of the counts, in order.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_bang", "n_pipe", "n_digits", "n_stops", "n_adjacent", "n_distinct", "n_top")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more, first ones included."""
    n = len(words)
    if n <= window:
        return 0
    number: dict[bytes, int] = {}
    base = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == n:
        return 0
    # windows are numbered exactly, one word at a time: (number of the shorter window, next word)
    ids, count = base, len(number)
    for k in range(1, window):
        ids, inverse = np.unique(ids[: n - k] * count + base[k:], return_inverse=True)
        ids = inverse
    twice = np.bincount(ids)[ids] > 1
    if not twice.any():
        return 0
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_counts(text: str) -> tuple[int, ...]:
    """The counts of ``COUNTS``: words are runs without white space (x20, x09-x0D)."""
    raw = text.encode("utf-8")
    words = raw.split()
    n = len(words)
    if not n:
        return (0,) * len(COUNTS)
    size = len(raw)

    def chars(of: bytes) -> int:
        return size - len(raw.translate(None, of))

    lines = [x for x in raw.split(b"\n") if x.strip()]
    seen = Counter(words)
    return (
        n,
        len(text) - chars(SPACE),
        chars(SYMBOLS),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
        chars(UPPER),
        raw.count(b"!"),
        raw.count(b"|"),
        chars(b"0123456789"),
        chars(b".,;:?"),
        sum(map(eq, words, words[1:])),
        len(seen),
        max(seen.values()),
    )


def with_counts(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` with ``text_col`` (not null) replaced by the columns of ``COUNTS`` (longs)."""
    others = [f for f in rows.schema.fields if f.name != text_col]
    place = rows.columns.index(text_col)
    keep = [rows.columns.index(f.name) for f in others]

    def run(batches):
        for b in batches:
            counts = [text_counts(t) for t in b.column(place).to_pylist()]
            table = np.array(counts, np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keep], *[pa.array(c) for c in table.T]], names=[*[f.name for f in others], *COUNTS])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others] + [f"{c} long" for c in COUNTS])
    return rows.mapInArrow(run, schema)
