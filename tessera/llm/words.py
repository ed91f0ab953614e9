"""Work on words once per batch instead of once per occurrence.

The texts of an Arrow batch are split at ASCII white space and numbered by Arrow; Python looks at each
distinct word of a batch once, and numpy deals the results out to all occurrences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 23  # bytes of text handled at once; a longer text is a slice of its own
LARGE = 1 << 24  # the same where little is held for each word
SPREAD = 1 << 19  # words dealt out at once
LONGEST = 64  # longer words are not remembered


class Recent(dict):
    """``make(key)`` by key. The memory is bounded: what is found again moves to a new generation when
    the present one is full, and the one before that goes. It only saves work."""

    def __init__(self, make: Callable, size: int = 300_000):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        if len(key) <= LONGEST:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = got
        return got


def slices(batch: pa.RecordBatch, text: int, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of about ``most`` bytes of column ``text``."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, before + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def _numbered(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, list[str]]:
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    return coded.indices.to_numpy(), offsets - offsets[0], coded.dictionary.to_pylist()


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Word numbers of all texts in a row, where each text's begin (and the end), and the words.
    The empty word can occur at the ends of a text."""
    return _numbered(pc.ascii_split_whitespace(texts))


def split_at_spaces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The same for the pieces between single spaces (x20); joined by a space they are the text."""
    return _numbered(pc.split_pattern(texts, " "))


def spread(codes: np.ndarray, offsets: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every occurrence's values in a row, and where each text's begin: word ``c`` stands for
    ``sizes[c]`` of ``values``, which hold the words' values one after the other."""
    first = np.cumsum(sizes) - sizes
    out, begins, total = [], [np.zeros(1, np.int64)], 0
    for k in range(0, len(codes), SPREAD):
        some = codes[k : k + SPREAD]
        count = sizes[some]
        ends = np.cumsum(count)
        at = np.repeat(first[some] - (ends - count), count)
        at += np.arange(len(at))
        out.append(values[at])
        begins.append(ends + total)
        total += len(at)
    return np.concatenate([values[:0], *out]), np.concatenate(begins)[offsets]
