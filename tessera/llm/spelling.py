"""Spelling variants of a corpus's words, grouped by pivotal grams.

A word of the vocabulary is cut into bigrams with their positions, ordered from rare to frequent (by the
number of words that hold the bigram). One edit changes at most ``Q`` of them, so the ``Q + 1`` rarest
are a word's prefix; two disjoint bigrams of the prefix are its pivots, chosen by dynamic programming to
occur in the fewest words. An edit cannot destroy both pivots: of two words one edit apart, the one
whose prefix ends earlier in the order (bigram, then position) has a pivot in the other's prefix, at
the same position or moved by the difference in length. So pivots are joined with prefixes on (bigram, length, position), which
leaves few candidates. A candidate pair is verified by its letters (an edit adds and removes one at
most) and then by its edit distance.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, scratch, text_or_empty
from .words import slices, split_words, spread

Q, EDITS = 2, 1
PREFIX = Q * EDITS + 1  # rarest bigrams: one edit changes at most Q of them
RUN = re.compile("[A-Za-zÀ-ÿ]+")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = str.maketrans(_UPPER, _UPPER.lower())
EVERY = 97  # a run loses a code point where this divides its checksum


class _Shift:
    """CRC-32 of joined pieces: ``crc(a + b) = shift(crc(a), len(b)) ^ crc(b)``, for arrays."""

    def __init__(self):
        self.row: dict[int, int] = {}
        self.tables = np.zeros((0, 4, 256), np.uint32)

    def rows(self, sizes: np.ndarray) -> np.ndarray:
        """The table row of each length; a length's shift of every byte of a checksum is made once."""
        distinct, at = np.unique(sizes, return_inverse=True)
        new = [int(n) for n in distinct if int(n) not in self.row]
        if new:
            made = np.zeros((len(new), 4, 256), np.uint32)
            for k, n in enumerate(new):
                zeros = bytes(n)
                base = zlib.crc32(zeros)
                for p in range(4):
                    made[k, p] = [zlib.crc32(zeros, v << 8 * p) ^ base for v in range(256)]
                self.row[n] = len(self.tables) + k
            self.tables = np.concatenate([self.tables, made])
        return np.array([self.row[int(n)] for n in distinct], np.int64)[at]

    def join(self, head: np.ndarray, tail: np.ndarray, tail_rows: np.ndarray) -> np.ndarray:
        out = tail.copy()
        for p in range(4):
            out ^= self.tables[tail_rows, p, (head >> np.uint32(8 * p)) & np.uint32(255)]
        return out


LONG_RUN = 256  # bytes of a run up to which shift tables are made


def _counted(ids: list, codes: np.ndarray, at: np.ndarray, words: list[str], shift: _Shift, least: int) -> dict[str, int]:
    """Occurrences of each resulting word of ``least`` code points in some documents."""
    split = [RUN.findall(w.lower() if w.isascii() else w.translate(_LOWER)) for w in words]
    number: dict[str, int] = {}
    split_ids = [[number.setdefault(r, len(number)) for r in rs if len(r) >= least] for rs in split]
    if not number:
        return {}
    sizes = np.fromiter(map(len, split_ids), np.int64, len(split_ids))
    flat, begins = spread(codes, at, sizes, np.array([i for rs in split_ids for i in rs], np.int64))
    runs = list(number)
    pair, n = np.unique(np.repeat(np.arange(len(ids)), np.diff(begins)) * len(runs) + flat, return_counts=True)
    doc, run = np.divmod(pair, len(runs))
    raw = [r.encode("utf-8") for r in runs]
    length = np.fromiter(map(len, raw), np.int64, len(raw))
    tail = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw))
    head = np.array([zlib.crc32(b"" if i is None else str(i).encode()) for i in ids], np.uint32)
    colon = np.array([zlib.crc32(b":", int(h)) for h in head], np.uint32)
    tables = shift.rows(np.minimum(length, LONG_RUN))
    h = shift.join(colon[doc], tail[run], tables[run])
    for k in np.flatnonzero(length[run] > LONG_RUN):
        h[k] = zlib.crc32(raw[run[k]], int(colon[doc[k]]))
    total = np.bincount(run, n, len(runs)).astype(np.int64)
    cut: dict[str, int] = {}
    for k in np.flatnonzero(h % EVERY == 0).tolist():
        word, times = runs[run[k]], int(n[k])
        total[run[k]] -= times
        place = int(h[k]) % len(word)
        if len(word) > least:
            short = word[:place] + word[place + 1 :]
            cut[short] = cut.get(short, 0) + times
    out = {w: t for w, t in zip(runs, total.tolist()) if t}
    for w, t in cut.items():
        out[w] = out.get(w, 0) + t
    return out


def vocabulary(docs: DataFrame, least_length: int = 5, least_count: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)``: runs of Latin letters in all texts, A-Z lower-cased, of at least ``least_length``
    code points and ``least_count`` occurrences. Where 97 divides the CRC-32 of ``<id>:<run>``, the run
    has lost the code point at that checksum modulo its length. A null text has no runs, a null id
    counts as an empty one; repeated rows count each."""

    def run(batches):
        shift = _Shift()
        for b in batches:
            for part in slices(b, 1):
                codes, at, words = split_words(part.column(1))
                found = _counted(part.column(0).to_pylist(), codes, at, words, shift, least_length)
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def choose_pivots(grams: list[tuple[int, int]], count: int) -> list[int]:
    """Positions of ``count`` disjoint bigrams of least total weight; ``grams`` are (position, weight).

    Dynamic programming over the positions: the best choice of k bigrams among the first i either
    leaves out the i-th or takes it after the best choice of k - 1 that ends before it.
    """
    grams = sorted(grams)
    best: list[list[tuple[int, list[int]] | None]] = [[(0, [])] + [None] * count]
    for i, (place, weight) in enumerate(grams):
        apart = next((j for j in range(i, 0, -1) if grams[j - 1][0] <= place - Q), 0)
        row = list(best[i])
        for k in range(1, count + 1):
            before = best[apart][k - 1]
            if before is not None and (row[k] is None or before[0] + weight < row[k][0]):
                row[k] = (before[0] + weight, before[1] + [place])
        best.append(row)
    return best[-1][count][1]


def letter_bits(word: str) -> int:
    """A bit for every letter that a word has (letters may share one): an edit changes two at most."""
    bits = 0
    for c in set(word):
        bits |= 1 << ord(c) % 61
    return bits


def gram_keys(words: DataFrame, rank: dict[str, tuple[int, int]]) -> DataFrame:
    """``(word, n, bits, size, pivot, gram, at)``: the prefix of each word, its pivots marked. ``rank`` has
    each bigram's place in the order and the number of words with it."""
    shared = words.sparkSession.sparkContext.broadcast(rank)

    def run(batches):
        known = shared.value
        for b in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                grams = sorted((known[word[i : i + Q]][0], i) for i in range(len(word) - 1))
                # equal bigrams go by position, and an edit moves positions by one: the last one's successor belongs to it
                last = grams[PREFIX - 1]
                prefix = grams[:PREFIX] + [g for g in grams[PREFIX : PREFIX + 1] if g == (last[0], last[1] + 1)]
                pivots = choose_pivots([(i, known[word[i : i + Q]][1]) for _, i in grams[:PREFIX]], EDITS + 1)
                bits = letter_bits(word)
                for g, i in prefix:
                    for column, value in zip(out, (word, n, bits, len(word), i in pivots, g, i)):
                        column.append(value)
            types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["word", "n", "bits", "size", "pivot", "gram", "at"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, bits long, size int, pivot boolean, gram int, at int")


def near_pairs(words: DataFrame) -> DataFrame:
    """``(word, n, other, other_n)`` in both directions for words (at least ``PREFIX + 1`` code points
    long) one inserted, deleted or replaced code point apart."""
    grams = words.select(F.explode(F.array_distinct(F.expr(f"transform(sequence(1, length(word) - 1), i -> substring(word, i, {Q}))"))).alias("gram"))
    # bounded by the alphabet: at most one row per pair of letters
    counted = grams.groupBy("gram").agg(F.count("*").alias("n")).orderBy("n", "gram").collect()
    keys = scratch(gram_keys(words, {r["gram"]: (i, r["n"]) for i, r in enumerate(counted)}), "grams")
    pivots = keys.where("pivot").select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("bits").alias("a_bits"), "gram", "size", "at")
    # where the bigram of a word of another length can stand: in place, or moved by the difference
    seen = "explode(array(struct(size AS size, at AS at), struct(size - 1 AS size, at AS at), struct(size + 1 AS size, at AS at), struct(size - 1 AS size, at - 1 AS at), struct(size + 1 AS size, at + 1 AS at))) AS k"
    places = keys.selectExpr("word AS b", "n AS b_n", "bits AS b_bits", "gram", seen).select("b", "b_n", "b_bits", "gram", "k.size", "k.at")
    # most candidates already differ in more letters than the edits can change
    close = F.bit_count(F.col("a_bits").bitwiseXOR(F.col("b_bits"))) <= 2 * EDITS
    met = pivots.join(places, ["gram", "size", "at"]).where(close & (F.col("a") != F.col("b")) & (F.levenshtein("a", "b", EDITS) == EDITS))
    pair = F.when(F.col("a") < F.col("b"), F.struct("a", "a_n", "b", "b_n")).otherwise(F.struct(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    once = met.select(pair.alias("p")).select("p.*").distinct()
    both = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("other"), F.col("b_n").alias("other_n")), F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("other"), F.col("a_n").alias("other_n"))))
    return once.select(both.alias("p")).select("p.*")


def follow(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``(word, form)``, forms never circular: every round halves the way to the root."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        nxt = scratch(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = nxt.select("word", "root")
        if nxt.where("moved").isEmpty():
            return now


def spelling_groups(docs: DataFrame, least_length: int = 5, least_count: int = 3, factor: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of the corpus's vocabulary (``vocabulary``).

    ``form`` is the near word of largest ``n`` (the smallest in code-point order among equals) if it
    occurs ``factor`` times as often as the word, else null; ``root`` follows forms to the last. An
    empty table gives an empty one; other columns are not read. ``least_length`` is at least 4.
    """
    if least_length <= PREFIX:
        raise ValueError("words need one code point more than the prefix has bigrams")
    if factor < 2:
        raise ValueError("a form must be more frequent than its word")
    prepare(docs.sparkSession)
    words = scratch(vocabulary(docs, least_length, least_count, id_col, text_col), "vocabulary")
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), "other")).alias("best"))
    best = F.when(-F.col("best.n") >= factor * F.col("n"), F.col("best"))
    judged = scratch(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), best["other"].alias("form"), (-best["n"]).alias("form_n")), "forms")
    roots = follow(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
