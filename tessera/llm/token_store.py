"""Token ids in byte-aligned variable-length coding, ordered by document.

File format (a Parquet folder, so any store Spark can write will do): pages in ascending document
order, each with the documents' ids and token counts and two separate streams. An id is replaced by
its frequency rank over the whole corpus (0 = most frequent; the rank table lies beside the pages),
so frequent ids take one byte. The control stream holds four 2-bit lengths per byte, the data
stream the ranks' 1 to 4 little-endian bytes. Decoding looks the control bytes up in a 256-row
table of lengths, finds all starts by one running sum and gathers the bytes with numpy.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import prepare, scratch_path, text_hash, text_or_empty
from .words import LARGE, Recent, slices, split_words, spread

REMEMBERED = 300_000  # words, and pre-tokens, of a generation that a worker remembers
PAGE = 1 << 18  # tokens after which a page ends; a document never spans pages
#: Lengths (1 to 4) that each control byte stands for.
LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.uint8)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    v = values.astype("<u4")
    size = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    codes = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    codes[: len(v)] = size - 1
    control = codes.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    keep = np.arange(4) < size[:, None]
    return control.astype(np.uint8).tobytes(), v.view(np.uint8).reshape(-1, 4)[keep].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of two streams, by table lookup."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    start = np.cumsum(size, dtype=np.int64) - size
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)])
    out = raw[start].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        if not len(more):
            break
        out[more] |= raw[start[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


#: The normaliser, pre-tokeniser and model settings that ``TextEncoder`` can apply word by word.
KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 bytes stand for
    themselves, the others for the letters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class TextEncoder:
    """Ids of whole texts from the tokenizers library, by distinct word.

    White space always ends a pre-token, so a word's ids do not depend on its text. In words of plain
    Latin letters, digits and marks the vocabulary's pattern is applied here and the library's model
    merges each new pre-token; the library encodes all other words. A vocabulary with another
    normaliser or pre-tokeniser than ``KNOWN`` gets whole texts encoded by the library.
    """

    LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff\u0101-\u012f\u0133-\u0148\u014b-\u017e"
    ODD = re.compile("[^\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff\u0100-\u012f\u0132-\u0148\u014a-\u017e]|<[|]")
    PRE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^0-9{LETTERS}]+")

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(vocabulary)
        self.model = self.tok.model  # after the check below, what the library applies to a pre-token
        self.dtype = "<u2" if max(self.tok.get_vocab(with_added_tokens=True).values()) < 1 << 16 else "<u4"
        told = json.loads(vocabulary)
        model = {k: v for k, v in told["model"].items() if k not in ("vocab", "merges")}
        plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
        odd_names = [t["content"] for t in told["added_tokens"] if not t["content"].startswith("<|")]
        self.by_word = plain and not odd_names and all(told[k] == v for k, v in KNOWN.items())
        self.letters = _byte_letters()
        self.runs, self.words = Recent(self._run, REMEMBERED), Recent(self._word, REMEMBERED)

    def _library(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _run(self, run: str) -> bytes:
        if not run.isascii():
            run = run.encode("utf-8").decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(run)], self.dtype).tobytes()

    def _word(self, word: str) -> bytes:
        if word.isalpha() and word.isascii():
            return self.runs[word.lower()]
        if self.ODD.search(word):
            return self._library(word)
        return b"".join([self.runs[x] for x in self.PRE.findall(word.lower())])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        ids, at = self.flat(pa.array(texts, pa.string()))
        return [ids[x:y].tobytes() for x, y in zip(at, at[1:])]

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row and where each text's begin (and the end)."""
        if not self.by_word:
            each = [self._library(t) for t in texts.to_pylist()]
            width = np.dtype(self.dtype).itemsize
            return np.frombuffer(b"".join(each), self.dtype), np.cumsum([0, *[len(x) // width for x in each]])
        codes, offsets, words = split_words(texts)
        got = [self.words[w] for w in words]
        values = np.frombuffer(b"".join(got), self.dtype)
        sizes = np.fromiter(map(len, got), np.int64, len(got)) // values.itemsize
        return spread(codes, offsets, sizes, values)


_ENCODERS: dict[int, TextEncoder] = {}


def encoder(vocabulary: str) -> TextEncoder:
    """The worker's encoder of a vocabulary."""
    key = hash(vocabulary)
    if key not in _ENCODERS:
        _ENCODERS[key] = TextEncoder(vocabulary)
    return _ENCODERS[key]


def broadcast_vocabulary(spark: SparkSession, path: str):
    """The vocabulary's JSON, read on the driver; as large as the vocabulary."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def tokenize(docs: DataFrame, vocabulary_path: str, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """``(id, tie, n, raw)``: token count with the end id, and the zstd-compressed plain ids."""
    vocab = broadcast_vocabulary(docs.sparkSession, vocabulary_path)

    def run(batches):
        enc = encoder(vocab.value)
        end, width = np.array([end_id], enc.dtype).tobytes(), np.dtype(enc.dtype).itemsize
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            for part in slices(b, 2, 2 * LARGE):
                ids, at = enc.flat(part.column(2))
                raw, at = ids.tobytes(), (at * width).tolist()
                packed = [squeeze(raw[x:y] + end) for x, y in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(at) // width + 1), pa.array(packed, pa.binary())],
                    names=["id", "tie", "n", "raw"],
                )

    cols = docs.select(F.col(id_col).cast("long").alias("id"), text_hash(text_col).alias("tie"), text_or_empty(text_col).alias("text"))
    return cols.mapInArrow(run, "id long, tie long, n long, raw binary")


def _width(vocabulary_path: str) -> tuple[int, str]:
    from tokenizers import Tokenizer

    n = max(Tokenizer.from_file(vocabulary_path).get_vocab(with_added_tokens=True).values()) + 1
    return n, "<u2" if n <= 1 << 16 else "<u4"


def check_end_id(vocabulary_path: str, end_id: int) -> None:
    if not 0 <= end_id < (size := _width(vocabulary_path)[0]):
        raise ValueError(f"end id {end_id} is not an id of the vocabulary (0 to {size - 1})")


def write_tokens(docs: DataFrame, folder: str, vocabulary_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id`` and write pages and rank table below ``folder``.

    Documents lie in ascending id order (null ids first, ties by text hash; equal rows repeat). A
    null or empty text holds the end id alone. An empty table writes no page. Other columns are not
    read. An ``end_id`` that the vocabulary does not have raises ValueError.
    """
    spark = docs.sparkSession
    prepare(spark)
    check_end_id(vocabulary_path, end_id)
    size, dtype = _width(vocabulary_path)
    raw_path = scratch_path(spark, "tokens")
    tokens = tokenize(docs, vocabulary_path, id_col, text_col, end_id)
    tokens.write.option("compression", "none").parquet(raw_path)  # the ids are compressed already
    raw = spark.read.schema(tokens.schema).parquet(raw_path)

    def count(batches):
        seen, expand = np.zeros(size, np.int64), zstandard.ZstdDecompressor().decompress
        for b in batches:
            for x in b.column(0).to_pylist():
                seen += np.bincount(np.frombuffer(expand(x), dtype), minlength=size)
        ids = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(seen[ids], pa.int64())], names=["id", "n"])

    # at most one row per id of the vocabulary reaches the driver
    counted = raw.select("raw").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    ranked = [r["id"] for r in counted.orderBy(F.desc("n"), "id").collect()]
    spark.createDataFrame([(k, int(i)) for k, i in enumerate(ranked)], "rank long, id long").coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(size, np.uint32)
    rank_of[ranked] = np.arange(len(ranked))
    table = spark.sparkContext.broadcast(rank_of)

    def pages(batches):
        part, number, held, total = TaskContext.get().partitionId(), 0, [], 0
        expand = zstandard.ZstdDecompressor().decompress

        def page():
            ids = np.concatenate([np.frombuffer(expand(x), dtype) for _, _, x in held])
            control, data = pack(table.value[ids])
            row = [[part], [number], [[h[0] for h in held]], [[h[1] for h in held]], [len(ids)], [control], [data]]
            types = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, types)], names=["part", "page", "ids", "counts", "n", "control", "data"])

        for b in batches:
            for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                held.append(row)
                total += row[1]
                if total >= PAGE:
                    yield page()
                    number, held, total = number + 1, [], 0
        if held:
            yield page()

    ordered = raw.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "n", "raw")
    schema = "part int, page int, ids array<long>, counts array<long>, n long, control binary, data binary"
    ordered.mapInArrow(pages, schema).write.option("compression", "zstd").parquet(f"{folder}/pages")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, start, n, ids)`` per document from the files of ``write_tokens``: ``start`` counts the
    ids of all documents before it, ``ids`` are little-endian uint32 bytes."""
    prepare(spark)
    pages = spark.read.parquet(f"{folder}/pages")
    ranks = [r["id"] for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()]  # vocabulary-sized
    table = spark.sparkContext.broadcast(np.array(ranks, np.uint32))
    # running sums: pages within a part, then parts (one row each)
    sizes = pages.select("part", "page", "n")
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    inside = sizes.select("part", "page", (F.sum("n").over(Window.partitionBy("part").orderBy("page")) - F.col("n")).alias("at"))
    starts = inside.join(before, "part").select("part", "page", (F.col("at") + F.col("base")).alias("start"))

    def run(batches):
        for b in batches:
            for ids, counts, n, control, data, start in zip(*[b.column(c).to_pylist() for c in range(6)]):
                values = table.value[unpack(control, data, n)].astype("<u4").tobytes() if n else b""
                counts = np.array(counts, np.int64)
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(start + ends - counts),
                        pa.array(counts),
                        pa.array([values[4 * (e - c) : 4 * e] for e, c in zip(ends.tolist(), counts.tolist())], pa.binary()),
                    ],
                    names=["id", "start", "n", "ids"],
                )

    return pages.join(starts, ["part", "page"]).select("ids", "counts", "n", "control", "data", "start").mapInArrow(run, "id long, start long, n long, ids binary")
