"""Token files and byte-level BPE against the libraries, and exact round trips."""

import base64
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import bpe
from tessera.llm import token_store as S
from tessera.llm.common import scratch_path

from .common import clashing, frame, odd_rows, rows_of

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

ODD = ["", " ", "a \n b  c   d", "x\x1c y\x1d\x1ez", "''s 's don't I'll 've !'s", "\t\t\n\n  a ", "éå W̊ İstanbul ΣΑΣ", "<|endoftext|> <|ENDOFTEXT|>a", "日本語 テキスト", "🙂🙂🏽", "a" * 3000, "ab" * 900, "a.b.c1234 5,6!!", "ǆ ﬁ ß ſt   　 \x85y", "a \n b", "µ² ½ ŉ"]


def noise(n=400):
    rng = random.Random(1)
    chars = [chr(c) for c in range(0x2100) if not 0xD800 <= c < 0xE000] + list(" \n\t'`.,!aZ09_-") * 120
    return ["".join(rng.choices(chars, k=120)) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_exact():
    keys = [str(i).encode() for i in range(5000)]
    table = bpe.PerfectHash(keys, list(range(5000)))
    assert [table.get(k) for k in keys] == list(range(5000))
    assert sorted(table.keys) == sorted(keys) and len(table.keys) == 5000
    assert all(table.get(b"x%d" % i) is None for i in range(2000))
    assert bpe.PerfectHash([b"a"], [3]).get(b"a") == 3


def test_bpe_equals_the_library(library):
    ranks = bpe.load_ranks(RANKS)
    enc = bpe.Encoder(public_tokenizers.PATTERN, ranks, bpe.PerfectHash(list(ranks), list(ranks.values())))
    for t in ODD + noise():
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == library.encode_ordinary(t), ascii(t)


def test_bpe_bounded_memory_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 8)
    ranks = bpe.load_ranks(RANKS)
    enc = bpe.Encoder(public_tokenizers.PATTERN, ranks, bpe.PerfectHash(list(ranks), list(ranks.values())))
    for t in ODD + noise(40):
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == library.encode_ordinary(t)


def test_bpe_rows_round_trip(spark, library):
    docs = clashing(frame(spark, odd_rows() + [(50, t) for t in ODD]))
    coded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert coded.columns == docs.columns + ["ids"]
    back = coded.withColumn("_back", bpe.decode(F.col("ids"), spark, RANKS)).collect()
    assert len(back) == docs.count()
    for r in back:
        assert bytes(r["_back"]).decode() == (r["text"] or "")
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == library.encode_ordinary(r["text"] or "")
    assert bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_pack_round_trip():
    rng = np.random.default_rng(0)
    for v in ([], [0], [0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], rng.integers(0, 70_000, 1001), rng.integers(0, 2**32, 514)):
        v = np.array(v, np.uint32)
        control, data = S.pack(v)
        assert len(control) == -(-len(v) // 4)
        assert (S.unpack(control, data, len(v)) == v).all()
    assert len(S.pack(np.zeros(100, np.uint32))[1]) == 100


def test_text_encoder_equals_the_library(monkeypatch):
    tok = Tokenizer.from_file(WORDS)
    texts = ODD + noise()
    expected = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    for limit in (500_000, 8):
        monkeypatch.setattr(S, "REMEMBERED", limit)
        enc = S.TextEncoder(open(WORDS, encoding="utf-8").read())
        for _ in range(2):
            assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(texts)] == expected


def read(spark, docs):
    folder = scratch_path(spark, "test-tokens")
    S.write_tokens(docs, folder, WORDS, 2)
    return S.read_tokens(spark, folder), folder


def test_files_hold_all_documents_in_order(spark, monkeypatch):
    tok = Tokenizer.from_file(WORDS)
    rows = odd_rows() + [(100 + i, t) for i, t in enumerate(ODD)]
    out, folder = read(spark, clashing(frame(spark, rows)))
    got = sorted([(r["start"], r["id"], r["n"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()) for r in out.collect()])
    at, ids_in_order = 0, []
    for start, d, n, ids in got:
        assert start == at and n == len(ids)
        at += n
        ids_in_order.append(d)
    assert [d for d in ids_in_order if d is None] == ids_in_order[:2]
    assert ids_in_order[2:] == sorted(d for d, *_ in rows if d is not None)
    assert sorted((str(d), ids) for _, d, _, ids in got) == sorted((str(r[0]), tok.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in rows)
    ranks = [r["id"] for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()]
    counts = np.bincount([i for *_, ids in got for i in ids])
    assert ranks == sorted(set(np.flatnonzero(counts).tolist()), key=lambda i: (-counts[i], i))


def test_empty_table(spark):
    out, _ = read(spark, frame(spark, [(1, "a")]).limit(0))
    assert rows_of(out) == []


def test_pre_tokens_merged_together_equal_the_heap():
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    r = random.Random(7)
    tokens = list(ranks)
    pieces = [b"".join(r.choice(tokens)[: r.randint(1, 6)] for _ in range(r.randint(1, 5))) for _ in range(5000)]
    pieces += [bytes(r.randrange(256) for _ in range(r.randint(1, 64))) for _ in range(2000)]
    pieces += [b"a", b"a" * 64, b"ab" * 30, b" ", b"\x00"]  # ties, single bytes
    got = bpe.Merger(ranks)(pieces)
    assert got == [np.array(bpe.merge(p, ranks), "<u4").tobytes() for p in pieces]
    assert bpe.Merger(ranks)([]) == []


def test_unknown_words_of_a_batch_are_merged_together(monkeypatch):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    r = random.Random(3)
    words = ["".join(r.choice("abcdefgh\u00e4\u00e9") for _ in range(r.randint(1, 30))) for _ in range(3000)]
    texts = pa.array([" ".join(words[k : k + 300]) for k in range(0, 3000, 300)] + ["x" * 500, "", "\u4e2d\u6587 words", " a  b\n"], pa.string())
    encoder = bpe.Encoder(public_tokenizers.PATTERN, ranks, bpe.PerfectHash(list(ranks), list(ranks.values())))
    expected = [encoder.encode(t) for t in texts.to_pylist()]
    one_by_one = []
    heap = bpe.merge
    monkeypatch.setattr(bpe, "merge", lambda piece, ranks: (one_by_one.append(piece), heap(piece, ranks))[1])
    fresh = bpe.Encoder(public_tokenizers.PATTERN, ranks, encoder.table)
    assert fresh.batch(texts) == expected
    assert all(len(p) > 64 or not p.isascii() for p in one_by_one) and len(one_by_one) < 10
