"""Packing: every id in one piece, full sequences, balanced cost, and a plain repetition of the method."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import packing
from tessera.llm import queries as Q

from .common import clashing, frame, odd_rows, rows_of

WORDS = public_tokenizers.path("word_bpe_49k.json")


def power_of_two(n):
    return n > 0 and n & (n - 1) == 0


def check_pieces(pieces, expected, capacity):
    """``expected``: ids with the end id of every document (a list, as ids may repeat)."""
    whole = defaultdict(list)
    seqs = defaultdict(list)
    for p in pieces:
        assert p["length"] >= 1 and len(p["ids"]) == 4 * p["length"]
        seqs[p["sequence_id"]].append((p["offset"], p["length"]))
        whole[p["id"]].append(p)
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity and (at == capacity or power_of_two(at))
    got = []
    for d, parts in whole.items():
        parts.sort(key=lambda p: p["start"])
        ids = defaultdict(list)
        for p in parts:
            ids[p["start"]].append(bytes(p["ids"]))
        if len({p["doc_tokens"] for p in parts}) == 1 and sum(p["length"] for p in parts) == parts[0]["doc_tokens"]:
            at = 0
            for p in parts:
                assert p["start"] == at
                at += p["length"]
            got.append((str(d), b"".join(bytes(p["ids"]) for p in parts)))
        else:  # several rows of one id: only the sum of the tokens is told apart here
            got.append((str(d), sum(p["length"] for p in parts)))
    by_id = defaultdict(list)
    for d, ids in expected:
        by_id[str(d)].append(np.array(ids, "<u4").tobytes())
    assert sorted(d for d, _ in got) == sorted(by_id)
    for d, x in got:
        if isinstance(x, int):
            assert x == sum(len(i) for i in by_id[d]) // 4
        else:
            assert [x] == by_id[d]


def test_odd_rows_and_clashing_names(spark):
    tok = Tokenizer.from_file(WORDS)
    rows = odd_rows()
    out = packing.pack_documents(clashing(frame(spark, rows)), WORDS, 2, capacity=64, group=8)
    assert out.columns == ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    check_pieces([r.asDict() for r in out.collect()], [(r[0], tok.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in rows], 64)
    assert packing.pack_documents(frame(spark, rows).limit(0), WORDS, 2).count() == 0
    for bad in (dict(capacity=100, end_id=2), dict(capacity=64, end_id=10**6)):
        with pytest.raises(ValueError):
            packing.pack_documents(frame(spark, rows), WORDS, **bad)


def plain_pack(docs, capacity, sizes, linear, quadratic):
    """One group: descending documents, each to the cheapest sequence with room for it, else cut."""
    room, cost, out = list(sizes), [0.0] * len(sizes), []
    for d, n in sorted(docs, key=lambda x: -x[1]):
        start = 0
        while n:
            can = [k for k in range(len(sizes)) if room[k] >= n] or [k for k in range(len(sizes)) if room[k]]
            if not can:
                break
            k = min(can, key=lambda k: (cost[k], k))
            take = min(n, room[k])
            out.append((d, start, take, k, sizes[k] - room[k]))
            room[k] -= take
            cost[k] += linear * take + quadratic * take**2
            start, n = start + take, n - take
    return out, cost


def test_packer_equals_the_plain_method():
    rng = np.random.default_rng(3)
    docs = [(i, int(n)) for i, n in enumerate(rng.integers(1, 30, 300))]
    p = packing.Packer(64, 10**6, 1.0, 0.01)
    placed = [x for d, n in docs for x in p.add(d, np.arange(n, dtype="<u2"))]
    assert not placed
    placed = [(q.id, q.start, len(q.ids), s, o) for q, s, o in p.finish()]
    total = sum(n for _, n in docs)
    sizes = [64] * (total // 64) + [1 << b for b in range(5, -1, -1) if total % 64 >> b & 1]
    expected, cost = plain_pack(docs, 64, sizes, 1.0, 0.01)
    assert placed == expected
    full = cost[: total // 64]
    first_fit = [0.0] * len(sizes)
    room, k = list(sizes), 0
    for _, n in docs:
        while n:
            take = min(n, room[k])
            first_fit[k] += take + 0.01 * take**2
            room[k], n = room[k] - take, n - take
            k += room[k] == 0
    # filling sequences in the given order balances worse
    assert max(full) - min(full) < max(first_fit[: len(full)]) - min(first_fit[: len(full)])


def test_groups_hand_on_their_rest():
    p = packing.Packer(16, 4, 1.0, 0.1)
    placed = []
    for d in range(200):
        placed += list(p.add(d, np.arange(1 + d % 40, dtype="<u2")))
    before = {s for _, s, _ in placed}
    filled = defaultdict(int)
    for q, s, _ in placed:
        filled[s] += len(q.ids)
    assert set(filled.values()) == {16} and len(before) > 100
    rest = defaultdict(int)
    for q, s, _ in p.finish():
        rest[s] += len(q.ids)
    assert not before & set(rest) and all(power_of_two(n) for n in rest.values())


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    tok = Tokenizer.from_file(WORDS)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = Q.QUERIES["op11_packing"](spark, sf).collect()
    ids = {d: np.array(tok.encode(t, add_special_tokens=False).ids + [2], "<u4") for d, t in texts.items()}
    by_doc, by_seq = defaultdict(int), defaultdict(int)
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        by_doc[r["doc_id"]] += r["length"]
        by_seq[r["sequence_id"]] += r["length"]
    assert by_doc == {d: len(x) for d, x in ids.items()}
    assert all(power_of_two(n) and n <= 4096 for n in by_seq.values())
    told = packing.sequences(Q.QUERIES["op11_packing"](spark, sf))
    assert rows_of(told.selectExpr("sum(padding)", "sum(tokens)")) == [(0, sum(by_doc.values()))]
    assert rows_of(spark.createDataFrame([(4096,), (2048,), (2047,)], "n long").select(packing.padding(Q.F.col("n"), 4096))) == [(0,), (0,), (2049,)]
