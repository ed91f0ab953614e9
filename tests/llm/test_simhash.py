"""SimHash near-duplicates against a brute-force version."""

import random
import re

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tessera.llm import simhash
from tessera.llm.components import connected_components

from .common import PROSE, clashing, frame, odd_rows, rows_of


def brute_fingerprint(text, words=3):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    toks = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not toks:
        return 0
    shingles = [" ".join(toks[i : i + words]) for i in range(max(1, len(toks) - words + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(rows, max_bits=2):
    fps = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                parent[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, fps[i], min(ids) if ids else None))
    return sorted(out, key=repr)


def got_groups(df):
    return sorted([(r["id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in df.collect()], key=repr)


def near_copies(n=120, seed=3):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    base = rng.choices(vocab, k=400)
    rows = []
    for i in range(n):
        text = list(base) if i % 2 else rng.choices(vocab, k=rng.randint(0, 60))
        if i % 2:
            text[rng.randrange(len(text))] = rng.choice(vocab)
        rows.append((i * 7 % n, " ".join(text)))
    return rows


def test_groups_match_brute_force(spark):
    rows = near_copies()
    assert got_groups(simhash.simhash_groups(frame(spark, rows))) == brute_groups(rows)


def test_odd_rows(spark):
    rows = [r[:2] for r in odd_rows()]
    expected = brute_groups(rows)
    assert got_groups(simhash.simhash_groups(frame(spark, odd_rows()))) == expected
    assert got_groups(simhash.simhash_groups(clashing(frame(spark, odd_rows())))) == expected


def test_empty_table(spark):
    assert simhash.simhash_groups(frame(spark, [(1, "a")]).limit(0)).count() == 0


@pytest.mark.parametrize("max_bits", [1, 2])
def test_links_connect_exactly_the_pairs_in_reach(spark, max_bits):
    rng = random.Random(max_bits)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (1 << 64) - 1 for b in base for _ in range(12)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp long"), max_bits)
    roots = {r["node"]: r["root"] for r in connected_components(links).collect()}
    label = {f: f for f in signed}
    for _ in signed:
        for a in signed:
            for b in signed:
                if ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits:
                    label[a] = label[b] = min(label[a], label[b])
        if all(label[a] == label[b] for a in signed for b in signed if ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits):
            break
    assert {f: roots.get(f, f) for f in signed} == label


def test_many_near_copies_give_few_links(spark):
    """A crowded list returns a spanning forest, not all pairs."""
    fps = np.arange(4096, dtype=np.uint64)
    left, right = simhash.link_runs(np.zeros(4096, np.int64), fps, 2)
    assert len(left) == 4095 and set(right.tolist()) == {0}


def test_long_chain_of_components(spark):
    n = 300
    links = spark.createDataFrame([(i * 37 % n, i * 37 % n + 1) for i in range(n)] + [(1000, 1001), (1001, 1001), (None, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(links).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}


def test_one_of_each_keeps_the_smallest_id(spark):
    kept = simhash.one_of_each(clashing(frame(spark, odd_rows()))).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({c for _, _, c in brute_groups([r[:2] for r in odd_rows()])})
    assert {r["row"] for r in kept} == {"own row"}


def test_pipeline_stage_keeps_one_of_repeated_rows(spark):
    docs = frame(spark, [(4, PROSE), (4, PROSE), (5, PROSE), (6, PROSE + " and one more different ending for this text " * 3)])
    out = corpus_pipeline.dedup_near(spark, docs, "")
    assert out.columns == docs.columns
    assert rows_of(out, "doc_id") == [(4,), (6,)]
