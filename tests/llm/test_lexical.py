"""Lexical search against a plain scorer."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import lexical
from tessera.llm.common import scratch_path

from .common import clashing, frame, odd_rows, rows_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for d, c in counts:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            s = 0
            for t in terms(text):
                if c[t]:
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
            if s > 0:
                scored.append((-s, d is not None, d or 0, d))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def items_frame(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").withColumns({"id": F.lit("x"), "terms": F.lit(1), "m": F.lit(2)})


def noise(n, seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["Éa", "日本", "x_y", "A"]
    return [(i, " ".join(rng.choices(vocab, weights=[1 / (j + 1) for j in range(len(vocab))], k=rng.choice([1, 2, 5, 5, 5, 30])))) for i in range(n)]


ITEMS = [(1, "w1 w1 w3, w9!"), (2, "w0"), (3, ""), (4, None), (5, "nowhere"), (1, "w1 w1 w3, w9!"), (6, "日本 éa Éa a A w7"), (7, " ".join(f"w{i}" for i in range(40))), (8, "\x00w5\x7fw6/w7")]


def check(spark, docs, items, k):
    got = rows_of(lexical.rank_documents(clashing(frame(spark, docs)), items_frame(spark, items), k=k), "item_id", "rank", "doc_id", "score")
    assert got == plain([d[:2] for d in docs], items, k)


def test_equals_the_plain_scorer(spark):
    check(spark, noise(400, 1), ITEMS, 20)


def test_odd_rows_ties_and_repeats(spark):
    docs = odd_rows() + [(100 + i, "same words here") for i in range(50)]
    check(spark, docs, [(1, "same"), (2, "the quick brown"), (3, "password line éa"), (4, "b c a"), (5, "é" * 70_000)], 20)


def test_small_blocks_rounds_and_whole_vocabulary(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 3)
    check(spark, noise(300, 2), ITEMS, 5)
    monkeypatch.setattr(lexical, "MAX_TERMS", 10)  # several rounds over an index of all terms
    check(spark, noise(120, 3), ITEMS, 5)


def test_empty_tables(spark):
    docs, items = frame(spark, noise(5, 4)), items_frame(spark, ITEMS)
    assert rows_of(lexical.rank_documents(docs.limit(0), items)) == []
    assert rows_of(lexical.rank_documents(docs, items.limit(0))) == []
    assert rows_of(lexical.rank_documents(docs, items_frame(spark, [(1, "none of these")]))) == []


def test_index_groups_documents_by_normaliser(spark):
    docs = noise(300, 5)
    folder = scratch_path(spark, "test-index")
    lexical.build_index(frame(spark, docs), folder)
    n_docs, n_terms = spark.read.parquet(f"{folder}/totals").first()
    count = {d: Counter(terms(t)) for d, t in docs}
    assert (n_docs, n_terms) == (300, sum(sum(c.values()) for c in count.values()))
    assert {r["term"]: r["df"] for r in spark.read.parquet(f"{folder}/terms").collect()} == Counter(t for c in count.values() for t in c)
    postings = []
    for r in spark.read.parquet(f"{folder}/strata").collect():
        at = 0
        assert list(zip(r["terms"], r["tfs"])) == sorted(set(zip(r["terms"], r["tfs"])))
        for t, tf, size in zip(r["terms"], r["tfs"], r["sizes"]):
            for d in r["docs"][at : at + size]:
                postings.append((r["ids"][d], t, tf))
                assert r["m"] == 75 + 25 * sum(count[r["ids"][d]].values()) * n_docs // n_terms
            at += size
        assert at == len(r["docs"])
    assert sorted(postings) == sorted((d, t, n) for d, c in count.items() for t, n in c.items())


def test_low_bounds_are_left_out(spark, monkeypatch):
    """Blocks that cannot reach the last place are not opened."""
    queries = lexical._Queries([({"a": 10}, 0)], 2)
    import numpy as np

    ids, numbers, docs = np.array([5, 6, 7]), np.array([0]), np.array([0, 1, 2])
    assert queries.bounds(numbers, np.array([40])).tolist() == [400]
    queries.visit(0, ids, numbers, np.array([[0, 3]]), docs, np.array([40, 30, 30]))
    assert queries.found[0] == [(-400, 5), (-300, 6)] and queries.least[0] == 300


@pytest.mark.parametrize("text", ["A-Z a_b", "é É", "1:2;3", "\u007f\u0080x", "😀a😀"])
def test_terms(text):
    assert [t.decode() for t in lexical.terms_of(text)] == terms(text)
