"""Spelling variants against a plain all-pairs comparison on small tables."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from tessera.llm import spelling

from .common import clashing, frame, odd_rows, rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_vocabulary(docs, least_length=5, least_count=3):
    n = Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (t or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= least_length and c >= least_count}


def plain_groups(docs, least_count=3):
    n = plain_vocabulary(docs, 5, least_count)
    near = {w: [] for w in n}
    for a, b in combinations(n, 2):
        if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-n[o], o))
            if n[best] >= 2 * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return sorted(out, key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def variants(n_docs, seed, letters="abcdeé"):
    """Documents of words and their misspellings, some of them chains of several edits."""
    rng = random.Random(seed)
    base = ["".join(rng.choices(letters, k=rng.randint(5, 9))) for _ in range(40)]

    def spoil(w):
        i = rng.randrange(len(w))
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]])

    pool = list(base)
    for _ in range(160):
        pool.append(spoil(rng.choice(pool)))
    weights = [1 / (i + 1) for i in range(len(pool))]
    return [(i, " ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in rng.choices(pool, weights, k=40))) for i in range(n_docs)]


def check(spark, docs, least_count=3):
    got = rows_of(spelling.spelling_groups(clashing(frame(spark, docs)), least_count=least_count), *COLUMNS)
    expected = plain_groups([d[:2] for d in docs], least_count)
    assert got == expected
    return expected


@pytest.mark.parametrize("letters", ["ab", "abcdeé", "abcdefghijklmnop"])
def test_equals_all_pairs(spark, letters):
    found = check(spark, variants(120, 7, letters))
    assert sum(r[4] for r in found) > 10


def test_chains_are_followed(spark):
    chain = ["aaaaaaaa", "aaaaaaab", "aaaaaabb", "aaaaabbb", "aaaabbbb", "aaabbbbb"]
    docs = [(i, " ".join(w for k, w in enumerate(chain) for _ in range(3 * 3**k))) for i in (None,)]
    found = check(spark, docs)
    assert {r[2] for r in found if r[0] in chain} == {chain[-1]}


def test_odd_rows(spark):
    docs = odd_rows() + [(20, "ÀÉÎÕÜ×÷ ÀÉÎÕÜ×÷ ÀÉÎÕÜ×÷ àéîõü àéîõü àéîõü Hello hello HELLO"), (21, "x" * 300 + " " + "x" * 299), (22, ("x" * 300 + " ") * 3)]
    check(spark, docs, least_count=1)
    assert rows_of(spelling.spelling_groups(frame(spark, docs).limit(0))) == []
    assert rows_of(spelling.spelling_groups(frame(spark, [(1, "to be or not"), (2, None)]))) == []
    for bad in (dict(least_length=3), dict(factor=1)):
        with pytest.raises(ValueError):
            spelling.spelling_groups(frame(spark, docs), **bad)


def test_checksums_of_many_documents(spark):
    """Enough (document, run) pairs that some lose a code point."""
    docs = [(i, "spelling variants of these common words " + "longer" * (i % 30 + 1)) for i in range(1500)]
    n = plain_vocabulary(docs, 5, 1)
    assert 1400 < n["variants"] < 1500 and len(n) > 40
    assert dict(rows_of(spelling.vocabulary(frame(spark, docs), 5, 1))) == n


def test_pivots_are_disjoint_and_of_least_weight():
    rng = random.Random(5)
    for _ in range(300):
        places = rng.sample(range(8), 5)
        grams = [(p, rng.randint(1, 9)) for p in places]
        want = [c for c in combinations(grams, 2) if abs(c[0][0] - c[1][0]) >= 2]
        got = spelling.choose_pivots(grams, 2)
        assert len(got) == 2 and abs(got[0] - got[1]) >= 2
        assert sum(dict(grams)[p] for p in got) == min(a[1] + b[1] for a, b in want)
