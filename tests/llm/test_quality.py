"""Quality classifier and quality rules: held-out accuracy, brute-force counts and estimates."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import quality_model as M
from tessera.llm import quality_rules as R
from tessera.llm.common import documents, table
from tessera.llm.stats import COUNTS, repeated_words, text_counts

from ..conftest import SF_MID
from .common import clashing, frame, odd_rows

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)


def test_counts_match_brute_force():
    rng = random.Random(9)
    for _ in range(300):
        text = "".join(rng.choices(["a ", "b ", "ab ", "é ", "#", "|x ", "\n", "a b c d e ", "\t", " "], k=rng.randrange(80)))
        got = dict(zip(COUNTS, text_counts(text)))
        assert tuple(got[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute_counts(text)
    assert text_counts("") == text_counts(" \n") == (0,) * len(COUNTS)
    assert repeated_words([b"a"] * 5) == 0 and repeated_words([b"a"] * 6) == 6


# --- rules


def rules_of(docs, **options):
    return sorted([tuple(r) for r in R.quality_rules(docs, **options).collect()], key=repr)


def test_rules_on_odd_rows(spark):
    got = rules_of(frame(spark, odd_rows()))
    expected = []
    for d, t, *_ in odd_rows():
        n, chars, symbols, dup, repeat = brute_counts(t)
        expected.append((d, n, chars, symbols, dup, repeat, n < 10 or 100 * repeat > 20 * n))
    assert sorted([r[:7] for r in got], key=repr) == sorted(expected, key=repr)
    assert all((r[7] is None) == r[6] and not (r[6] and r[8]) for r in got)
    assert rules_of(clashing(frame(spark, odd_rows()))) == got
    assert rules_of(frame(spark, odd_rows()).limit(0)) == []


def test_rules_separate_junk_from_clean_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF_MID, "labels").collect()}
    got = {r["id"]: r for r in R.quality_rules(documents(spark, SF_MID)).collect()}
    clean = [got[d] for d, q in labels.items() if q == 1 and not got[d]["base_failed"]]
    junk = [got[d] for d, q in labels.items() if q == 0]
    assert all(r["kept"] for r in clean)
    assert sum(r["kept"] for r in junk) <= 0.05 * len(junk)


def test_every_statistic_rejects_alone(spark):
    """In a uniform group a document far off in one statistic is an outlier (repeated words have their base limit)."""
    rng = random.Random(3)
    vocabulary = [a + b + c for a in "bdfglmn" for b in "aeiou" for c in ("r", "st", "ng", "lla", "men")]

    def lines(n, tail="", change=lambda w: w):
        return "\n".join(" ".join(change(rng.choice(vocabulary) + tail + str(rng.randrange(10**4))) for _ in range(12)) for _ in range(n))

    few, last, repeated = [rng.choice(vocabulary) + "1234" for _ in range(20)], None, []
    for _ in range(2000):  # one word a line, hardly ever five in the same order
        last = rng.choice([w for w in few if w != last])
        repeated.append(last)
    odd = {
        "length": lines(80, "abcdefghijk"),
        "symbols": lines(80, change=lambda w: w + "#"),
        "lines": "\n".join(repeated),
        "words": lines(60) + "\n" + lines(10) * 3,
        "upper": lines(80, change=str.upper),
        "bang": lines(80, change=lambda w: w + "!"),
        "adjacent": lines(80, change=lambda w: f"{w} {w}"),
    }
    plain = [(i, lines(16)) for i in range(1200)]
    got = {r["id"]: r for r in R.quality_rules(frame(spark, plain + list(enumerate(odd.values(), 5000)))).collect()}
    assert all(got[i]["kept"] for i, _ in plain)
    verdicts = {k: (got[i]["kept"], got[i]["base_failed"]) for i, k in enumerate(odd, 5000)}
    assert verdicts == {k: (False, k == "words") for k in odd}


def plain_search(x, target, share=0.75, weight=10.0, starts=60):
    """Distances by the subset of lowest determinant among many random starts, each improved to its end."""
    n, d = x.shape
    h = math.ceil(share * n)
    factor = share / R.gamma_p((d + 2) / 2, R.chi2_quantile(share, d) / 2)
    rng, best = np.random.default_rng(8), (np.inf,)
    for _ in range(starts):
        at, last = rng.permutation(n)[: d + 1], np.inf
        while True:
            mean = x[at].mean(axis=0)
            cov = (len(at) * factor * np.cov(x[at].T, bias=True) + weight * np.diag(target)) / (len(at) + weight)
            dist = np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(cov), x - mean)
            det = np.linalg.slogdet(cov)[1] if len(at) == h else np.inf
            if len(at) == h and det >= last - 1e-9:
                break
            at, last = np.argsort(dist, kind="stable")[:h], det
        if det < best[0]:
            best = det, dist
    return best


def test_distances_match_a_plain_determinant_search(spark):
    rng = np.random.default_rng(4)
    mixed = rng.normal(0, 1, (3, 3))
    groups = {
        ("a", "s"): rng.normal(0, 1, (400, 3)) @ mixed,
        ("a", "t"): 3 + rng.normal(0, 0.2, (150, 3)) * [1, 5, 0.1],
        ("b", "s"): np.ones((1, 3)),
        ("c", "s"): np.ones((40, 3)),  # nothing varies
    }
    groups["a", "s"][:80] += [25, -25, 25]  # a fifth in one far cluster, which draws the plain covariance to itself
    rows = [(g[0], g[1], [float(v) for v in x], i) for g, xs in groups.items() for i, x in enumerate(xs)]
    spread = {g: (np.diff(np.quantile(xs, [0.25, 0.75], axis=0), axis=0)[0] / 1.349) ** 2 for g, xs in groups.items()}
    target = np.maximum(sum(len(groups[g]) * v for g, v in spread.items()) / len(rows), 1e-4)
    cut = R.chi2_quantile(1 - 1e-6, 3)
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "_lang string, _source string, x array<double>, i int").repartition(parts)
        got = {(r["_lang"], r["_source"], r["i"]): r["distance"] for r in R.robust_distances(df, [1e-4] * 3).collect()}
        assert len(got) == len(rows)
        for g in (("a", "s"), ("a", "t")):
            ours = np.array([got[(*g, i)] for i in range(len(groups[g]))])
            _, plain = plain_search(groups[g], target)
            near = plain < cut
            assert ((ours < cut) == near).all()
            np.testing.assert_allclose(ours[near], plain[near], rtol=0.05, atol=0.05)
        assert got["b", "s", 0] == pytest.approx(0) and all(got["c", "s", i] == pytest.approx(0) for i in range(40))
        assert all((got["a", "s", i] > cut) == (i < 80) for i in range(400))
    classical = groups["a", "s"] - groups["a", "s"].mean(axis=0)
    plain_cov = np.einsum("ni,ij,nj->n", classical, np.linalg.inv(np.cov(groups["a", "s"].T)), classical)
    assert (plain_cov[:80] < cut).all()  # the far cluster hides from the covariance of all rows


def test_covariance_decides_not_scales(spark):
    """Two statistics that go together: a row within both ranges, but against their relation, is an outlier;
    one far out along it is not. A rule on each statistic's scale decides the other way about."""
    rng = np.random.default_rng(6)
    base = rng.normal(0, 1, 3000)
    x = np.stack([base, base + rng.normal(0, 0.3, 3000)], axis=1)
    x[0], x[1] = (1.5, -1.5), (4.5, 4.5)
    df = spark.createDataFrame([("a", "s", [float(v) for v in r], i) for i, r in enumerate(x)], "_lang string, _source string, x array<double>, i int")
    got = {r["i"]: r["distance"] for r in R.robust_distances(df, [1e-4] * 2).where("i < 2").collect()}
    cut = R.chi2_quantile(1 - 1e-6, 2)
    assert got[0] > cut > got[1]
    by_scale = (x / x.std(axis=0)) ** 2
    assert by_scale[0].sum() < by_scale[1].sum()


def test_chi_square_quantiles():
    for p, d, x in ((0.95, 1, 3.841459), (0.99, 5, 15.08627), (0.5, 7, 6.345811)):
        assert R.chi2_quantile(p, d) == pytest.approx(x, abs=1e-4)


# --- classifier


def test_held_out_accuracy(spark):
    labels = table(spark, SF_MID, "labels")
    scored = {r["id"]: r for r in M.score_quality(documents(spark, SF_MID), labels).collect()}
    held = [r for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 30
    assert all(scored[r["doc_id"]]["held_out"] for r in held)
    assert all(0 <= r["score"] <= 1 for r in scored.values())
    right = sum((scored[r["doc_id"]]["score"] >= 0.3) == (r["quality"] == 1) for r in held)
    assert right >= 0.97 * len(held)


def test_held_out_labels_are_never_learned(spark):
    """Turning every held-out label round changes no score."""
    docs, labels = documents(spark, SF_MID), table(spark, SF_MID, "labels")
    turned = labels.withColumn("quality", F.when(M.is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r["id"]: r["score"] for r in M.score_quality(docs, labels).collect()}
    b = {r["id"]: r["score"] for r in M.score_quality(docs, turned).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-6 for k in a)


def test_isotonic_is_least_squares_monotone():
    rate = M.isotonic(np.array([1.0, 1, 1, 2, 1]), np.array([0.0, 1, 0, 1, 1]))
    assert rate.tolist() == [0, 0.5, 0.5, 0.5, 1]
    assert M.isotonic(np.array([]), np.array([])).tolist() == []


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (40, 13))
    f = M.fourier(x, np.zeros(13), np.ones(13), M.feature_map(13))[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * 13))
    assert np.abs(f @ f.T - exact).max() < 0.35 and np.abs(f @ f.T - exact).mean() < 0.08


def test_classifier_on_odd_rows(spark):
    docs = clashing(frame(spark, odd_rows()))
    labels = spark.createDataFrame([(1, 0), (4, 1), (4, 1), (6, None), (None, 1), (7, 5)], "doc_id long, quality int")
    got = M.score_quality(docs, labels, with_row=True)
    assert got.count() == len(odd_rows())
    assert {r["x"] for r in got.select("row.x").collect()} == {"own x"}
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in M.score_quality(docs, none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id long, quality int")
    assert {r["score"] for r in M.score_quality(docs, ones).collect()} == {1.0}
    assert M.score_quality(docs.limit(0), labels).count() == 0
    assert [r["held_out"] for r in M.score_quality(docs, none).where("id IS NULL").collect()] == [False, False]
