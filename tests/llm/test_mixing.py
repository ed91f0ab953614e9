"""Mixing to target weights against a brute-force version."""

import random

import numpy as np
import pytest

import corpus_pipeline
from tessera.llm import mixing as X
from tessera.llm import queries as Q
from tessera.llm.common import documents

from ..conftest import SF_MID
from .common import clashing, frame, odd_rows

TARGETS = {"source": {"a": 0.5, "*": 0.5}, "lang": {"en": 0.6, "de": 0.4}, "topic": {"general": 0.9, "legal": 0.1}}


def corpus(n=6000, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = " ".join(["w"] * rng.randrange(1, 30)) + (" license" if rng.random() < 0.2 else "")
        rows.append((i, text, rng.choice(["en", "en", "en", "de"]), rng.choice("aabcd")))
    return rows


def plain_rake(cells, targets, budget, sweeps=3000):
    """Scale one margin after the other, one value at a time."""
    kept = {k: v * budget / sum(cells.values()) for k, v in cells.items()}
    for _ in range(sweeps):
        for axis, target in enumerate(targets):
            for value, share in target.items():
                have = sum(v for k, v in kept.items() if k[axis] == value)
                for k in kept:
                    if k[axis] == value and have:
                        kept[k] = min(cells[k], kept[k] * share * budget / have)
    return kept


def test_weights_match_plain_raking(spark):
    rows = corpus()
    got = X.mix(frame(spark, rows), TARGETS, keep_share=0.5).select("row.doc_id", "source", "lang", "topic", "n_tokens", "probability", "kept").collect()
    assert len(got) == len(rows)
    cells: dict = {}
    for r in got:
        cells[r["source"], r["lang"], r["topic"]] = cells.get((r["source"], r["lang"], r["topic"]), 0) + r["n_tokens"]
    total = sum(cells.values())
    assert total == sum(len(t.split()) for _, t, _, _ in rows)
    expected = plain_rake(cells, [{"a": 0.5, "*": 0.5}, {"en": 0.6, "de": 0.4}, {"general": 0.9, "legal": 0.1}], 0.5 * total)
    for r in got:
        k = (r["source"], r["lang"], r["topic"])
        assert r["probability"] == pytest.approx(expected[k] / cells[k], abs=1e-6)
    for axis, target in (("source", {"a": 0.5, "*": 0.5}), ("lang", TARGETS["lang"]), ("topic", TARGETS["topic"])):
        kept = sum(r["n_tokens"] for r in got if r["kept"])
        assert kept == pytest.approx(0.5 * total, rel=0.05)
        for v, share in target.items():
            assert sum(r["n_tokens"] for r in got if r["kept"] and r[axis] == v) / kept == pytest.approx(share, abs=0.03)


def test_decisions_do_not_depend_on_partitions(spark):
    rows = corpus(500)
    one, two = ({r["doc_id"]: r["kept"] for r in X.mix(frame(spark, rows, p), TARGETS).select("row.doc_id", "kept").collect()} for p in (1, 9))
    assert one == two


def test_scarce_values_give_all_they_have():
    assert X.fill(np.array([10.0, 100, 1000]), np.array([0.5, 0.3, 0.2]), 400).tolist() == [10, 100, 290]
    assert X.fill(np.array([10.0, 0]), np.array([0.5, 0.5]), 400).tolist() == [10, 0]
    kept = X.rake(np.array([[10.0, 5], [100, 50]]), [np.array([0.9, 0.1]), np.array([0.5, 0.5])], 80)
    assert (kept <= np.array([[10, 5], [100, 50]]) + 1e-9).all()
    assert X.rake(np.zeros((2, 2)), [np.ones(2), np.ones(2)], 0).sum() == 0


def test_scarce_values_lower_the_budget_until_targets_are_met():
    cells = np.array([[50.0, 10], [500, 440]])  # the first row has 6 % of the tokens
    targets = [np.array([0.3, 0.7]), np.array([0.6, 0.4])]
    kept = X.rake_to_targets(cells, targets, 0.8)
    assert X.largest_gap(kept, targets) <= 1e-3 and (kept <= cells + 1e-9).all()
    assert kept.sum() == pytest.approx(200, rel=0.01)  # 60 of 0.3: no larger budget can hold that share
    easy = [np.array([0.06, 0.94]), np.array([0.55, 0.45])]
    assert X.rake_to_targets(cells, easy, 0.8).sum() == pytest.approx(800)  # reachable: all that may be kept
    # a value without tokens leaves its share to the others, which shows
    none = X.rake_to_targets(np.array([[0.0, 0], [500, 440]]), targets, 0.8)
    assert none[0].sum() == 0 and X.largest_gap(none, targets) == pytest.approx(0.3)
    # the first row only occurs beside the first column: no budget meets both
    tied = X.rake_to_targets(np.array([[100.0, 0], [0, 900]]), [np.array([0.5, 0.5]), np.array([0.2, 0.8])], 0.8)
    assert tied.sum() > 0 and X.largest_gap(tied, [np.array([0.5, 0.5]), np.array([0.2, 0.8])]) > 0.1


def test_registered_targets_are_reached(spark):
    """On the given documents the query's expected shares lie within 0.01 of every registered target, once the
    values that the corpus lacks have left their shares to the others; ``largest_gap`` tells the rest."""
    got = Q.QUERIES["op2_mix_sources"](spark, SF_MID).toPandas()
    assert len(got) == documents(spark, SF_MID).count()
    assert ((got.probability >= 0) & (got.probability <= 1 + 1e-9)).all()
    weight = got.n_tokens * got.probability
    gaps = []
    for margin, targets in Q.TARGETS.items():
        present = {v: t for v, t in targets.items() if (got.n_tokens[got[margin] == v]).sum() > 0}
        for v, t in targets.items():
            share = weight[got[margin] == v].sum() / weight.sum()
            gaps.append(abs(share - t))
            assert share == pytest.approx(t / sum(present.values()) if v in present else 0.0, abs=0.01), (margin, v)
    assert got.largest_gap.nunique() == 1 and got.largest_gap[0] == pytest.approx(max(gaps), abs=1e-6)


def test_topics(spark):
    rows = [(1, "plain"), (2, "MIT License"), (3, "a@b.c c@d.e license"), (4, "x | y | license"), (5, None)]
    got = {r["doc_id"]: r["topic"] for r in X.mix(frame(spark, rows), Q.TARGETS).select("row.doc_id", "topic").collect()}
    assert got == {1: "general", 2: "legal", 3: "contact", 4: "legal" if "x | y | license".count(" | ") < 1 else "tables", 5: "general"}


def test_odd_rows(spark):
    docs = clashing(frame(spark, odd_rows()))
    got = X.mix(docs, TARGETS)
    assert got.count() == len(odd_rows())
    assert {r["topic"] for r in got.select("row.topic").collect()} == {"own topic"}
    twins = got.where("row.doc_id = 4").select("probability", "kept").collect()
    assert len(set(twins)) == 1
    assert X.mix(docs.limit(0), TARGETS).count() == 0


def test_pipeline_stage_keeps_the_columns(spark):
    docs = frame(spark, corpus(200))
    out = corpus_pipeline.mix_sources(spark, docs, "")
    assert out.columns == docs.columns and 0 < out.count() < 200
