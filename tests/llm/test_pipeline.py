"""The pipeline against a brute-force version of its stages, and the registered queries."""

import base64
import hashlib
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from tessera.llm import html_text, mixing, queries
from tessera.llm.common import documents, scratch
from tools.oracle_check import SPARK_TO_DUCK, table_hash

from ..conftest import SF_SMALL
from .test_line_dedup import brute as brute_lines
from .test_line_dedup import key
from .test_simhash import brute_fingerprint, brute_groups

NAMES = [
    "op1_simhash_near_dedup",
    "op2_mix_sources",
    "op3_line_dedup",
    "op4_secret_scan",
    "op5_token_binary",
    "op6_byte_bpe",
    "op7_exact_dedup",
    "op8_html_extraction",
    "op9_quality_classifier",
    "op10_quality_rules",
    "op11_packing",
    "op12_lexical_search",
    "op13_spelling",
]


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, SF_SMALL).collect()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "labels", "pages", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def bpe():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_all_queries_are_registered():
    found = E.queries()
    assert [n for n in found if n.startswith("op") and "_" in n] == sorted(queries.QUERIES, key=list(queries.QUERIES).index)
    assert set(NAMES) | {"pipeline"} <= set(found)
    assert set(queries.ORACLES) == {"op3_line_dedup", "op4_secret_scan", "op7_exact_dedup", "op12_lexical_search", "op13_spelling"} <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in sdf.collect()]
    con.execute(f"CREATE OR REPLACE VIEW oracle AS {queries.ORACLES[name]}")
    rel = con.execute("SELECT * FROM oracle")
    cols, types = [d[0] for d in rel.description], [str(d[1]) for d in rel.description]
    assert dict(zip(cols, types)) == {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    assert table_hash(sdf.columns, rows)[0] == table_hash(cols, rel.fetchall())[0]


def test_op1(spark, docs):
    got = sorted((r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in E.queries()[NAMES[0]](spark, SF_SMALL).collect())
    assert got == sorted(brute_groups([(d["doc_id"], d["text"]) for d in docs]))


def test_op2(spark, docs):
    got = E.queries()["op2_mix_sources"](spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(d["doc_id"] for d in docs)
    assert all(0 <= r["probability"] <= 1 for r in got)
    words = {d["doc_id"]: len(d["text"].encode().split()) for d in docs}
    assert all(r["n_tokens"] == words[r["doc_id"]] for r in got)
    kept = sum(r["n_tokens"] * r["probability"] for r in got)
    assert 0 < kept <= queries.KEEP_SHARE * sum(words.values()) * 1.001  # targets come first, so less may be kept
    gaps = [
        abs(sum(r["n_tokens"] * r["probability"] for r in got if r[m] == v) / kept - share)
        for m, targets in queries.TARGETS.items()
        for v, share in targets.items()
    ]
    assert all(r["largest_gap"] == pytest.approx(max(gaps), abs=1e-6) for r in got)


def test_op5(spark, docs):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in E.queries()["op5_token_binary"](spark, SF_SMALL).collect()}
    at = 0
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        ids = tok.encode(d["text"], add_special_tokens=False).ids + [2]
        assert got.pop(d["doc_id"]) == (at, len(ids), zlib.crc32(packed(ids)))
        at += len(ids)
    assert not got


def test_op6(spark, docs, bpe):
    got = {r["doc_id"]: tuple(r)[1:] for r in E.queries()["op6_byte_bpe"](spark, SF_SMALL).collect()}
    for d in docs:
        ids = bpe(d["text"])
        assert got.pop(d["doc_id"]) == (len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(d["text"].encode()).hexdigest())
    assert not got


def test_op8(spark, con):
    got = {r["page_id"]: tuple(r)[1:] for r in E.queries()["op8_html_extraction"](spark, SF_SMALL).collect()}
    for page, url, html in con.execute("SELECT page_id, url, html FROM pages").fetchall():
        text = html_text.main_text(html or "")
        assert got.pop(page) == (url, text, len(text))
    assert not got


def test_op9_and_op10_return_every_document(spark, docs):
    for name in ("op9_quality_classifier", "op10_quality_rules"):
        assert sorted(r["doc_id"] for r in E.queries()[name](spark, SF_SMALL).select("doc_id").collect()) == sorted(d["doc_id"] for d in docs)


def test_pipeline_matches_brute_force(spark, bpe):
    """Stages 2 to 5 recomputed in plain Python on what the classifier kept."""
    table = documents(spark, SF_SMALL)
    scored = {r["doc_id"]: r["predicted"] for r in E.queries()["op9_quality_classifier"](spark, SF_SMALL).collect()}
    now = scratch(corpus_pipeline.classify(spark, table, SF_SMALL), "test")
    rows = [tuple(r) for r in now.collect()]
    assert sorted(r[0] for r in rows) == sorted(d for d, p in scored.items() if p)
    # lines
    holders = Counter(k for r in rows for k in {key(x) for x in r[1].split("\n")})
    lines = {r[0]: "\n".join(x for x in r[1].split("\n") if not (key(x) and holders[key(x)] >= 10)) for r in rows}
    assert sorted((r[0], r[3]) for r in brute_lines([(r[0], r[1]) for r in rows])) == sorted((d, hashlib.sha256(t.encode()).hexdigest()) for d, t in lines.items())
    # groups
    groups = brute_groups(list(lines.items()))
    stay = {c for _, _, c in groups}
    assert brute_fingerprint("") == 0
    # sampling, by the operator's own decisions on this input
    meta = {r[0]: r for r in rows}
    deduped = spark.createDataFrame([(d, lines[d], meta[d][2], meta[d][3], len(lines[d])) for d in sorted(stay)], table.schema)
    chosen = {r["doc_id"] for r in mixing.mix(deduped, queries.TARGETS, keep_share=queries.KEEP_SHARE).where("kept").select("row.doc_id").collect()}
    out = corpus_pipeline.run(spark, SF_SMALL)
    got = {r["doc_id"]: r for r in out.collect()}
    assert set(got) == chosen and len(corpus_pipeline.STAGES) == 5
    for d, r in got.items():
        assert bytes(r["ids"]) == packed(bpe(lines[d])) and r["n_tokens"] == len(bpe(lines[d])) and r["round_trip"]
        assert (r["lang"], r["source"]) == (meta[d][2], meta[d][3])


def test_clear_scratch_deletes_what_was_written(spark):
    import glob

    from tessera.llm.common import clear_scratch
    from tessera.session import shared_path

    now = scratch(spark.range(3), "gone")
    assert now.count() == 3 and glob.glob(shared_path(spark, "llm", "gone-*"))
    clear_scratch(spark)
    assert not glob.glob(shared_path(spark, "llm", "*"))


def test_stages_take_empty_tables(spark):
    docs = documents(spark, SF_SMALL).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0
