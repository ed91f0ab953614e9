"""The corpus pipeline: score, clean, deduplicate, mix and encode the documents.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, line_dedup, mixing, quality_model, queries, simhash
from tessera.llm.common import documents, scratch, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    scored = quality_model.score_quality(docs, table(spark, sf_dir, "labels"), with_row=True)
    return scored.where(F.col("score") >= queries.ACCEPT).select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that many documents share; ``n_chars`` follows the text."""
    kept = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs, min_chars=1, min_docs=10))
    # a text that loses nothing, a null one included, stays as it is
    changed = F.col("row").withField("text", F.col("kept_text")).withField("n_chars", F.length("kept_text").cast("long"))
    return kept.select(F.when(F.col("n_dropped") > 0, changed).otherwise(F.col("row")).alias("row")).select("row.*")


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.one_of_each(docs, words=3, max_bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights."""
    return mixing.mix(docs, queries.TARGETS, keep_share=queries.KEEP_SHARE).where("kept").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, checked by decoding them."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, public_tokenizers.PATTERN)
    back = coded.withColumn("_back", bpe.decode(F.col("ids"), spark, path))
    same = F.col("_back") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return back.select("doc_id", "lang", "source", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality classifier", classify),
    ("line dedup", drop_lines),
    ("simhash near-dedup", dedup_near),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode),
]

#: Random features, fingerprints and merges are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
