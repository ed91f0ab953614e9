"""The registered queries of the corpus operators and their DuckDB texts, where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, html_text, lexical, line_dedup, mixing, packing, quality_model, quality_rules, secret_scan, simhash, spelling, token_store
from .common import documents, scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco


def sha256_of(col: Column) -> Column:
    return F.sha2(col, 256)


@register("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of 3-word shingles, linked at 2 bits or fewer: fingerprint and component per document."""
    groups = simhash.simhash_groups(documents(spark, sf_dir), words=3, max_bits=2)
    return groups.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@register(
    "op3_line_dedup",
    rf"""
WITH l AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{_UPPER}', '{_LOWER}') AS key FROM l
), f AS (
  SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
  sha256(coalesce(string_agg(CASE WHEN f.key IS NULL THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY doc_id
""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in 10 documents or more go everywhere: line counts and the kept text's digest."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs, min_chars=1, min_docs=10))
    return kept.select("row.doc_id", "n_lines", "n_dropped", sha256_of(F.col("kept_text")).alias("kept_sha256"))


def _secret_sql() -> str:
    """Per rule the pieces between matches and the matches; running sums of lengths give starts."""
    rules = secret_scan.BASE + secret_scan.MORE
    per = []
    for i, r in enumerate(rules):
        regex = secret_scan.scan_regex(r).replace("'", "''")
        per.append(
            f"SELECT doc_id, {i} AS rnk, '{r.kind}' AS kind, {r.least} AS least, string_split_regex(t, '{regex}') AS gaps, "
            f"regexp_extract_all(t, '{regex}') AS found, regexp_extract_all(t, '{regex}', {r.group}) AS part FROM d"
        )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(per)}),
e AS (
  SELECT doc_id, rnk, kind, least, unnest(range(1, len(found) + 1)) AS i, unnest(gaps[1:len(found)]) AS gap, unnest(found) AS whole, unnest(part) AS part
  FROM m WHERE len(found) > 0
), w AS (
  SELECT doc_id, rnk, kind, least, length(whole) AS size, length(part) AS part,
    sum(length(gap) + length(whole)) OVER (PARTITION BY doc_id, rnk ORDER BY i) AS fin
  FROM e
), s AS (SELECT doc_id, rnk, kind, fin - size AS start, kind || ':' || (fin - size)::BIGINT || ':' || fin::BIGINT AS span FROM w WHERE part >= least),
g AS (
  SELECT doc_id, count(*) FILTER (WHERE rnk = 0) AS n_assign, count(*) FILTER (WHERE rnk = 1) AS n_access, count(*) FILTER (WHERE rnk = 2) AS n_hex,
    string_agg(span, ',' ORDER BY start, rnk) FILTER (WHERE rnk < 3) AS base, string_agg(span, ',' ORDER BY start, rnk) AS spans
  FROM s GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


@register("op4_secret_scan", _secret_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base secrets and further credential formats of every text, with their positions."""
    found = secret_scan.secret_spans(documents(spark, sf_dir))
    base = F.filter("found", lambda s: s["rank"] < len(secret_scan.BASE))

    def count(rank: int) -> Column:
        return F.size(F.filter("found", lambda s: s["rank"] == rank)).cast("long")

    return found.select(
        F.col("id").alias("doc_id"),
        *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(secret_scan.BASE)],
        sha256_of(secret_scan.span_text(base)).alias("base_sha256"),
        secret_scan.span_text(F.col("found")).alias("spans"),
    )


@register("op5_token_binary")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: place, count and digest of each one's ids."""
    folder = scratch_path(spark, "token-files")
    token_store.write_tokens(documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    read = token_store.read_tokens(spark, folder)
    return read.select(F.col("id").alias("doc_id"), "start", F.col("n").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@register("op6_byte_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of all texts and the decoded bytes, as digests."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), path, public_tokenizers.PATTERN)
    decoded = coded.select("doc_id", "ids", bpe.decode(F.col("ids"), spark, path).alias("back"))
    return decoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        sha256_of(F.col("ids")).alias("ids_sha256"),
        sha256_of(F.col("back")).alias("decoded_sha256"),
    )


@register(
    "op7_exact_dedup",
    """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts; the largest id stays."""
    return exact_dedup.exact_groups(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


ACCEPT = 0.3  # scores below this are predicted 0


@register("op9_quality_classifier")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality score of every document."""
    scored = quality_model.score_quality(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return scored.select(F.col("id").alias("doc_id"), "held_out", "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


@register("op10_quality_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of base rules and robust outliers."""
    return quality_rules.quality_rules(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


#: The mixture that the corpus is brought to, as shares of its tokens.
TARGETS = {
    "source": {"src0": 0.25, "src1": 0.05, "src2": 0.05, "src3": 0.05, "*": 0.60},
    "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.12, "*": 0.03},
    "topic": {"general": 0.85, "legal": 0.04, "contact": 0.04, "tables": 0.04, "settings": 0.03},
}
KEEP_SHARE = 0.8


@register("op2_mix_sources")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell, sampling probability and decision of every document under the target mixture, and how far it misses."""
    return mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "source", "lang"), TARGETS, keep_share=KEEP_SHARE).select("row.doc_id", *mixing.MARGINS, "n_tokens", "probability", "kept", "largest_gap")


@register("op8_html_extraction")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@register("op11_packing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 4,096 tokens, with a digest of their ids."""
    pieces = packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096)
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@register(
    "op12_lexical_search",
    rf"""
WITH t AS (
  SELECT doc_id, unnest(ts) AS term, len(ts) AS n
  FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}') AS ts FROM documents)
), p AS (SELECT doc_id, term, n, count(*) AS tf FROM t GROUP BY ALL),
g AS (SELECT count(DISTINCT doc_id) AS docs, count(*) AS terms FROM t),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, g GROUP BY term, docs),
q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}')) AS term FROM benchmark
), s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term), g GROUP BY item_id, doc_id
), r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of each benchmark item."""
    return lexical.rank_documents(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), k=20)


def _crc32_sql(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes by the byte table ``crc`` (column t)."""
    codes = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), (2 * i + 1)::INT, 2))::BIGINT)"
    return f"xor(4294967295, list_reduce({codes}, lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1]), 4294967295))"


@register(
    "op13_spelling",
    rf"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
  FROM (SELECT unnest(range(256)) AS b)
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
), per AS (
  SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL
), h AS (
  SELECT run, n, {_crc32_sql("(doc_id || ':' || run)")} AS h FROM per, crc
), made AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM h
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM made WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), less AS (
  SELECT word, n, i, substr(word, 1, i::INT - 1) || substr(word, i::INT + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT l.word, l.n, w.word, w.n FROM less l JOIN words w ON l.rest = w.word
  UNION SELECT w.word, w.n, l.word, l.n FROM less l JOIN words w ON l.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word
), judged AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * words.n THEN other END AS form, CASE WHEN other_n >= 2 * words.n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), way AS (
  SELECT word, word AS at FROM judged
  UNION ALL SELECT way.word, form FROM way JOIN judged ON judged.word = way.at WHERE form IS NOT NULL
)
SELECT judged.word, judged.form, way.at AS root, judged.n, judged.n_near, judged.form_n
FROM judged JOIN way USING (word) JOIN judged last ON last.word = way.at WHERE last.form IS NULL
""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word of the documents."""
    return spelling.spelling_groups(documents(spark, sf_dir), least_length=5, least_count=3, factor=2)
