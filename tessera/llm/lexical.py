"""Ranked lexical search over a length-stratified index.

Documents with the same length normaliser ``m`` form a stratum. Within a stratum all documents with the
same count of a term get the same score from it, so postings are grouped by (term, tf) and the impact
of a group is worked out once. The index is a table of stratum blocks (up to ``BLOCK`` documents of one
``m``), range-partitioned by ``m``; a block is searched by itself. The highest tf of each term bounds
the score that a block's documents can reach; every task visits its blocks in descending order of that
bound and leaves out those below a score that enough documents already have. A first pass visits each
batch's best block per query and gives all tasks such a score to begin with.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import shuffle_partitions

from .common import prepare, scratch, scratch_path, text_hash, text_or_empty
from .words import slices, split_words, spread

BLOCK = 4096  # documents of a stratum block
MAX_TERMS = 200_000  # terms of the queries searched together; more are searched in rounds

#: Bytes of terms stand for themselves, A-Z for a-z; all others (x00-x2F, x3A-x40, x5B-x60, x7B-x7F) end a term.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TABLE = bytes(b if chr(b).isalnum() and b < 128 or b > 127 else 32 for b in range(256)).translate(bytes.maketrans(_UPPER.encode(), _UPPER.lower().encode()))


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order, in UTF-8."""
    return text.encode("utf-8").translate(_TABLE).split()


def impact(tf, m: int):
    """What a term of weight 1 adds to the score of a document of normaliser ``m``."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _count_terms(docs: DataFrame, wanted: list[bytes] | None) -> DataFrame:
    """``(id, n, terms, tfs)`` per document; ``terms`` only those wanted, if a list is given."""
    known = None if wanted is None else docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(wanted)})

    def run(batches):
        for b in batches:
            for part in slices(b, 1):
                codes, at, words = split_words(part.column(1))
                split = [terms_of(w) for w in words]
                number = {t: i for i, t in enumerate(dict.fromkeys(t for ts in split for t in ts))} if known is None else known.value
                split_ids = [[number[t] for t in ts if t in number] for ts in split]
                all_sizes = np.fromiter(map(len, split), np.int64, len(split))
                running = np.concatenate([np.zeros(1, np.int64), np.cumsum(all_sizes[codes])])
                n = running[at[1:]] - running[at[:-1]]
                sizes = np.fromiter(map(len, split_ids), np.int64, len(split_ids))
                flat, begins = spread(codes, at, sizes, np.array([i for ts in split_ids for i in ts], np.int64))
                names = [t.decode("utf-8") for t in number]  # in the order of their numbers
                doc = np.repeat(np.arange(part.num_rows), np.diff(begins))
                pair, tf = np.unique(doc * max(1, len(names)) + flat, return_counts=True)
                doc, term = np.divmod(pair, max(1, len(names)))
                ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=part.num_rows))]), pa.int32())
                terms = pa.ListArray.from_arrays(ends, pa.array(names, pa.string()).take(pa.array(term)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), terms, pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32()))], names=["id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, "id long, n long, terms array<string>, tfs array<int>")


def _blocks(batches) -> Iterator[pa.RecordBatch]:
    """Stratum blocks of documents sorted by ``m``; columns m, id, terms, tfs."""
    for b in batches:
        m = b.column(0).to_numpy()
        ids = b.column(1)
        begins = b.column(2).offsets.to_numpy().astype(np.int64)
        begins = begins - begins[0]
        coded = b.column(2).flatten().dictionary_encode()
        # numbers of the terms in their order, so that a stratum's groups are sorted
        order = np.argsort(np.array(coded.dictionary.to_pylist(), object)) if len(coded.dictionary) else np.zeros(0, np.int64)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        names = coded.dictionary.take(pa.array(order, pa.int64()))
        term, tf = place[coded.indices.to_numpy()] if len(order) else np.zeros(0, np.int64), b.column(3).flatten().to_numpy()
        new = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
        cuts = sorted({c for x, y in zip(new, [*new[1:], len(m)]) for c in range(x, y, BLOCK)} | {len(m)})
        rows: list[list] = [[], [], [], [], [], []]
        for x, y in zip(cuts, cuts[1:]):
            p, q = begins[x], begins[y]
            doc = np.repeat(np.arange(y - x), np.diff(begins[x : y + 1]))
            by = np.lexsort((doc, tf[p:q], term[p:q]))
            t, f = term[p:q][by], tf[p:q][by]
            first = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (f[1:] != f[:-1])])) if q > p else np.zeros(0, np.int64)
            for column, value in zip(rows, (m[x], ids.slice(x, y - x).to_pylist(), names.take(pa.array(t[first])).to_pylist(), f[first], np.diff(np.concatenate([first, [q - p]])), doc[by])):
                column.append(value)
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), *[pa.list_(pa.int32())] * 3]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=["m", "ids", "terms", "tfs", "sizes", "docs"])


def build_index(docs: DataFrame, folder: str, terms: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Index every row of ``docs`` below ``folder``: tables ``totals`` (n_docs, n_terms), ``terms``
    (term, df) and ``strata`` (m, ids, and by (term, tf): terms, tfs, sizes, docs).

    ``terms`` restricts the postings to terms that will be searched; document lengths, counts and
    ``m`` are those of whole texts. Each row with a term is a document, repeated rows included; texts
    that are null, empty or without a term belong to no stratum. An empty table gives an empty index.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    wanted = None if terms is None else sorted({t.encode("utf-8") for t in terms})
    counted = scratch(_count_terms(rows, wanted), "term-counts").where("n > 0")
    totals = counted.agg(F.count("*").alias("n_docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_terms"))
    totals.write.parquet(f"{folder}/totals")
    counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).write.parquet(f"{folder}/terms")
    n_docs, n_terms = spark.read.parquet(f"{folder}/totals").first()
    m = F.expr(f"75L + (25L * n * {n_docs}L) div {max(1, n_terms)}L").alias("m")
    placed = counted.where(F.size("terms") > 0).select(m, "id", "terms", "tfs")
    # equal documents of a common length are dealt out by id; blocks of one m may lie in several ranges
    sorted_rows = placed.repartitionByRange("m", F.xxhash64("id", "terms")).sortWithinPartitions("m", "id")
    blocks = sorted_rows.mapInArrow(_blocks, "m long, ids array<long>, terms array<string>, tfs array<int>, sizes array<int>, docs array<int>")
    # searching costs most in the blocks of common lengths: they are dealt out evenly
    blocks.repartition(shuffle_partitions(spark), F.xxhash64("m", "ids")).write.parquet(f"{folder}/strata")


class _Queries:
    """The queries of a round in flat arrays, and the best documents found for each."""

    def __init__(self, queries: list[tuple[dict[str, int], int]], k: int):
        """``queries``: weight by term (repeats multiply it), and a score that k documents have (0: none)."""
        self.k = k
        self.number: dict[str, int] = {}
        flat = [(self.number.setdefault(t, len(self.number)), w) for ws, _ in queries for t, w in ws.items()]
        self.term = np.array([t for t, _ in flat], np.int64)
        self.weight = np.array([w for _, w in flat], np.int64)
        self.begin = np.cumsum([0, *[len(ws) for ws, _ in queries]])
        self.least = np.array([max(1, s) for _, s in queries], np.int64)
        self.found: list[list[tuple[int, int]]] = [[] for _ in queries]

    def bounds(self, numbers: np.ndarray, impacts: np.ndarray) -> np.ndarray:
        """The most that a document of a block can score, per query."""
        best = np.zeros(len(self.number) + 1, np.int64)
        np.maximum.at(best, numbers, impacts)
        best[-1] = 0
        return np.add.reduceat(np.concatenate([self.weight * best[self.term], [0]]), self.begin[:-1])

    def visit(self, q: int, ids: np.ndarray, numbers: np.ndarray, begins: np.ndarray, docs: np.ndarray, gains: np.ndarray) -> None:
        """Score the documents of a block; ``begins`` has where each term's postings begin and end."""
        score = np.zeros(len(ids), np.int64)
        for t, w in zip(self.term[self.begin[q] : self.begin[q + 1]].tolist(), self.weight[self.begin[q] : self.begin[q + 1]].tolist()):
            x, y = begins[t]
            if y > x:
                score[docs[x:y]] += w * gains[x:y]
        at = np.flatnonzero(score >= self.least[q])
        if len(at) > 4 * self.k:  # ties at the last place stay
            at = at[score[at] >= np.partition(score[at], -self.k)[-self.k]]
        if len(at):
            self.found[q] = sorted(self.found[q] + list(zip((-score[at]).tolist(), ids[at].tolist())))[: self.k]
            if len(self.found[q]) == self.k:
                self.least[q] = max(self.least[q], -self.found[q][-1][0])


NO_ID = -(1 << 63)  # stands for a null id, which goes first among equal scores


def _search_blocks(strata: DataFrame, queries: list[tuple[dict[str, int], int]], k: int, only_best: bool) -> DataFrame:
    """``(query, id, score)``: each task's best k documents per query."""
    shared = strata.sparkSession.sparkContext.broadcast(queries)

    def run(batches):
        state = _Queries(shared.value, k)
        for b in batches:
            blocks, bounds = [], []
            for m, terms, tfs, sizes in zip(*[b.column(c).to_pylist() for c in ("m", "terms", "tfs", "sizes")]):
                numbers = np.array([state.number.get(t, len(state.number)) for t in terms], np.int64)
                tf, size = np.array(tfs, np.int64), np.array(sizes, np.int64)
                impacts = impact(tf, m)
                bounds.append(state.bounds(numbers, impacts))
                blocks.append((numbers, size, impacts))
            bounds = np.array(bounds)
            order = np.argsort(-bounds, axis=0, kind="stable")
            opened: dict[int, tuple] = {}
            for rank in range(1 if only_best else len(blocks)):
                reach = bounds[order[rank], np.arange(bounds.shape[1])]
                going = np.flatnonzero((reach >= state.least) & (reach > 0))
                if not len(going):
                    break
                for q in going.tolist():
                    j = int(order[rank, q])
                    if j not in opened:
                        if len(opened) >= 64:
                            opened.clear()
                        numbers, size, impacts = blocks[j]
                        ends = np.cumsum(size)
                        begins = np.zeros((len(state.number) + 1, 2), np.int64)
                        last = np.flatnonzero(np.concatenate([numbers[1:] != numbers[:-1], [True]]))
                        begins[numbers[last], 1] = ends[last]
                        begins[numbers[last], 0] = np.concatenate([[0], ends[last][:-1]])
                        ids = np.array([NO_ID if i is None else i for i in b.column("ids")[j].as_py()], np.int64)
                        opened[j] = ids, numbers, begins, b.column("docs")[j].values.to_numpy(), np.repeat(impacts, size)
                    state.visit(q, *opened[j])
        rows = [(q, None if i == NO_ID else i, -s) for q, best in enumerate(state.found) for s, i in best]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ((), (), ()), (pa.int32(), pa.int64(), pa.int64()))], names=["query", "id", "score"])

    return strata.select("m", "ids", "terms", "tfs", "sizes", "docs").mapInArrow(run, "query int, id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _rounds(items: DataFrame) -> Iterator[list]:
    """The items, collected in rounds of about ``MAX_TERMS`` terms."""
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    rounds = -(-total // MAX_TERMS)
    for r in range(rounds):
        yield items.where(F.pmod(F.xxhash64("_item_key"), F.lit(rounds)) == r).collect()


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of each item with a score above 0.

    The index is built over all rows of ``docs``, its postings for the items' terms (for all terms if the
    items have more than ``MAX_TERMS``). Items equal in id and text are one; items without terms, or
    whose terms no document has, have no rows. Repeated document rows rank each. Equal scores go by
    ascending id, null ids first. Other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    lower = F.translate(text_or_empty(item_text_col), _UPPER, _UPPER.lower())
    terms = F.regexp_extract_all(lower, F.lit("([^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+)"), F.lit(1))
    asked = items.select(F.col(item_id_col).alias("_item"), terms.alias("terms"), text_hash(item_text_col).alias("_item_key")).dropDuplicates(["_item", "_item_key"])
    asked = scratch(asked.where(F.size("terms") > 0), "items")
    n_terms = asked.select(F.explode("terms").alias("t")).agg(F.count_distinct("t")).first()[0]
    wanted = None
    if n_terms <= MAX_TERMS:
        wanted = [r["t"] for r in asked.select(F.explode("terms").alias("t")).distinct().collect()]
    folder = scratch_path(spark, "lexical-index")
    build_index(docs, folder, wanted, id_col, text_col)
    out = spark.createDataFrame([], f"item_id {asked.schema['_item'].dataType.simpleString()}, rank int, doc_id long, score long")
    for round_items in _rounds(asked):
        out = out.unionByName(search(spark, folder, [(r["_item"], r["terms"]) for r in round_items], asked.schema["_item"].dataType.simpleString(), k))
    return out


def search(spark: SparkSession, folder: str, items: list[tuple[object, list[str]]], item_type: str, k: int) -> DataFrame:
    """The best ``k`` documents of an index for each (item id, terms); as many items as memory holds."""
    n_docs = spark.read.parquet(f"{folder}/totals").first()["n_docs"]
    named = spark.createDataFrame([(t,) for t in sorted({t for _, ts in items for t in ts})], "term string")
    df = {r["term"]: r["df"] for r in spark.read.parquet(f"{folder}/terms").join(named, "term", "left_semi").collect()}
    asked = []
    for _, terms in items:
        weights: dict[str, int] = {}
        for t in terms:
            if t in df:
                weights[t] = weights.get(t, 0) + term_weight(n_docs, df[t])
        asked.append(weights)
    present = [i for i, w in enumerate(asked) if w]
    strata = spark.read.parquet(f"{folder}/strata")
    names = spark.createDataFrame([(n, items[i][0]) for n, i in enumerate(present)], f"query int, item_id {item_type}")
    if not present:
        return names.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where("false")
    seeds = _best(_search_blocks(strata, [(asked[i], 0) for i in present], k, only_best=True), k)
    least = {r["query"]: r["score"] for r in seeds.where(F.col("rank") == k).collect()}  # at most a row per query
    found = _search_blocks(strata, [(asked[i], least.get(n, 0)) for n, i in enumerate(present)], k, only_best=False)
    return _best(found, k).join(names, "query").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
