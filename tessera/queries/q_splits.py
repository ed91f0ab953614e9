"""Queries for splits, folds, shuffles, batches and label views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import splits
from ..sources.tables import read_table
from . import register
from .q_prep import _tabular_sql, tabular_fit

SEED = 42


def _quota_sql(src: str, n: str, frac: float, out: str) -> str:
    f = f"CAST('{frac!r}' AS DOUBLE)"
    return (
        f"CAST(floor({f} * {n}) AS BIGINT) + CASE WHEN row_number() OVER (ORDER BY {f} * {n} - floor({f} * {n}) DESC, g) "
        f"<= ceil({f} * CAST(sum({n}) OVER () AS DOUBLE)) - sum(CAST(floor({f} * {n}) AS BIGINT)) OVER () THEN 1 ELSE 0 END AS {out}"
    )


def split_sql(source: str, id_col: str, label_expr: str, val: float, test: float, seed: int, cols: str) -> str:
    """Oracle text of :func:`splits.three_way_split` over ``source`` (a query or table)."""
    vfrac = val / (1.0 - test) if val > 0 else 0.0
    qv = _quota_sql("qt", "(n - q_test)", vfrac, "q_val") if val > 0 else "CAST(0 AS BIGINT) AS q_val"
    return f"""
base AS (SELECT *, {label_expr} AS g FROM ({source})),
cnt AS (SELECT g, count(*) AS n FROM base GROUP BY g),
qt AS (SELECT g, n, {_quota_sql("cnt", "n", test, "q_test")} FROM cnt),
qv AS (SELECT g, q_test, {qv} FROM qt),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY md5(concat_ws('-', '{seed}', CAST({id_col} AS VARCHAR))), {id_col}) AS rn FROM base)
SELECT {cols}, CASE WHEN rn <= q_test THEN 'test' WHEN rn <= q_test + q_val THEN 'val' ELSE 'train' END AS set
FROM r JOIN qv USING (g)
"""


def _emb(spark, sf):
    return read_table(spark, sf, "embeddings").select("vec_id", "label")


@register("split_stratified", "WITH " + split_sql("SELECT vec_id, label FROM embeddings", "vec_id", "label", 0.0, 0.2, SEED, "vec_id, label"))
def q_split_stratified(spark, sf):
    return splits.stratified_split(_emb(spark, sf), "label", "vec_id", 0.2, SEED)


@register("split_random", "WITH " + split_sql("SELECT vec_id, label FROM embeddings", "vec_id", "0", 0.0, 0.2, SEED, "vec_id, label"))
def q_split_random(spark, sf):
    return splits.stratified_split(_emb(spark, sf), "label", "vec_id", 0.2, SEED, stratify=False)


@register("split_three_way", "WITH " + split_sql("SELECT vec_id, label FROM embeddings", "vec_id", "label", 0.2, 0.2, SEED, "vec_id, label"))
def q_split_three_way(spark, sf):
    return splits.three_way_split(_emb(spark, sf), "label", "vec_id", 0.2, 0.2, SEED)


def _split_tabular_sql() -> str:
    inner = _tabular_sql().strip()
    return "WITH " + split_sql(inner, "c_custkey", "c_mktsegment", 0.0, 0.25, SEED, "c_custkey, c_acctbal, c_nationkey, c_mktsegment")


@register("split_tabular", _split_tabular_sql())
def q_split_tabular(spark, sf):
    prep_job, prepared = tabular_fit(spark, sf)
    return prep_job.split(prepared, "c_custkey", test_size=0.25, seed=SEED)


@register(
    "cv_folds",
    f"""
WITH cnt AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
off AS (SELECT label, coalesce(sum(n) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM cnt),
r AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('-', '{SEED}', CAST(vec_id AS VARCHAR))), vec_id) AS rn FROM embeddings)
SELECT vec_id, label, CAST((o + rn - 1) % 5 AS BIGINT) AS fold FROM r JOIN off USING (label)
""",
)
def q_cv_folds(spark, sf):
    return splits.kfold(_emb(spark, sf), "label", "vec_id", 5, SEED)


@register(
    "batch_shuffle",
    f"""
SELECT vec_id, CAST(row_number() OVER (ORDER BY md5(concat_ws('-', '{SEED}', '3', CAST(vec_id AS VARCHAR))), vec_id) AS BIGINT) AS pos
FROM embeddings
""",
)
def q_batch_shuffle(spark, sf):
    return splits.epoch_order(_emb(spark, sf).select("vec_id"), "vec_id", SEED, 3)


@register(
    "batch_assign",
    f"""
SELECT vec_id, CAST((row_number() OVER (ORDER BY md5(concat_ws('-', '{SEED}', '3', CAST(vec_id AS VARCHAR))), vec_id) - 1) // 32 AS BIGINT) AS batch
FROM embeddings
""",
)
def q_batch_assign(spark, sf):
    return splits.assign_batches(_emb(spark, sf).select("vec_id"), "vec_id", SEED, 3, 32)


def _keyed_sql(epoch: int) -> str:
    """The keyed epoch order: Feistel turns as nested selects, walks of outside cells by recursion."""

    def digest(i: int, x: str) -> str:
        return f"CAST(('0x' || substr(md5(concat_ws('-', '{SEED}', '{epoch}', '{i}', CAST({x} AS VARCHAR))), 1, 13)) AS BIGINT)"

    def turned(source: str) -> str:
        sql = f"SELECT vec_id, x // b AS r, x % b AS c, a, b, n FROM {source}"
        for i in range(splits.FEISTEL_ROUNDS):
            move = f"(r + {digest(i, 'c')}) % a AS r, c" if i % 2 == 0 else f"r, (c + {digest(i, 'r')}) % b AS c"
            sql = f"SELECT vec_id, {move}, a, b, n FROM ({sql})"
        return f"SELECT vec_id, r * b + c AS x, a, b, n FROM ({sql})"

    return f"""
WITH RECURSIVE g AS (SELECT n, a, (n + a - 1) // a AS b FROM (SELECT count(*) AS n, CAST(floor(sqrt(count(*) - 1)) + 1 AS BIGINT) AS a FROM embeddings)),
places AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS x, a, b, n FROM embeddings, g),
walk AS ({turned("places")} UNION ALL {turned("(SELECT * FROM walk WHERE x >= n)")})
SELECT vec_id, CAST(x AS BIGINT) AS pos, CAST(x // 32 AS BIGINT) AS batch FROM walk WHERE x < n
"""


@register("epoch_order_keyed", _keyed_sql(3))
def q_epoch_order_keyed(spark, sf):
    """Place and batch of every row in epoch 3, without moving a row after the first numbering."""
    e = splits.dense_positions(_emb(spark, sf).select("vec_id"), "vec_id")
    n = e.count()
    return e.select("vec_id", splits.keyed_order("at", n, SEED, 3).alias("pos"), splits.keyed_batches("at", n, SEED, 3, 32).alias("batch"))


@register(
    "label_onehot",
    """
SELECT vec_id, CAST(k AS BIGINT) AS k, CAST(CASE WHEN k = label THEN 1.0 ELSE 0.0 END AS DOUBLE) AS y
FROM embeddings, (SELECT unnest(range(CAST((SELECT max(label) + 1 FROM embeddings) AS BIGINT))) AS k) t
""",
)
def q_label_onehot(spark, sf):
    e = _emb(spark, sf)
    k = e.select(F.max("label")).first()[0] + 1  # width fixed from the whole data
    oh = e.select("vec_id", splits.label_onehot("label", int(k)).alias("y"))
    return oh.select("vec_id", F.posexplode("y").alias("k", "y")).withColumn("k", F.col("k").cast("bigint"))


@register(
    "distinct_labels",
    "SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS BIGINT) AS idx, label FROM (SELECT DISTINCT label FROM embeddings)",
)
def q_distinct_labels(spark, sf):
    from ..operators.ranking import numeric_row_number

    d = _emb(spark, sf).select("label").distinct()
    return numeric_row_number(d, "label", out="idx").select((F.col("idx") - 1).cast("bigint").alias("idx"), "label")


@register("summary_dataset", "SELECT count(*) AS n_rows, count(DISTINCT label) AS n_labels FROM embeddings")
def q_summary_dataset(spark, sf):
    return _emb(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("label").alias("n_labels"))


@register(
    "sink_split_sets",
    "WITH " + split_sql(_tabular_sql().strip(), "c_custkey", "c_mktsegment", 0.0, 0.25, SEED,
                        "c_custkey, c_acctbal, c_nationkey, c_mktsegment")
    .rstrip() .replace("FROM r JOIN qv USING (g)", "FROM r JOIN qv USING (g) WHERE rn <= q_test"),
)
def q_sink_split_sets(spark, sf):
    """Prepared and split customers written partitioned by set into the shared folder; the
    test set read back through partition pruning."""
    import uuid

    from ..session import shared_path
    from ..sources.sinks import read_set, write_sets

    prep_job, prepared = tabular_fit(spark, sf)
    path = shared_path(spark, "sets", uuid.uuid4().hex)
    write_sets(prep_job.split(prepared, "c_custkey", test_size=0.25, seed=SEED), path)
    return read_set(spark, path, "test").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment", "set")


@register(
    "split_hash",
    f"""
WITH u AS (SELECT vec_id, label,
                  CAST(CAST(('0x' || substr(md5(concat_ws('-', '{SEED}', CAST(vec_id AS VARCHAR))), 1, 13)) AS BIGINT) AS DOUBLE)
                  / CAST(4503599627370496 AS DOUBLE) AS u
           FROM embeddings)
SELECT vec_id, label, CASE WHEN u < 0.2 THEN 'test' WHEN u < 0.2 + 0.2 THEN 'val' ELSE 'train' END AS set FROM u
""",
)
def q_split_hash(spark, sf):
    """Approximate three-way split without a shuffle (threshold on a seeded uniform)."""
    return splits.hash_split(_emb(spark, sf), "vec_id", 0.2, 0.2, SEED)


@register(
    "batch_hash",
    f"""
SELECT vec_id, CAST(floor(CAST(CAST(('0x' || substr(md5(concat_ws('-', '{SEED}', '3', CAST(vec_id AS VARCHAR))), 1, 13)) AS BIGINT) AS DOUBLE)
                    / CAST(4503599627370496 AS DOUBLE) * 8) AS BIGINT) AS batch
FROM embeddings
""",
)
def q_batch_hash(spark, sf):
    """Shuffle-free batch assignment for epoch 3 into 8 batches (expected sizes)."""
    return splits.hash_batches(_emb(spark, sf).select("vec_id"), "vec_id", SEED, 3, 8)
