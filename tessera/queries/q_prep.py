"""Queries for tabular preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..functions.strings import normalise_path, strip_prefix
from ..operators import prep
from ..operators.quality import dq_summary
from ..plans.tabular import TabularOptions, TabularPrep
from ..sources.tables import read_table
from . import register
from .fixtures import CUSTOMER_NULLS_SQL, customer_with_nulls

CN = f"cn AS ({CUSTOMER_NULLS_SQL})"


# ----------------------------------------------------------------------------- strings
@register(
    "str_strip_prefix",
    """
SELECT page_id, CASE WHEN starts_with(url, 'http://') THEN substr(url, 8) ELSE url END AS stripped
FROM pages
""",
)
def q_str_strip_prefix(spark, sf):
    p = read_table(spark, sf, "pages")
    return p.select("page_id", strip_prefix(F.col("url"), "http://").alias("stripped"))


@register(
    "str_normalise_path",
    """
SELECT page_id,
       '/data/' || array_to_string(list_filter(string_split(regexp_replace(url, '^[a-z]+://', ''), '/'),
                                                lambda s: s <> '' AND s <> '.'), '/') AS path
FROM pages
""",
)
def q_str_normalise_path(spark, sf):
    p = read_table(spark, sf, "pages")
    rel = strip_prefix(strip_prefix(F.col("url"), "https://"), "http://")
    return p.select("page_id", normalise_path(F.lit("/data"), rel).alias("path"))


# ----------------------------------------------------------------------------- kinds, nulls
_KIND = "CASE WHEN any_value(typeof({c})) IN ('TINYINT','SMALLINT','INTEGER','BIGINT','HUGEINT','FLOAT','DOUBLE') OR any_value(typeof({c})) LIKE 'DECIMAL%' THEN 'numeric' ELSE 'categorical' END"


def _kinds_sql(table: str, cols: list[str]) -> str:
    parts = [
        f"SELECT CAST({i + 1} AS BIGINT) AS ordinal, '{c}' AS col_name, {_KIND.format(c=c)} AS kind, count({c}) AS n_values FROM {table}"
        for i, c in enumerate(cols)
    ]
    return "\nUNION ALL\n".join(parts)


@register("prep_split_kinds", _kinds_sql("customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]))
def q_prep_split_kinds(spark, sf):
    c = read_table(spark, sf, "customer")
    kinds = {f: "numeric" for f in prep.numeric_columns(c)}
    kinds.update({f: "categorical" for f in prep.categorical_columns(c)})
    counts = c.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i + 1).cast("bigint").alias("ordinal"), F.lit(f).alias("col_name"),
                             F.lit(kinds[f]).alias("kind"), F.col(f).isNotNull().cast("bigint").alias("nn"))
                    for i, f in enumerate(c.columns)
                ]
            )
        ).alias("s")
    ).select("s.*")
    return counts.groupBy("ordinal", "col_name", "kind").agg(F.sum("nn").alias("n_values"))


@register("prep_impute_num_drop", f"WITH {CN} SELECT * FROM cn WHERE c_custkey IS NOT NULL AND c_nationkey IS NOT NULL AND c_acctbal IS NOT NULL")
def q_prep_impute_num_drop(spark, sf):
    df = customer_with_nulls(spark, sf)
    return prep.impute_numeric(df, prep.numeric_columns(df), "drop")


@register("prep_impute_cat_drop", f"WITH {CN} SELECT * FROM cn WHERE c_mktsegment IS NOT NULL")
def q_prep_impute_cat_drop(spark, sf):
    df = customer_with_nulls(spark, sf)
    return prep.impute_categorical(df, prep.categorical_columns(df), "drop")


@register(
    "prep_impute_num_mean",
    f"""WITH {CN}
SELECT c_custkey, c_nationkey, round(coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM cn)), 6) + 0.0 AS c_acctbal, c_mktsegment FROM cn""",
)
def q_prep_impute_num_mean(spark, sf):
    df = customer_with_nulls(spark, sf)
    out = prep.impute_numeric(df, prep.numeric_columns(df), "mean")
    return out.withColumn("c_acctbal", r6("c_acctbal"))


@register(
    "prep_impute_num_median",
    f"""WITH {CN}
SELECT c_custkey, c_nationkey, round(coalesce(c_acctbal, (SELECT median(c_acctbal) FROM cn)), 6) + 0.0 AS c_acctbal, c_mktsegment FROM cn""",
)
def q_prep_impute_num_median(spark, sf):
    df = customer_with_nulls(spark, sf)
    out = prep.impute_numeric(df, prep.numeric_columns(df), "median")
    return out.withColumn("c_acctbal", r6("c_acctbal"))


_MOST = """(SELECT c_mktsegment FROM cn WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment
            ORDER BY count(*) {dir}, c_mktsegment LIMIT 1)"""


@register(
    "prep_impute_cat_most",
    f"WITH {CN} SELECT c_custkey, c_nationkey, c_acctbal, coalesce(c_mktsegment, {_MOST.format(dir='DESC')}) AS c_mktsegment FROM cn",
)
def q_prep_impute_cat_most(spark, sf):
    df = customer_with_nulls(spark, sf)
    return prep.impute_categorical(df, prep.categorical_columns(df), "most")


@register(
    "prep_impute_cat_less",
    f"WITH {CN} SELECT c_custkey, c_nationkey, c_acctbal, coalesce(c_mktsegment, {_MOST.format(dir='ASC')}) AS c_mktsegment FROM cn",
)
def q_prep_impute_cat_less(spark, sf):
    df = customer_with_nulls(spark, sf)
    return prep.impute_categorical(df, prep.categorical_columns(df), "less")


# ----------------------------------------------------------------------------- zeros, outliers
@register(
    "prep_zero_to_median",
    """
WITH m AS (SELECT median(l_discount) FILTER (WHERE l_discount <> 0) AS md, median(l_tax) FILTER (WHERE l_tax <> 0) AS mt FROM lineitem)
SELECT l_orderkey, l_linenumber,
       round(CASE WHEN l_discount = 0 THEN m.md ELSE l_discount END, 6) + 0.0 AS l_discount,
       round(CASE WHEN l_tax = 0 THEN m.mt ELSE l_tax END, 6) + 0.0 AS l_tax
FROM lineitem, m
""",
)
def q_prep_zero_to_median(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    out = prep.zeros_to_median(li, ["l_discount", "l_tax"])
    return out.select("l_orderkey", "l_linenumber", r6("l_discount").alias("l_discount"), r6("l_tax").alias("l_tax"))


def _outlier_sql(centre: str) -> str:
    return f"""
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, {centre} AS centre FROM events)
SELECT event_id,
       round(CASE WHEN value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) THEN centre ELSE value END, 6) + 0.0 AS value,
       CAST(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) AS BIGINT) AS was_outlier
FROM events, q
"""


def _outlier_query(strategy):
    def q(spark, sf):
        ev = read_table(spark, sf, "events").select("event_id", "value")
        # 'keep' still fits the fences, only to report which rows lie outside them.
        fences = prep.fit_outliers(ev, ["value"], "median" if strategy == "keep" else strategy)
        f = fences["value"]
        flag = ((F.col("value") < f["lower"]) | (F.col("value") > f["upper"])).cast("bigint")
        treated = prep.apply_outliers(ev.withColumn("was_outlier", flag), {} if strategy == "keep" else fences)
        return treated.select("event_id", r6("value").alias("value"), "was_outlier")

    return q


register("prep_outliers_keep", _outlier_sql("NULL").replace("THEN centre ELSE value END", "THEN value ELSE value END"))(
    _outlier_query("keep")
)
register("prep_outliers_mean", _outlier_sql("avg(value)"))(_outlier_query("mean"))
register("prep_outliers_median", _outlier_sql("median(value)"))(_outlier_query("median"))


# ----------------------------------------------------------------------------- scaling
@register(
    "prep_standardise",
    """
WITH s AS (SELECT avg(c_acctbal) AS ma, stddev_pop(c_acctbal) AS sa, avg(c_nationkey) AS mn, stddev_pop(c_nationkey) AS sn FROM customer)
SELECT c_custkey,
       round((c_acctbal - ma) / CASE WHEN sa = 0 THEN 1 ELSE sa END, 6) + 0.0 AS c_acctbal,
       round((c_nationkey - mn) / CASE WHEN sn = 0 THEN 1 ELSE sn END, 6) + 0.0 AS c_nationkey,
       CAST(0.0 AS DOUBLE) AS k
FROM customer, s
""",
)
def q_prep_standardise(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey", F.lit(1.0).alias("k"))
    out = prep.standardise(c, ["c_acctbal", "c_nationkey", "k"])
    return out.select("c_custkey", *[r6(x).alias(x) for x in ("c_acctbal", "c_nationkey", "k")])


@register(
    "prep_minmax",
    """
WITH s AS (SELECT min(c_acctbal) AS a0, max(c_acctbal) AS a1, min(c_nationkey) AS n0, max(c_nationkey) AS n1 FROM customer)
SELECT c_custkey,
       round((c_acctbal - a0) / CASE WHEN a1 = a0 THEN 1 ELSE a1 - a0 END, 6) + 0.0 AS c_acctbal,
       round((c_nationkey - n0) / CASE WHEN n1 = n0 THEN 1 ELSE n1 - n0 END, 6) + 0.0 AS c_nationkey,
       CAST(0.0 AS DOUBLE) AS k
FROM customer, s
""",
)
def q_prep_minmax(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey", F.lit(1.0).alias("k"))
    out = prep.minmax_scale(c, ["c_acctbal", "c_nationkey", "k"])
    return out.select("c_custkey", *[r6(x).alias(x) for x in ("c_acctbal", "c_nationkey", "k")])


@register(
    "prep_scale",
    """
WITH s AS (SELECT min(o_totalprice) AS p0, max(o_totalprice) AS p1 FROM orders)
SELECT o_orderkey, round((o_totalprice - p0) / CASE WHEN p1 = p0 THEN 1 ELSE p1 - p0 END, 6) + 0.0 AS o_totalprice, o_custkey
FROM orders, s
""",
)
def q_prep_scale(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    out = prep.scale(o, ["o_totalprice", "o_custkey"], "normalisation", exclude=["o_custkey"])
    return out.select("o_orderkey", r6("o_totalprice").alias("o_totalprice"), "o_custkey")


# ----------------------------------------------------------------------------- encoding
@register(
    "prep_label_encode",
    """
SELECT c_custkey, c_mktsegment,
       CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS BIGINT) AS code
FROM customer
""",
)
def q_prep_label_encode(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return prep.label_encode(c, "c_mktsegment", out="code")


@register(
    "prep_ordinal",
    """
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS DOUBLE) AS o_orderpriority FROM orders
""",
)
def q_prep_ordinal(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return prep.ordinal_encode(o, ["o_orderpriority"])


def _long(df, keys: list[str]):
    """One row per key and one-hot column, so the levels stay those of the data."""
    return df.unpivot(keys, [c for c in df.columns if c not in keys], "level", "value")


@register(
    "prep_onehot",
    """
SELECT p_partkey, 'p_type_' || l.p_type AS level, CAST(p.p_type = l.p_type AS DOUBLE) AS value
FROM part p, (SELECT DISTINCT p_type FROM part) l
""",
)
def q_prep_onehot(spark, sf):
    """One 0/1 column per level of the data, returned as rows."""
    p = read_table(spark, sf, "part").select("p_partkey", "p_type")
    return _long(prep.onehot_encode(p, ["p_type"]), ["p_partkey"])


@register(
    "prep_onehot_sparse",
    """
SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS BIGINT) AS idx, CAST(1.0 AS DOUBLE) AS value FROM part
""",
)
def q_prep_onehot_sparse(spark, sf):
    """Sparse one-hot of a column with as many levels as it likes: position and value."""
    p = read_table(spark, sf, "part").select("p_partkey", "p_name")
    return prep.onehot_sparse(p, ["p_name"]).select("p_partkey", F.col("p_name.index").alias("idx"), F.col("p_name.value").alias("value"))


@register(
    "prep_encode_categoricals",
    """
WITH base AS (
  SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS DOUBLE) AS o_orderpriority, o_orderstatus FROM orders)
SELECT o_orderkey, o_orderpriority, 'o_orderstatus_' || l.o_orderstatus AS level, CAST(b.o_orderstatus = l.o_orderstatus AS DOUBLE) AS value
FROM base b, (SELECT DISTINCT o_orderstatus FROM orders) l
""",
)
def q_prep_encode_categoricals(spark, sf):
    """Ordinal code of one column and one-hot of another, the latter as rows."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return _long(prep.encode_categoricals(o, ["o_orderpriority", "o_orderstatus"], ordinal=["o_orderpriority"]), ["o_orderkey", "o_orderpriority"])


@register(
    "prep_align_columns",
    """
SELECT c_custkey, c_acctbal, c_nationkey, c_mktsegment, c_name FROM customer
""",
)
def q_prep_align_columns(spark, sf):
    c = read_table(spark, sf, "customer")
    num = c.select("c_custkey", *[x for x in prep.numeric_columns(c) if x != "c_custkey"])
    cat = c.select("c_custkey", *prep.categorical_columns(c))
    return prep.align_columns(num, cat, "c_custkey")


@register(
    "split_features_target",
    """
SELECT c_custkey, CAST(i - 1 AS BIGINT) AS i, CAST(f[i] AS DOUBLE) AS feature, c_mktsegment
FROM (SELECT c_custkey, [CAST(c_nationkey AS DOUBLE), c_acctbal] AS f, c_mktsegment FROM customer), range(1, 3) t(i)
""",
)
def q_split_features_target(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    ft = prep.features_target(c, "c_mktsegment", ["c_nationkey", "c_acctbal"], keep=["c_custkey"])
    return ft.select("c_custkey", F.posexplode("features").alias("i", "feature"), "c_mktsegment").withColumn(
        "i", F.col("i").cast("bigint")
    )


# ----------------------------------------------------------------------------- quality
def _dq_sql() -> str:
    cols = [("l_quantity", True), ("l_extendedprice", True), ("l_discount", True), ("l_tax", True), ("l_returnflag", False)]
    parts = []
    for c, num in cols:
        mn = f"round(min({c}), 6) + 0.0" if num else "CAST(NULL AS DOUBLE)"
        mx = f"round(max({c}), 6) + 0.0" if num else "CAST(NULL AS DOUBLE)"
        nan = f"count_if(isnan({c}))" if num else "CAST(0 AS BIGINT)"
        parts.append(
            f"SELECT '{c}' AS col_name, count(*) AS n_rows, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null, CAST({nan} AS BIGINT) AS n_nan, "
            f"{mn} AS min_value, {mx} AS max_value FROM lineitem"
        )
    return "\nUNION ALL\n".join(parts)


@register("dq_checks", _dq_sql())
def q_dq_checks(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    out = dq_summary(li)
    return out.select("col_name", "n_rows", "n_null", "n_nan", r6("min_value").alias("min_value"), r6("max_value").alias("max_value"))


# ----------------------------------------------------------------------------- full tabular job
def _tabular_sql() -> str:
    return f"""
WITH {CN},
num AS (SELECT c_custkey, c_nationkey, coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM cn)) AS c_acctbal, c_mktsegment FROM cn),
q AS (SELECT quantile_cont(c_acctbal, 0.25) AS a1, quantile_cont(c_acctbal, 0.75) AS a3, median(c_acctbal) AS am,
             quantile_cont(c_nationkey, 0.25) AS n1, quantile_cont(c_nationkey, 0.75) AS n3, median(c_nationkey) AS nm FROM num),
o AS (SELECT c_custkey,
             CASE WHEN c_acctbal < a1 - 1.5*(a3-a1) OR c_acctbal > a3 + 1.5*(a3-a1) THEN am ELSE c_acctbal END AS c_acctbal,
             CASE WHEN c_nationkey < n1 - 1.5*(n3-n1) OR c_nationkey > n3 + 1.5*(n3-n1) THEN nm ELSE CAST(c_nationkey AS DOUBLE) END AS c_nationkey,
             c_mktsegment FROM num, q),
s AS (SELECT avg(c_acctbal) AS ma, stddev_pop(c_acctbal) AS sa, avg(c_nationkey) AS mn, stddev_pop(c_nationkey) AS sn FROM o),
m AS (SELECT c_mktsegment AS mode_seg FROM cn WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment ORDER BY count(*) DESC, c_mktsegment LIMIT 1),
f AS (SELECT c_custkey,
             round((c_acctbal - ma) / CASE WHEN sa = 0 THEN 1 ELSE sa END, 6) + 0.0 AS c_acctbal,
             round((c_nationkey - mn) / CASE WHEN sn = 0 THEN 1 ELSE sn END, 6) + 0.0 AS c_nationkey,
             coalesce(c_mktsegment, mode_seg) AS seg FROM o, s, m)
SELECT c_custkey, c_acctbal, c_nationkey, CAST(dense_rank() OVER (ORDER BY seg) - 1 AS BIGINT) AS c_mktsegment FROM f
"""


def tabular_fit(spark, sf):
    """The fitted tabular job on customer (nulls by rule) and its prepared output."""
    df = customer_with_nulls(spark, sf)
    opts = TabularOptions(outliers="median", scaling="standardisation", numeric_nulls="mean", categorical_nulls="most")
    prep_job = TabularPrep(opts, key_columns=["c_custkey"])
    out = prep_job.fit_transform(df, target="c_mktsegment")
    out = out.select("c_custkey", r6("c_acctbal").alias("c_acctbal"), r6("c_nationkey").alias("c_nationkey"), "c_mktsegment")
    return prep_job, out


def tabular_job(spark, sf):
    return tabular_fit(spark, sf)[1]


register("prep_tabular_fit_transform", _tabular_sql())(tabular_job)


# ----------------------------------------------------------------------------- tabular job at volume
_LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lineitem_tabular_sql() -> str:
    qcols = ", ".join(
        f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3, avg({c}) AS {c}_mu" for c in _LI_NUM
    )
    treat = ", ".join(
        f"CASE WHEN {c} < {c}_q1 - 1.5 * ({c}_q3 - {c}_q1) OR {c} > {c}_q3 + 1.5 * ({c}_q3 - {c}_q1) THEN {c}_mu ELSE {c} END AS {c}"
        for c in _LI_NUM
    )
    # the flags of the table's specification
    flags = ", ".join(f"CAST(l_returnflag = '{v}' AS DOUBLE) AS l_returnflag_{v}" for v in ("A", "N", "R"))
    mm = ", ".join(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in _LI_NUM)
    scaled = ", ".join(
        f"round(({c} - {c}_lo) / CASE WHEN {c}_hi = {c}_lo THEN 1 ELSE {c}_hi - {c}_lo END, 6) + 0.0 AS {c}" for c in _LI_NUM
    )
    return f"""
WITH src AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem),
z AS (SELECT median(l_discount) FILTER (WHERE l_discount <> 0) AS md, median(l_tax) FILTER (WHERE l_tax <> 0) AS mt FROM src),
s1 AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
              CASE WHEN l_discount = 0 THEN md ELSE l_discount END AS l_discount,
              CASE WHEN l_tax = 0 THEN mt ELSE l_tax END AS l_tax, l_returnflag, l_linestatus FROM src, z),
q AS (SELECT {qcols} FROM s1),
s2 AS (SELECT l_orderkey, l_linenumber, {treat}, l_returnflag, l_linestatus FROM s1, q),
mm AS (SELECT {mm} FROM s2),
s3 AS (SELECT l_orderkey, l_linenumber, {scaled}, l_returnflag,
              CAST(dense_rank() OVER (ORDER BY l_linestatus) - 1 AS BIGINT) AS l_linestatus FROM s2, mm)
SELECT l_orderkey, l_linenumber, {", ".join(_LI_NUM)}, {flags}, l_linestatus FROM s3
"""


@register("prep_tabular_lineitem", _lineitem_tabular_sql())
def q_prep_tabular_lineitem(spark, sf):
    """The tabular job at volume: invalid zeros → median, outliers → mean, min-max scaling,
    least-frequent fill, one-hot flag, label-encoded target."""
    li = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", *_LI_NUM, "l_returnflag", "l_linestatus"
    )
    opts = TabularOptions(outliers="mean", scaling="normalisation", numeric_nulls="median", categorical_nulls="less",
                          invalid_zeros=["l_discount", "l_tax"])
    out = TabularPrep(opts, key_columns=["l_orderkey", "l_linenumber"]).fit_transform(li, target="l_linestatus")
    return out.select(*[r6(c).alias(c) if c in _LI_NUM else F.col(c) for c in out.columns])


@register(
    "prep_outliers_doc_lengths",
    """
WITH q AS (SELECT quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.75) AS q3, median(n_chars) AS centre FROM documents)
SELECT doc_id,
       round(CASE WHEN n_chars < q1 - 1.5 * (q3 - q1) OR n_chars > q3 + 1.5 * (q3 - q1) THEN centre ELSE CAST(n_chars AS DOUBLE) END, 6) + 0.0 AS n_chars
FROM documents, q
""",
)
def q_prep_outliers_doc_lengths(spark, sf):
    """Median replacement of document-length outliers (an integer column with a long tail)."""
    d = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    out = prep.treat_outliers(d, ["n_chars"], "median")
    return out.select("doc_id", r6("n_chars").alias("n_chars"))
