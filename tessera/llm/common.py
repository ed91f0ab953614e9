"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, ship_package


def prepare(spark: SparkSession) -> None:
    """Name the shared folder and make this package importable in Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the tables that this application's operators wrote to the shared folder. For when their
    results have been used; DataFrames that still read them fail afterwards."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def text_hash(col: str) -> Column:
    """64-bit hash of a text, used with the id to name a row."""
    return F.xxhash64(text_or_empty(col))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


#: Columns that name a row in joins: plain equality works on them, a null id included.
ROW = ["_row_id", "_row_null", "_row_hash"]


def with_row_key(df: DataFrame, id_col: str, hash_col: Column) -> DataFrame:
    """Add the ``ROW`` columns. Rows equal in id and text get equal keys."""
    return df.withColumns({"_row_id": F.coalesce(F.col(id_col).cast("long"), F.lit(0)), "_row_null": F.col(id_col).isNull(), "_row_hash": hash_col})
