"""Table sinks in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_sets(df: DataFrame, path: str, set_col: str = "set", mode: str = "overwrite") -> None:
    """Write a prepared table partitioned by its set column (train / val / test folders), so a
    reader of one set prunes the others at file listing time."""
    df.write.mode(mode).partitionBy(set_col).parquet(path)


def read_set(spark: SparkSession, path: str, name: str, set_col: str = "set") -> DataFrame:
    """One set of a table written by :func:`write_sets` (partition filter → only its files)."""
    from pyspark.sql import functions as F

    return spark.read.parquet(path).where(F.col(set_col) == name)
