"""Fitted jobs applied to file streams give the batch results."""

from pyspark.sql import functions as F

from tessera.plans.tabular import TabularOptions, TabularPrep
from tessera.streaming.scoring import read_parquet_stream, read_table_stream, run_available, transform_stream

from .conftest import SF_MID


def test_fitted_tabular_job_on_a_stream_equals_batch(spark):
    batch = spark.read.parquet(f"{SF_MID}/customer.parquet")
    prep = TabularPrep(TabularOptions(outliers="median", scaling="normalisation"), key_columns=["c_custkey", "c_name"])
    prep.fit(batch, target="c_mktsegment")
    stream = read_parquet_stream(spark, SF_MID, batch.schema, glob="customer.parquet")
    got = run_available(spark, transform_stream(stream, prep), "tabular_stream_test")
    want = prep.transform(batch)
    cols = sorted(want.columns)
    a = {tuple(r) for r in got.select(*cols).collect()}
    b = {tuple(r) for r in want.select(*cols).collect()}
    assert a == b and len(a) == batch.count()
    assert got.where(F.col("c_acctbal") > 1.0).count() == 0  # min-max scaled into [0, 1]


def test_scored_stream_of_a_table_in_one_file_or_in_a_folder_of_files(spark, tmp_path):
    from tessera.queries import QUERIES, load_all

    load_all()
    table = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    table.repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    one = {tuple(r) for r in QUERIES["stream_score_mlp"](spark, SF_MID).collect()}
    several = QUERIES["stream_score_mlp"](spark, str(tmp_path)).collect()
    assert {tuple(r) for r in several} == one and len(several) == table.count()


def test_a_stream_without_files_gives_an_empty_table(spark, tmp_path):
    table = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    (tmp_path / "embeddings.parquet").mkdir()
    got = run_available(spark, read_parquet_stream(spark, str(tmp_path), table.schema), "empty_stream_test")
    assert got.columns == table.columns and got.count() == 0


def test_table_stream_reads_every_row(spark):
    got = run_available(spark, read_table_stream(spark, SF_MID, "customer"), "table_stream_test")
    assert got.count() == spark.read.parquet(f"{SF_MID}/customer.parquet").count()
