"""Structured Streaming use of fitted jobs.

The reference has no streaming. What carries over is that a fitted tabular job
(:class:`~tessera.plans.tabular.TabularPrep`) is a chain of projections and a trained
network's scoring is a ``mapInArrow`` with a broadcast model — both stateless, so both apply
unchanged to a streaming DataFrame. No state store, watermark or stateful operator is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.scoring import score
from ..session import shared_path
from ..sources.tables import read_table


def read_parquet_stream(spark: SparkSession, directory: str, schema, glob: str | None = None,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Files arriving in ``directory`` (optionally only names matching ``glob``) as a stream."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(directory)


def read_table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A given table as a stream of its files, be it one file or a folder of files.

    A file source takes a folder or a glob, not one file; the braces make the table's own name a glob,
    which matches either.
    """
    schema = read_table(spark, sf_dir, name).schema
    return read_parquet_stream(spark, f"{sf_dir.rstrip('/')}/{{{name}.parquet}}", schema, max_files_per_trigger=max_files_per_trigger)


def score_stream(stream: DataFrame, layers, params, in_shape, data_col="data", keep=None) -> DataFrame:
    """Class probabilities and predictions for every arriving row."""
    return score(stream, layers, params, in_shape, data_col=data_col, keep=keep)


def transform_stream(stream: DataFrame, fitted_prep) -> DataFrame:
    """Apply a fitted tabular job (statistics fixed at fit time) to arriving rows."""
    return fitted_prep.transform(stream)


def run_available(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Process everything available now into a Parquet table in the shared folder, then stop.

    The file sink is exactly-once and its checkpoint lives next to it, so a restarted query
    resumes from the files already processed; the result is read back as a batch table
    (nothing is held on the driver). A stream without files gives an empty table.
    """
    base = shared_path(spark, "streams", name)
    q = (
        stream.writeStream.format("parquet").option("path", base + "/data")
        .option("checkpointLocation", base + "/_checkpoint").outputMode("append")
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(base + "/data")
