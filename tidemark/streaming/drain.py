"""Scheduled drains: pull what is new, once per run, and stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.landing import parse_landing
from tidemark.sources.registry import ARRIVAL

RAW_SCHEMA = T.StructType([T.StructField(ARRIVAL, T.TimestampNTZType()), T.StructField("value", T.StringType())])


def raw_file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Event text from a folder that files are added to."""
    reader = spark.readStream.schema(RAW_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def raw_broker_stream(spark: SparkSession, options: dict[str, str], source_format: str = "kafka") -> DataFrame:
    """Event text from a message broker whose connector is on the class path."""
    records = spark.readStream.format(source_format).options(**options).load()
    return records.select(
        F.col("timestamp").cast("timestamp_ntz").alias(ARRIVAL), F.col("value").cast("string").alias("value")
    )


def finish(query: StreamingQuery) -> None:
    """Wait for a drain to end. What it read is counted where it was written: progress updates are kept for some batches only."""
    query.awaitTermination()


def drain(raw: DataFrame, landing_path: str, checkpoint_path: str) -> None:
    """Append the new events to the landing.

    The checkpoint holds the consumed offsets: a second run with nothing new
    reads nothing. One owner per checkpoint; the file sink's log makes a
    repeated batch harmless.
    """
    query = (
        parse_landing(raw)
        .writeStream.format("parquet")
        .partitionBy("__table")
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start(landing_path)
    )
    finish(query)


def change_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Append-only stream over a typed landing folder, its initial rows included."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def consume(changes: DataFrame, out_path: str, checkpoint_path: str) -> None:
    """Append what the stream has not yet delivered to `out_path`."""
    query = (
        changes.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start(out_path)
    )
    finish(query)
