"""Claim events in transport envelopes: time, body, partition and offset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.schemas import ENVELOPE


def select_envelope(df: DataFrame) -> DataFrame:
    """Envelope columns under the names the parser takes; the offset is kept, so that events can
    be told apart later."""
    return df.select(
        F.col("enqueuedTime").alias("event_time"),
        F.col("body").cast("string").alias("payload"),
        F.col("partition").cast("string").alias("partition_id"),
        F.col("offset").cast("string").alias("eh_offset"),
    )


def from_kafka(df: DataFrame) -> DataFrame:
    """Columns of the ``kafka`` source as an envelope.

    Read with ``spark.readStream.format("kafka").option("startingOffsets", "latest")
    .option("maxOffsetsPerTrigger", 10000)``; the connector has to be on the class path.
    """
    return df.select(
        F.col("timestamp").alias("enqueuedTime"),
        F.col("value").alias("body"),
        F.col("partition").cast("string").alias("partition"),
        F.col("offset").cast("string").alias("offset"),
    )


def envelope_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """Streaming scan of envelope files; ``max_files_per_trigger`` limits one micro-batch."""
    reader = spark.readStream.schema(ENVELOPE).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
