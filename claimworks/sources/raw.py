"""Raw claim files and the bronze table."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.constants import RAW_COLUMNS
from claimworks.schemas import CORRUPT, RAW_WITH_CORRUPT


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV files as text columns; rows that do not fit keep their line in one more column.

    ``multiLine`` stays off so that large files are split between tasks.
    """
    return (
        spark.read.schema(RAW_WITH_CORRUPT)
        .options(header=True, multiLine=False, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
        .csv(path)
    )


def add_provenance(
    df: DataFrame,
    batch_date: str | date | Column,
    run_ts: datetime | Column | None = None,
    source_file: Column | None = None,
) -> DataFrame:
    """Adds load date, load time, source file, batch id and the corrupt flag.

    ``batch_date`` may be a column, so several batches can be tagged in one pass.
    """
    day = batch_date if isinstance(batch_date, Column) else F.lit(str(batch_date)).cast("date")
    when = run_ts if isinstance(run_ts, Column) else (
        F.current_timestamp() if run_ts is None else F.lit(run_ts))
    origin = F.col("_metadata.file_path") if source_file is None else source_file
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    return df.select(
        *df.columns,
        day.alias("ingestion_date"),
        when.alias("ingestion_ts"),
        origin.alias("source_file"),
        F.concat(F.lit("batch_"), F.date_format(day, "yyyyMMdd")).alias("batch_id"),
        corrupt.alias("is_corrupt"),
    )


def read_batch(bronze: DataFrame, batch_date: str | date) -> DataFrame:
    """Sound rows of one load date; the date test is on the bare partition column, so it prunes."""
    day = F.lit(str(batch_date)).cast("date")
    return bronze.filter((F.col("ingestion_date") == day) & ~F.col("is_corrupt"))


def bronze_union(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """Batch and stream rows in one frame, matched by name; columns only one side has are NULL.

    Stream values are typed already and the cleaning step takes text, so they go back to text,
    in a form that parses to the same value; the identifier as it was sent.
    """
    if "provider_npi_text" in stream.columns:
        stream = stream.withColumn("provider_npi", F.col("provider_npi_text")).drop("provider_npi_text")
    texts = [F.col(c).cast("string").alias(c) if c in RAW_COLUMNS else F.col(c)
             for c in stream.columns]
    return batch.unionByName(
        stream.select(*texts).withColumn("is_corrupt", F.lit(False)), allowMissingColumns=True)
