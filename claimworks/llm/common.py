"""Helpers the operators share."""

from __future__ import annotations

import os
import re
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from claimworks.session import scratch_path

BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SPACE = re.compile(r"(?<=[^ \t\n\r\f\v])(?=[ \t\n\r\f\v])")


def ready(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, wherever the session
    was started. A cluster gets the package with ``--py-files`` or installed. Texts are long, so a
    session that leaves the Arrow batch at Spark's 10,000 rows gets batches of ``BATCH_ROWS``."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write to the shared scratch folder and read again: cuts lineage and fixes the rows."""
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def extended(schema: StructType, **types: str) -> StructType:
    """A copy of a schema with further fields; ``StructType.add`` would change the frame's own."""
    return StructType([*schema.fields, *(StructField(n, StructType.fromDDL(f"x {t}")[0].dataType) for n, t in types.items())])


def segments(text: str, size: int = 1 << 18):
    """The whole text in pieces of about ``size`` characters, cut only before white space that
    follows another character, so that memory stays bounded for very long texts."""
    start = 0
    while len(text) - start > size:
        cut = _SPACE.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective mix of unsigned 64-bit words (the splitmix finaliser)."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
