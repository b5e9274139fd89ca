"""From raw documents to training sequences: four stages over everything the one before kept.

Each stage takes the documents that are left and returns them in the columns of ``documents``; the
last returns the pieces of packed sequences. ``run`` writes each stage's result to the shared
scratch folder and reads it again, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.llm import exact_dedup, language, ngram_join, packing
from claimworks.llm.common import ready, table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters or unlike every language. Learns from labelled documents
    that are not held out; a document's own label is never an input of its judgement."""
    ready(spark)
    taught = docs.filter(~language.held_out(F.col("doc_id")))
    profiles = language.learn_plain(taught)
    return language.resembling(docs, profiles, language.typical(taught, profiles))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays; a null id is less than any, a null text equals an
    empty one, and of rows that share text and id one stays. No rows give no rows."""
    ready(spark)
    return exact_dedup.without_repeats(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group of near copies (five words, 0.8) the one with the smallest id stays. Rows that
    share an id stay or go together; a group whose ids are all null stays whole, and so do texts
    without words. No rows give no rows."""
    ready(spark)
    found = ngram_join.ngram_join(docs)
    kept = found.filter(F.col("component_id").eqNullSafe(F.col("doc_id")) | F.col("component_id").isNull())
    kept = kept.select(F.col("doc_id").alias("kept")).distinct()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))  # in a struct, no name of the input can clash
    return rows.join(kept, F.col("row.doc_id").eqNullSafe(F.col("kept")), "left_semi").select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids. A null or empty text is its end id; null and shared ids are packed
    like others; no rows give no pieces."""
    ready(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("ngram_join", near_copies),
    ("packing", packed),
]

#: SQL has no tokenizer and no random vectors: tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
