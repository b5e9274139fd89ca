"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.llm import (decontaminate, exact_dedup, html_text, language, merge_dropout, merkle, more_sql, ngram_join,
                            packing, pivot_search, sharding, spelling, token_counts, url_rules)
from claimworks.llm.common import table

SHARD_BYTES = 1 << 20


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = language.held_out(F.col("doc_id"))
    profiles = language.learn(docs.filter(~held))
    return language.predict(docs, profiles).withColumn("held_out", held)


def op3_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with dropout and decoded again."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = merge_dropout.decode(merge_dropout.encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
                        F.crc32("ids").alias("ids_crc32"),
                        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled page is one whose id has a label; toxic ones are to be blocked."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (F.col("toxic") == 1).alias("blocked"))
    return url_rules.judge(table(spark, sf_dir, "pages"), labels)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of at most 1 MiB of text, small so that test tables need many."""
    return sharding.assign(table(spark, sf_dir, "documents"), "doc_id", ["text"], SHARD_BYTES)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"),
                                       public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op10_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_k(table(spark, sf_dir, "embeddings"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows are found with lower-cased text where 5 divides the checksum of their id."""
    picked = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = F.when(picked, F.translate("text", more_sql.UPPER, more_sql.LOWER)).otherwise(F.col("text"))
    return merkle.prove(table(spark, sf_dir, "documents"), more_sql.LEAF_FIELDS, "doc_id", "source", {"text": found})


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_forms(table(spark, sf_dir, "documents"))


def op13_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_language, op3_merge_dropout, op4_url_rules, op5_exact_dedup, op6_ngram_join, op7_sharding, op8_html_text,
    op9_token_counts, op10_pivot_search, op11_merkle, op12_spelling, op13_winnowing)}

ORACLE = {
    **more_sql.ORACLE,
    "op6_ngram_join": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
            ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS g
          FROM w),
        e AS (SELECT doc_id, unnest(g) AS g FROM s),
        i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
          GROUP BY ALL),
        l AS (SELECT a, b FROM i JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
          WHERE 100 * c >= 80 * (len(x.g) + len(y.g) - c)),
        r AS (SELECT doc_id AS d, doc_id AS m FROM documents UNION SELECT l.a, r.m FROM r JOIN l ON l.b = r.d)
        SELECT doc_id, len(g)::BIGINT AS n_shingles, (SELECT min(m) FROM r WHERE d = doc_id) AS component_id,
               (SELECT count(*) FROM l WHERE a = doc_id) AS n_links FROM s""",
    "op7_sharding": f"""
        WITH a AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS n_bytes,
                          ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS w FROM documents),
        d AS (SELECT a.*, depth::INTEGER AS depth, w >> (60 - depth) AS of
              FROM a, (SELECT unnest(range(0, 61)) AS depth)),
        s AS (SELECT *, sum(n_bytes) OVER p AS shard_bytes, count(*) OVER p AS n FROM d
              WINDOW p AS (PARTITION BY depth, of))
        SELECT doc_id, n_bytes, substr(lpad(bin(w), 60, '0'), 1, depth) AS shard, depth,
               shard_bytes::BIGINT AS shard_bytes, shard_bytes <= {SHARD_BYTES} AS fits
        FROM s WHERE shard_bytes <= {SHARD_BYTES} OR n = 1
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1""",
    "op10_pivot_search": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
                   WHERE embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
        SELECT q.vec_id AS query_id,
               (row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.e, c.e) DESC, c.vec_id))::INTEGER
                   AS rank,
               c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
        FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0 QUALIFY rank <= 5""",
    "op5_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256,
               CASE WHEN NOT bool_or(doc_id <= middle) OVER w THEN 'fresh'
                    WHEN bool_or(doc_id > middle) OVER w THEN 'repeat' ELSE 'history' END AS origin
        FROM documents, (SELECT min(doc_id) + (max(doc_id) - min(doc_id)) // 2 AS middle FROM documents)
        WINDOW w AS (PARTITION BY coalesce(text, ''))""",
}
