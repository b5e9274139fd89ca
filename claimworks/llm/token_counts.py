"""Token counts without token ids: pieces are counted once per distinct pre-token.

1. Every distinct pre-token of the corpus goes to the tokenizer once, which gives a table of
   pre-token and number of pieces, with the number of batches it was seen in.
2. Each document is cut into pre-tokens again and their frequencies are joined with that table.
   The pre-tokens seen most often (at most ``head`` of them; one of more than ``HEAD_BYTES`` goes by
   the name of its digest, so at most 16 MB) are added up where the document is read, and only the
   frequencies of the rare rest are shuffled; no key of that shuffle is hot, since hot ones are in
   the head, a line of dashes in every document too.

Defined results: a null or empty text has no bytes and no tokens; null and repeated keys give one
row per input row; an empty table gives an empty result. Only key and text are read.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import segments, written
from claimworks.llm.tokens import byte_parts, count_pieces, load, special_strings

HEAD = 65_536
HEAD_BYTES = 256
_tokenizers: dict = {}


def tokenizer_at(path: str):
    if path not in _tokenizers:
        _tokenizers[path] = load(path)
    return _tokenizers[path]


def _parts(text: str, tokenizer) -> list[str]:
    if len(text) <= 1 << 18:
        return byte_parts(text, tokenizer)
    return [p for piece in segments(text) for p in byte_parts(piece, tokenizer)]


def pre_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``part, seen``: distinct pre-tokens and the number of documents with them."""
    def scan(batches):
        tokenizer = tokenizer_at(path)
        seen = Counter()
        for batch in batches:
            for body in batch.column(0):
                seen.update(set(_parts(body.as_py() or "", tokenizer)))
            if len(seen) > 500_000:
                yield _frame(part=pa.array(seen.keys(), pa.string()), seen=pa.array(seen.values(), pa.int64()))
                seen = Counter()
        yield _frame(part=pa.array(seen.keys(), pa.string()), seen=pa.array(seen.values(), pa.int64()))

    found = docs.select(F.col(text).alias("text")).mapInArrow(scan, "part string, seen long")
    return found.groupBy("part").agg(F.sum("seen").alias("seen"))


def name_of(part: str) -> str:
    """A pre-token, or the name of a long one. No pre-token has letters and digits in one, as these names do."""
    if len(part) * 4 <= HEAD_BYTES or len(raw := part.encode("utf-8", "replace")) <= HEAD_BYTES:
        return part
    return f"sha256:{hashlib.sha256(raw).hexdigest()}"


def _frame(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def piece_table(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``part, seen, pieces``: the tokenizer's pieces per name of a distinct pre-token."""
    def count(batches):
        tokenizer = tokenizer_at(path)
        special = special_strings(tokenizer)
        for batch in batches:
            parts = batch.column(0).to_pylist()
            pieces = [count_pieces(p, tokenizer, special) for p in parts]
            yield _frame(part=pa.array(map(name_of, parts), pa.string()), seen=batch.column(1), pieces=pa.array(pieces, pa.int64()))

    return pre_tokens(docs, path, text).mapInArrow(count, "part string, seen long, pieces long")


def most_seen(pieces: DataFrame, head: int) -> dict[str, int]:
    """At most ``head`` pre-tokens: all those seen at least 2^b times, for the least b that fits."""
    short = pieces.filter(F.col("seen") > 1)
    power = F.floor(F.log2(F.col("seen"))).cast("int").alias("b")
    least, total = None, 0
    for b, n in sorted(short.groupBy(power).count().collect(), reverse=True):
        total += n
        if total > head:
            break
        least = b
    if least is None:
        return {}
    rows = short.filter(F.floor(F.log2(F.col("seen"))).cast("int") >= least).select("part", "pieces")
    return {r[0]: r[1] for r in rows.collect()}


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """``key, n_bytes, n_tokens`` for each row of ``docs``."""
    pieces = written(piece_table(docs, path, text), "pieces")
    known = docs.sparkSession.sparkContext.broadcast(most_seen(pieces, head))

    def frequencies(batches):
        tokenizer, get = tokenizer_at(path), known.value.get
        for batch in batches:
            keys, rows, sizes, sums, owner, part, times = [], [], [], [], [], [], []
            for row, doc, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                body, total = body or "", 0
                for p, n in Counter(_parts(body, tokenizer)).items():
                    p = name_of(p)
                    each = get(p)
                    if each is None:
                        owner.append(row)
                        part.append(p)
                        times.append(n)
                    else:
                        total += each * n
                rows.append(row)
                keys.append(doc)
                sizes.append(len(body.encode("utf-8", "replace")))
                sums.append(total)
            none = [None] * len(owner)
            for a, b, c, d, e, f in ((rows, keys, sizes, sums, [None] * len(rows), [None] * len(rows)),
                                     (owner, none, none, none, part, times)):
                yield _frame(row_id=pa.array(a, pa.int64()), doc=pa.array(b, pa.int64()),
                             n_bytes=pa.array(c, pa.int64()), known=pa.array(d, pa.int64()),
                             part=pa.array(e, pa.string()), times=pa.array(f, pa.int64()))

    plain = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(key).cast("long").alias("doc"),
                        F.col(text).alias("text"))
    counted = written(plain.mapInArrow(
        frequencies, "row_id long, doc long, n_bytes long, known long, part string, times long"), "frequencies")
    rare = (counted.filter("part IS NOT NULL").select("row_id", "part", "times")
            .join(pieces.select("part", "pieces"), "part")
            .groupBy("row_id").agg(F.sum(F.col("times") * F.col("pieces")).alias("rare")))
    return (counted.filter("part IS NULL").select("row_id", "doc", "n_bytes", "known").join(rare, "row_id", "left")
            .select(F.col("doc").alias(key), "n_bytes",
                    (F.col("known") + F.coalesce("rare", F.lit(0))).alias("n_tokens")))
