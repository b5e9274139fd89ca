"""Benchmark passages in documents, found by winnowing.

Texts become words. Of the hashes of all k-word grams, the smallest in each run of ``window - k + 1``
consecutive ones is a fingerprint (the first of equal ones). Two texts that share ``window`` words
thus share a fingerprint at the same place in them. Document and item fingerprints are joined, and
each hit is extended over the words around it: a run of at least ``window`` equal words is an
occurrence, so hashes decide nothing by themselves. An item with fewer words is one window of its
own length, for which documents are fingerprinted once more.

A document's fingerprint is handed on with the ``2 * window - k`` words it may extend over, and only
if a bit is set for it in a bitmap of the item fingerprints. The bitmap has a fixed size: a larger
benchmark lets more through to the join, which is exact. Items with the same words around a
fingerprint are compared once, and documents in which the same contexts occur share their list of
items, so a passage in a third of all texts is handled per context and not per pair.

Defined results: a null or empty text has no words and no hit; an item without words occurs
nowhere; repeated and null document keys are separate rows; null item ids are left out of the list
of ids, equal item ids count once; an empty table gives an empty result, an empty benchmark no hits.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimworks.llm.common import mix64, written

#: Words of a gram, and bits of the bitmap (2^26 bits are 8 MiB, at every size of the benchmark).
GRAM = 5
BITMAP_BITS = 26
_CACHE_WORDS = 400_000
_BLOCK = 1 << 19
_CUT = 1 << 22
_ODD = [np.uint64(pow(0x9E3779B97F4A7C15, i, 1 << 64)) for i in range(GRAM)]
_FINGERPRINT = "length int, print long, at long, from_word long, words string"
_DOC = "row_id long, doc_id long, n_words long, length int, print long, at long, from_word long, words string"
_RUN = "row_id long, context long, low long, high long"
#: Separators become blanks and A-Z become a-z; bytes of other code points stay as they are.
_FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


class _Hashes(dict):
    """Word -> 64-bit hash. Half of the entries, the older ones, go when it is full."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= _CACHE_WORDS:
            for old in list(itertools.islice(self, _CACHE_WORDS // 2)):
                del self[old]
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


_hashes = _Hashes()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


def fingerprints(words: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the fingerprints for shared runs of ``length`` words."""
    k = min(GRAM, length)
    if len(words) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    own = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    at, prints = [], []
    for start in range(0, len(own) - length + 1, _BLOCK):
        part = own[start:start + _BLOCK + length - 1]
        grams = np.zeros(len(part) - k + 1, np.uint64)
        for i in range(k):
            grams += part[i:i + len(grams)] * _ODD[i]
        grams = mix64(grams, length)
        n = len(part) - length + 1
        best, offset = grams[:n].copy(), np.zeros(n, np.int64)
        for i in range(1, length - k + 1):
            lower = grams[i:i + n] < best
            best[lower] = grams[i:i + n][lower]
            offset[lower] = i
        place = np.arange(n) + offset
        new = np.concatenate(([True], place[1:] != place[:-1]))
        at.append(place[new] + start)
        prints.append(best[new])
    return np.concatenate(at), np.concatenate(prints)


def _around(words: list[bytes], at: int, length: int) -> tuple[int, str]:
    """The words an occurrence through the gram at ``at`` may reach, and the first one's place."""
    spare = length - min(GRAM, length)
    low = max(0, at - spare)
    return low, b" ".join(words[low:at + length]).decode()


def _bit(prints: np.ndarray) -> np.ndarray:
    return (prints >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _pieces(text: str, overlap: int) -> Iterator[tuple[int, list[bytes]]]:
    """Words of a whole text; those of a very long one in parts that overlap."""
    raw = (text or "").encode("utf-8", "replace").translate(_FOLD)
    start, before, kept = 0, 0, []
    while True:
        end = raw.find(b" ", start + _CUT) if len(raw) - start > _CUT else -1
        now = raw[start:None if end < 0 else end].split()
        yield before - len(kept), kept + now
        if end < 0:
            return
        before += len(now)
        kept = (kept + now)[-overlap:]
        start = end


def item_contexts(items: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """One row per item and fingerprint: ``item``, its place and the words around it."""
    def run(batches):
        for batch in batches:
            rows = []
            for item, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(body.as_py())
                length = min(window, len(words))
                if length:
                    places, prints = fingerprints(words, length)
                    for at, print_ in zip(places.tolist(), prints.view(np.int64).tolist()):
                        low, around = _around(words, at, length)
                        rows.append((item, length, print_, at - low, low, around))
            yield _batch(rows, "item string, " + _FINGERPRINT)

    return items.select(F.col(key).cast("string"), F.col(text)).mapInArrow(run, "item string, " + _FINGERPRINT)


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    fields = [f.split() for f in ddl.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)],
                                      names=[n for n, _ in fields])


def _bitmap(contexts: DataFrame) -> bytes:
    """The set bits of all item fingerprints, put together per task and then in the driver: its size
    is fixed, whatever the benchmark's."""
    def run(batches):
        bits = np.zeros(1 << BITMAP_BITS - 3, np.uint8)
        for batch in batches:
            at = _bit(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        part = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(bits[part], pa.int32())], names=["byte", "bits"])

    found = contexts.select("print").mapInArrow(run, "byte long, bits int").groupBy("byte").agg(F.bit_or("bits").alias("bits"))
    bits = np.zeros(1 << BITMAP_BITS - 3, np.uint8)
    for batch in found.toArrow().to_batches():
        bits[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return bits.tobytes()


def document_prints(docs: DataFrame, key: str, text: str, lengths: list[int], bitmap) -> DataFrame:
    """A row per document with its number of words, and one per fingerprint that may be an item's."""
    def run(batches):
        bits = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            rows = []
            for row, doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                n = 0
                for before, words in _pieces(body.as_py(), 2 * max(lengths, default=1)):
                    n = before + len(words)
                    for length in lengths:
                        places, prints = fingerprints(words, length)
                        bit = _bit(prints)
                        on = np.flatnonzero(bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
                        for at, print_ in zip(places[on].tolist(), prints[on].view(np.int64).tolist()):
                            low, around = _around(words, at, length)
                            rows.append((row, doc, None, length, print_, at - low, before + low, around))
                rows.append((row, doc, n, None, None, None, None, None))
                if len(rows) >= 4096:
                    yield _batch(rows, _DOC)
                    rows = []
            yield _batch(rows, _DOC)

    numbered = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(key).cast("long").alias("doc_id"), F.col(text))
    return numbered.mapInArrow(run, _DOC)


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal words around a shared fingerprint that are as long as a window."""
    for batch in batches:
        rows = []
        for row, context, length, at, from_word, mine, there, theirs in zip(*(c.to_pylist() for c in batch.columns)):
            a, b = mine.split(" "), theirs.split(" ")
            k = min(GRAM, length)
            if a[at:at + k] != b[there:there + k]:
                continue
            low = 0
            while low < min(at, there) and a[at - low - 1] == b[there - low - 1]:
                low += 1
            high = k
            while high < min(len(a) - at, len(b) - there) and a[at + high] == b[there + high]:
                high += 1
            if low + high >= length:
                rows.append((row, context, from_word + at - low, from_word + at + high))
        yield _batch(rows, _RUN)


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                  item_text: str = "text", window: int = 10) -> DataFrame:
    """Per document: words, words inside an occurrence of an item's window, and the items found."""
    found = written(item_contexts(items, item_key, item_text, window), "items")
    same = ["length", "print", "at", "words"]
    contexts = written(found.select(*same).distinct().withColumn("context", F.monotonically_increasing_id()), "contexts")
    holders = written(found.filter("item IS NOT NULL").join(contexts, same).select("context", "item").distinct(), "holders")
    lengths = sorted(r[0] for r in contexts.select("length").distinct().collect())
    shipped = docs.sparkSession.sparkContext.broadcast(_bitmap(contexts))
    prints = written(document_prints(docs, key, text, lengths, shipped), "prints")
    theirs = contexts.select("length", "print", "context", F.col("at").alias("there"), F.col("words").alias("theirs"))
    runs = prints.filter("print IS NOT NULL").join(theirs, ["length", "print"]).select(
        "row_id", "context", "length", "at", "from_word", "words", "there", "theirs")
    runs = written(runs.mapInArrow(_extended, _RUN), "runs")
    return (prints.filter("print IS NULL").select("row_id", "doc_id", "n_words")
            .join(_hit_words(runs), "row_id", "left").join(_items_found(runs, holders), "row_id", "left")
            .select(F.col("doc_id").alias(key), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def _hit_words(runs: DataFrame) -> DataFrame:
    """Words of each document that some run covers."""
    per = runs.groupBy("row_id", "low").agg(F.max("high").alias("high"))
    before = F.max("high").over(Window.partitionBy("row_id").orderBy("low").rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("high") - F.greatest("low", F.coalesce("before", "low")))
    return per.withColumn("before", before).groupBy("row_id").agg(F.sum(new).alias("n_hit"))


def _items_found(runs: DataFrame, holders: DataFrame) -> DataFrame:
    """Items of each document, worked out once for documents in which the same contexts occur."""
    sets = written(runs.select("row_id", "context").distinct().groupBy("row_id")
                   .agg(F.sort_array(F.collect_list("context")).alias("contexts"))
                   .withColumn("set", F.sha2(F.array_join("contexts", ","), 256)), "sets")
    held = sets.groupBy("set").agg(F.any_value("contexts").alias("contexts"))
    held = held.select("set", F.explode("contexts").alias("context")).join(holders, "context").select("set", "item").distinct()
    lists = held.groupBy("set").agg(F.sort_array(F.collect_list("item")).alias("items")).select(
        "set", F.size("items").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    return sets.select("row_id", "set").join(lists, "set").drop("set")
