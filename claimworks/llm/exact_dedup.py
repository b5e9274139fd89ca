"""Exact deduplication against a stored history by minimal perfect hashing.

The distinct digests of earlier rows (the history) are dealt into buckets of bounded size, and each
bucket becomes one index row: a minimal perfect hash, and per slot the full digest, the locator of
the row that wins so far and the number of rows seen. A new digest is hashed to its one slot and
compared with all 32 bytes there: equal means a repeat of the history, anything else is a
nonmember. Nonmembers are grouped among themselves. Rows are combined by digest before each
shuffle, so a text that a third of all rows share sends one row per task.

Defined results: a null text counts as empty; a null key sorts below every key; of rows that share
text and key exactly one is kept; an empty table gives an empty result. Only the key and the text
are read, so extra columns do no harm.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import mix64, written

#: Digests per bucket, on average.
BUCKET_KEYS = 2048
_LEVELS = 48
_RESULT = "digest binary, keyed int, key long, row_id long, n long, origin string"
_INDEX = ("bucket long, sizes array<int>, bits binary, digests binary, keyed binary, keys binary, "
          "rows binary, counts binary")


def digest_of(text) -> F.Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One narrow row per document: its key, the digest of its text and a number for the row."""
    return docs.select(
        F.col(key).cast("long").alias("key"), digest_of(F.col(text)).alias("digest"),
        F.monotonically_increasing_id().alias("row_id"))


def combined(rows: DataFrame) -> DataFrame:
    """Distinct digests with their number of rows and the row with the largest key."""
    won = F.max(F.struct(F.col("key").isNotNull().cast("int").alias("keyed"),
                         F.coalesce("key", F.lit(0)).alias("key"), "row_id")).alias("won")
    return rows.groupBy("digest").agg(won, F.count(F.lit(1)).alias("n")).select("digest", "won.*", "n")


def _words(digest: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(digest[:, 8:16]).view("<u8").ravel()


def _minimal_hash(words: np.ndarray) -> tuple[list[int], bytes, np.ndarray]:
    """Level sizes, their bits, and the key for each slot. On each level a key that has a bit to
    itself is placed; the others go on to the next level. Keys left at the end take the last slots."""
    left, sizes, bits, order = np.arange(len(words)), [], [], []
    for level in range(_LEVELS):
        if not len(left):
            break
        size = 2 * len(left) + 8
        at = (mix64(words[left], level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        placed = alone[at]
        order.append(left[placed][np.argsort(at[placed])])
        sizes.append(size)
        bits.append(np.packbits(alone).tobytes())
        left = left[~placed]
    return sizes, b"".join(bits), np.concatenate([*order, left]) if len(words) else left


def _slots(sizes: list[int], bits: bytes, words: np.ndarray) -> np.ndarray:
    """The slot of each word, or -1 when no level holds it."""
    slot, left, start, before = np.full(len(words), -1), np.arange(len(words)), 0, 0
    for level, size in enumerate(sizes):
        raw = np.frombuffer(bits, np.uint8, (size + 7) // 8, start)
        start += len(raw)
        alone = np.unpackbits(raw)[:size].astype(bool)
        rank = np.cumsum(alone) - 1 + before
        before += int(alone.sum())
        at = (mix64(words[left], level) % np.uint64(size)).astype(np.int64)
        hit = alone[at]
        slot[left[hit]] = rank[at[hit]]
        left = left[~hit]
    return slot


def _columns(frame: pd.DataFrame) -> tuple[np.ndarray, ...]:
    digest = np.frombuffer(b"".join(frame["digest"]), np.uint8).reshape(-1, 32)
    return (digest, *(frame[c].to_numpy(np.int64) for c in ("keyed", "key", "row_id", "n")))


def _build(frame: pd.DataFrame) -> pd.DataFrame:
    digest, *rest = _columns(frame)
    sizes, bits, order = _minimal_hash(_words(digest))
    return pd.DataFrame([[frame["bucket"].iloc[0], sizes, bits, digest[order].tobytes(),
                          *(x[order].tobytes() for x in rest)]],
                        columns=[c.split()[0] for c in _INDEX.split(", ")])


def _look_up(index: pd.DataFrame, fresh: pd.DataFrame) -> pd.DataFrame:
    """All slots, brought up to date, and the nonmembers."""
    digest, keyed, key, row, n = _columns(fresh)
    held = None
    member = np.zeros(len(digest), bool)
    if len(index):
        one = index.iloc[0]
        held = np.frombuffer(one["digests"], np.uint8).reshape(-1, 32)
        hkeyed, hkey, hrow, hn = (np.frombuffer(one[c], np.int64).copy()
                                  for c in ("keyed", "keys", "rows", "counts"))
        slot = _slots(list(one["sizes"]), one["bits"], _words(digest))
        if (slot < 0).any():  # keys past the last level, of which there are hardly any
            last = {held[i].tobytes(): i for i in range(len(held))} if len(held) else {}
            for i in np.flatnonzero(slot < 0):
                slot[i] = last.get(digest[i].tobytes(), -1)
        member = (slot >= 0) & (held[slot] == digest).all(axis=1)
        s, m = slot[member], member
        hn[s] += n[m]
        newer = ((keyed[m] > hkeyed[s]) | ((keyed[m] == hkeyed[s]) & (
            (key[m] > hkey[s]) | ((key[m] == hkey[s]) & (row[m] > hrow[s])))))
        for mine, theirs in ((hkeyed, keyed), (hkey, key), (hrow, row)):
            mine[s[newer]] = theirs[m][newer]
    parts = []
    if held is not None:
        origin = np.full(len(held), "history", object)
        origin[slot[member]] = "repeat"
        parts.append((held, hkeyed, hkey, hrow, hn, origin))
    out = ~member
    parts.append((digest[out], keyed[out], key[out], row[out], n[out], np.full(out.sum(), "fresh", object)))
    return pd.concat([pd.DataFrame({
        "digest": [d.tobytes() for d in p[0]], "keyed": p[1].astype(np.int32), "key": p[2],
        "row_id": p[3], "n": p[4], "origin": p[5]}) for p in parts], ignore_index=True)


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    first = F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long")
    return rows.withColumn("bucket", first % F.lit(buckets))


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """The index over combined rows of the history, one row per bucket."""
    return _bucketed(history, buckets).groupBy("bucket").applyInPandas(_build, _INDEX)


def resolve(index: DataFrame, fresh: DataFrame, buckets: int) -> DataFrame:
    """One row per distinct digest of history and new rows. ``origin``: history, repeat, fresh."""
    return (index.groupBy("bucket").cogroup(_bucketed(fresh, buckets).groupBy("bucket"))
            .applyInPandas(lambda a, b: _look_up(a, b), _RESULT))


def winners(rows: DataFrame, is_history) -> DataFrame:
    """Winner and size of each group of equal texts. ``is_history`` marks the earlier rows."""
    groups = written(combined(rows.withColumn("old", is_history).filter("old")).withColumn("old", F.lit(True))
                     .unionByName(combined(rows.withColumn("old", is_history).filter("NOT old"))
                                  .withColumn("old", F.lit(False))), "digests")
    buckets = max(1, groups.count() // BUCKET_KEYS)
    index = written(build_index(groups.filter("old").drop("old"), buckets), "mph")
    return resolve(index, groups.filter("NOT old").drop("old"), buckets)


def earlier_half(rows: DataFrame):
    """The rows that came first: keys up to the middle of the key range, and null keys."""
    low, high = rows.agg(F.min("key"), F.max("key")).first()
    middle = None if low is None else low + (high - low) // 2
    return F.coalesce(F.col("key") <= F.lit(middle), F.lit(True))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", is_history=None) -> DataFrame:
    """``key, keep_id, group_size, kept, text_sha256, origin`` for each row of ``docs``."""
    rows = written(digests(docs, key, text), "rows")
    found = winners(rows, earlier_half(rows) if is_history is None else is_history)
    found = found.select("digest", F.when(F.col("keyed") == 1, F.col("key")).alias("keep_id"),
                         F.col("row_id").alias("kept_row"), F.col("n").alias("group_size"), "origin")
    return rows.join(found, "digest").select(
        F.col("key").alias(key), "keep_id", "group_size",
        (F.col("row_id") == F.col("kept_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "origin")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows meet their winner on digest and key, so the copies of a text are spread by their keys.
    """
    rows = written(digests(docs, key, text), "rows")
    found = winners(rows, earlier_half(rows)).select(
        F.col("digest").alias("__digest"), F.when(F.col("keyed") == 1, F.col("key")).alias("__key"))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))  # in a struct, no name of the input can clash
    mine = docs.select(row.alias("__row"), digest_of(F.col(text)).alias("__d"), F.col(key).cast("long").alias("__k"))
    met = mine.join(found, F.col("__d").eqNullSafe(F.col("__digest")) & F.col("__k").eqNullSafe(F.col("__key")))
    # Of rows with equal text and key the one whose other columns hash least stays, in every run.
    first = met.groupBy("__digest", "__key").agg(F.min_by("__row", F.xxhash64("__row")).alias("__row"))
    return first.select("__row.*")
