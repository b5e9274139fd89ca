"""Sharding by extendible hashing.

A row's address is a string of hash bits: 60 from its key, then, for rows whose keys are equal, 60
from a number of the row. All rows start in one shard of depth 0; only a shard over the byte limit
is split, on the next bit, until every shard fits. The depth of a prefix follows from the sizes of
all its extensions, so one pass adds up bytes per prefix of ``step`` bits and finds every split in
them at once; only the prefixes still too large go to the next pass, with the next ``step`` bits.
The directory is a table of prefixes (one per shard), never a list on the driver.

Bytes are added up before the shuffle, and rows of one key spread by their second word, so no hot
key lands in one task; prefixes too short for any shard, which hold many leaves each, are left out of
the join that finds a leaf's shard. ``keep`` carries columns of the rows along, so that rows of equal
keys can be told apart, and ``write_shards`` writes a folder per shard. A single row larger than the limit has a shard of its own; ``fits`` is
false there. Defined results: a null value has no bytes; null keys share one address and are split
by row; an empty table has no shards. Only the key, the sized and the kept columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import written

#: Bits per hash word; two words make an address.
BITS = 60


def _word(column) -> F.Column:
    return F.conv(F.substring(F.md5(column.cast("string").cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def addresses(rows: DataFrame, key: str, sized: list[str], keep: Sequence[str] = ()) -> DataFrame:
    """``row_id, key, n_bytes, w0, w1`` and, in a struct, what is kept: one row each."""
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)).cast("long") for c in sized), F.lit(0))
    return rows.select(F.monotonically_increasing_id().alias("row_id"), F.col(key).alias("key"),
                       size.cast("long").alias("n_bytes"),
                       _word(F.coalesce(F.col(key).cast("string"), F.lit("null"))).alias("w0"),
                       *([F.struct(*keep).alias("kept")] if keep else [])) \
        .withColumn("w1", _word(F.col("row_id")))


def prefix(depth) -> F.Column:
    """The first ``depth`` bits of the address as text."""
    bits = F.concat(*(F.lpad(F.conv(F.col(w), 10, 2), BITS, "0") for w in ("w0", "w1")))
    return F.substring(bits, F.lit(1), depth)


def directory(addressed: DataFrame, limit: int, step: int) -> tuple[DataFrame, int]:
    """``leaf, depth``: how deep the shard of each settled leaf is, and the deepest leaf. A leaf is
    a prefix of the pass's full length."""
    done, depth, rest = None, 0, addressed
    while True:
        low, depth = depth, min(depth + step, 2 * BITS)
        leaves = rest.groupBy(prefix(F.lit(depth)).alias("leaf")).agg(
            F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
        leaves = written(leaves, "leaves")
        every = F.sequence(F.lit(low if low == 0 else low + 1), F.lit(depth))
        levels = leaves.withColumn("depth", F.explode(every))
        sums = levels.groupBy("depth", F.substring("leaf", F.lit(1), F.col("depth")).alias("of")).agg(
            F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
        fits = written(sums.filter((F.col("bytes") <= limit) | (F.col("n") == 1)).select("depth", "of"), "fitting")
        shortest = fits.agg(F.min("depth")).first()[0]
        settled = levels.filter(F.col("depth") >= F.lit(depth if shortest is None else shortest)) \
            .select("leaf", "depth", F.substring("leaf", F.lit(1), F.col("depth")).alias("of")).join(fits, ["depth", "of"]).groupBy("leaf").agg(F.min("depth").alias("depth"))
        found = written(leaves.select("leaf").join(settled, "leaf", "left"), "directory")
        open_leaves = found.filter("depth IS NULL").select("leaf")
        here = found.filter("depth IS NOT NULL").withColumn("bits", F.lit(depth))
        done = here if done is None else done.unionByName(here)
        if depth == 2 * BITS or open_leaves.isEmpty():
            return done.unionByName(open_leaves.select("leaf", F.lit(depth).alias("depth"),
                                                       F.lit(depth).alias("bits"))), depth
        rest = rest.drop("kept").withColumn("leaf", prefix(F.lit(depth))).join(open_leaves, "leaf", "left_semi").drop("leaf")


def assign(rows: DataFrame, key: str, sized: list[str], limit: int, step: int = 20, keep: Sequence[str] = ()) -> DataFrame:
    """``key, n_bytes, shard, depth, shard_bytes, fits`` per row, and the columns to ``keep``; the shard
    is its prefix."""
    addressed = written(addresses(rows, key, sized, keep), "addresses")
    found, deepest = directory(addressed, limit, step)
    lengths = [*range(step, deepest, step), deepest]
    parts = []
    for bits in lengths:
        leaves = found.filter(F.col("bits") == bits).drop("bits")
        parts.append(addressed.withColumn("leaf", prefix(F.lit(bits))).join(leaves, "leaf"))
    placed = parts[0]
    for p in parts[1:]:
        placed = placed.unionByName(p)
    kept = ["kept"] if keep else []
    placed = placed.withColumn("shard", prefix(F.col("depth"))).select("key", "n_bytes", "shard", "depth", *kept)
    sizes = placed.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"))
    return (placed.join(sizes, "shard")
            .select(F.col("key").alias(key), "n_bytes", "shard", "depth", "shard_bytes",
                    (F.col("shard_bytes") <= limit).alias("fits"), *[F.col(f"kept.`{c}`").alias(c) for c in keep]))


def write_shards(assigned: DataFrame, path: str) -> None:
    """A folder per shard, ``shard=<prefix>``; a shard is small enough for one file, whatever else its
    task writes. Prefixes are text: read them back with a schema."""
    assigned.repartition("shard").write.partitionBy("shard").parquet(path)
