"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import written


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest vertex around: the larger ones, or the smaller ones and oneself."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else pairs
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    met = both.join(least, "u")
    if large:
        return met.filter("v > u AND v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    own = least.filter("u != m").select("u", F.col("m").alias("v"))
    return met.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``vertex, component`` for every vertex with a link; the component is its smallest vertex."""
    pairs = written(links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    before = None
    while True:
        pairs = written(_star(_star(pairs, True), False), "stars")
        now = pairs.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("v").alias("vertex")).distinct()
    return (pairs.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
            .unionByName(roots.withColumn("component", F.col("vertex"))))
