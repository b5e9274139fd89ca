"""Keep the newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    null_keys: str = "keep",
) -> DataFrame:
    """One row per key: the first under ``order_by``.

    A hash of all remaining columns breaks ties, so the kept row never depends on row order. Rows
    with a NULL key are no duplicates of each other: ``"keep"`` numbers them, which makes each its
    own group and spreads them evenly; ``"collapse"`` treats NULL as one key. The input is read
    once.

    The filter on the rank lets Spark cut every map-side partition down to one row per key
    before the shuffle (WindowGroupLimit), so a key with a third of all rows sends one row per
    input partition and no task receives them all.
    """
    if null_keys not in ("keep", "collapse"):
        raise ValueError(f"null_keys: {null_keys!r}")
    rest = sorted(set(df.columns) - set(keys))
    any_null = F.lit(False)
    for key in keys if null_keys == "keep" else ():
        any_null = any_null | F.col(key).isNull()
    numbered = df.withColumns({
        "_tie": F.xxhash64(*rest) if rest else F.lit(0),
        "_apart": F.when(any_null, F.monotonically_increasing_id())})
    newest_first = Window.partitionBy(*keys, "_apart").orderBy(*order_by, F.desc("_tie"))
    return (numbered.withColumn("_rank", F.row_number().over(newest_first))
            .filter(F.col("_rank") == 1).drop("_rank", "_tie", "_apart"))
