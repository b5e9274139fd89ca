"""From a bronze batch to validated claims."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimworks.operators.cleaning import NPI_LENGTH, add_derived, to_typed
from claimworks.operators.dedup import dedup_latest
from claimworks.operators.rules import NULL_SAFE, apply_rules, claim_rules
from claimworks.schemas import CORRUPT


def validated_claims(
    bronze: DataFrame,
    as_of: str | date | Column | None = None,
    policy: str = NULL_SAFE,
    null_keys: str = "keep",
    order_by: list[Column] | None = None,
    keep_array: bool = False,
) -> DataFrame:
    """Newest row of each claim, cleaned, with the outcome of the row rules.

    Text is parsed before duplicates are dropped: typed rows are narrower in the shuffle and the
    sort, and a later filter on ``is_valid`` stops above the window, where it compares typed
    columns, so nothing is parsed twice. Derived columns come after, for the rows that are left.
    """
    order = order_by or [F.col("ingestion_ts").desc_nulls_last()]
    typed = to_typed(bronze.drop("is_corrupt", CORRUPT, "batch_id"))
    newest = add_derived(dedup_latest(typed, ["claim_id"], order, null_keys))
    return apply_rules(newest, claim_rules(as_of, policy), policy, keep_array).drop(NPI_LENGTH)


def silver_rows(
    validated: DataFrame, batch_date: str | date | Column, run_ts: datetime | Column | None = None
) -> DataFrame:
    """Valid rows with update time and batch date."""
    when = run_ts if isinstance(run_ts, Column) else (
        F.current_timestamp() if run_ts is None else F.lit(run_ts))
    day = batch_date if isinstance(batch_date, Column) else F.lit(str(batch_date)).cast("date")
    return validated.filter("is_valid").withColumns(
        {"silver_updated_at": when, "silver_batch_date": day})
