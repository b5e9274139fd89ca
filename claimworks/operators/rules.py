"""Row rules: which rule a row breaks, and the split into valid and quarantined rows."""

from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimworks.constants import MIN_VALIDITY_PCT, NPI_WIDTH, STATUSES
from claimworks.functions import rate_pct
from claimworks.operators.cleaning import NPI_LENGTH

NULL_SAFE = "null_safe"
THREE_VALUED = "three_valued"


def claim_rules(as_of: str | date | Column | None = None, policy: str = NULL_SAFE) -> dict[str, Column]:
    """Condition under which each rule is broken, in flag order.

    Null-safe rules also catch a missing status and look at the identifier before padding.
    Three-valued rules are the bare comparisons, NULL when a compared value is NULL, and look at
    the padded identifier, whose length is always right.
    """
    today = F.current_date() if as_of is None else (
        as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date"))
    billed, paid, status = F.col("billed_amount"), F.col("paid_amount"), F.col("claim_status")
    unknown = ~status.isin(*STATUSES)
    if policy == NULL_SAFE:
        unknown = status.isNull() | unknown
        bad_npi = ~F.col(NPI_LENGTH).between(1, NPI_WIDTH)
    elif policy == THREE_VALUED:
        bad_npi = F.length("provider_npi") != NPI_WIDTH
    else:
        raise ValueError(f"policy: {policy!r}")
    return {
        "NULL_CLAIM_ID": F.col("claim_id").isNull(),
        "NULL_MEMBER_ID": F.col("member_id").isNull(),
        "INVALID_STATUS": unknown,
        "NEGATIVE_AMOUNT": (billed < 0) | (paid < 0),
        "FUTURE_DATE": F.col("service_date") > today,
        "NULL_SERVICE_DATE": F.col("service_date").isNull(),
        "PAID_EXCEEDS_BILLED": paid > billed,
        "INVALID_NPI_LENGTH": bad_npi,
    }


def apply_rules(
    df: DataFrame, rules: dict[str, Column], policy: str = NULL_SAFE, keep_array: bool = False
) -> DataFrame:
    """Adds ``is_valid`` and ``dq_flags``, a JSON list of the broken rules in rule order.

    Null-safe: a NULL condition counts as not broken, so every row is valid or quarantined.
    Three-valued: one NULL condition makes ``is_valid`` NULL and the row is neither.
    """
    conditions = list(rules.values())
    if policy == NULL_SAFE:
        conditions = [F.coalesce(c, F.lit(False)) for c in conditions]
    broken = conditions[0]
    for condition in conditions[1:]:
        broken = broken | condition
    if policy == THREE_VALUED:
        # A true flag next to a NULL one still sums to NULL, unlike OR.
        known = F.lit(True)
        for condition in conditions:
            known = known & condition.isNotNull()
        broken = F.when(known, broken)
    # concat_ws drops NULLs inside generated code; array_compact is a lambda and would send the
    # whole row through interpreted evaluation.
    names = F.concat_ws(",", *[
        F.when(c, F.lit(json.dumps(name))) for name, c in zip(rules, conditions, strict=True)])
    df = df.withColumns({
        "is_valid": ~broken, "dq_flags": F.concat(F.lit("["), names, F.lit("]"))})
    if keep_array:
        df = df.withColumn("dq_flag_names", F.from_json("dq_flags", "array<string>"))
    return df


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter("is_valid")


def quarantine_rows(df: DataFrame, run_ts: datetime | Column | None = None) -> DataFrame:
    """Rows that broke a rule, with time and reason."""
    when = run_ts if isinstance(run_ts, Column) else (
        F.current_timestamp() if run_ts is None else F.lit(run_ts))
    return df.filter(~F.col("is_valid")).withColumns(
        {"quarantine_ts": when, "quarantine_reason": F.col("dq_flags")})


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Broken rows per rule in one pass: one row per rule, from one global aggregate."""
    counted = df.agg(*[F.count_if(c).alias(name) for name, c in rules.items()])
    return counted.unpivot([], list(rules), "rule", "broken_rows")


def validity(df: DataFrame) -> DataFrame:
    """One row: total, valid and invalid rows, percent valid (0 when empty) and status."""
    total, valid = F.col("total"), F.col("valid")
    pct = F.coalesce(rate_pct(valid, total), F.lit(0.0))
    return (
        df.agg(F.count("*").alias("total"), F.count_if(F.col("is_valid")).alias("valid"))
        .withColumns({"invalid": total - valid, "validity_pct": pct})
        .withColumn("status", F.when(F.col("validity_pct") < MIN_VALIDITY_PCT, "DQ_WARNING")
                    .otherwise("SUCCESS"))
    )
