"""Checks after a load: measures, verdict and audit row."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.constants import (
    AGE_EMPTY, AGE_UNREADABLE, MIN_COVERAGE_PCT, MIN_VALIDITY_PCT,
)
from claimworks.functions import rate_pct

_MEASURES = ("bronze_count", "bronze_distinct", "silver_count", "valid_count",
             "future_dates_count", "duplicate_claim_ids", "quarantined_count",
             "orphan_provider_records")


def _day(value: str | date | Column | None) -> Column:
    if value is None:
        return F.current_date()
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def bronze_measures(bronze: DataFrame, batch_date: str | date) -> DataFrame:
    """Sound rows of the batch, and how many claims they are; a row without an id is one."""
    sound = bronze.filter((F.col("ingestion_date") == _day(batch_date)) & ~F.col("is_corrupt"))
    return _long(sound.agg(
        F.count("*").alias("bronze_count"),
        (F.count_distinct("claim_id") + F.count_if(F.col("claim_id").isNull()))
        .alias("bronze_distinct"),
    ))


def silver_measures(
    silver: DataFrame, batch_date: str | date, as_of: str | date | Column | None = None
) -> DataFrame:
    """Rows, valid rows, future dates and duplicate ids of one batch, in a single pass."""
    loaded = silver.filter(F.col("silver_batch_date") == _day(batch_date))
    return _long(loaded.agg(
        F.count("*").alias("silver_count"),
        F.count_if(F.col("is_valid")).alias("valid_count"),
        F.count_if(F.col("service_date") > _day(as_of)).alias("future_dates_count"),
        (F.count("*") - F.count_distinct("claim_id")).alias("duplicate_claim_ids"),
    ))


def quarantine_measures(quarantine: DataFrame, batch_date: str | date) -> DataFrame:
    return _long(quarantine.filter(F.col("ingestion_date") == _day(batch_date))
                 .agg(F.count("*").alias("quarantined_count")))


def orphan_measures(silver: DataFrame, scorecard: DataFrame, batch_date: str | date) -> DataFrame:
    """Batch rows whose provider has no scorecard row.

    Both sides are brought to one row per provider first, so the anti join never sees a hot
    provider and its right side is as small as it gets. A row without a provider is an orphan.
    """
    per_provider = (silver.filter(F.col("silver_batch_date") == _day(batch_date))
                    .groupBy("provider_npi").agg(F.count("*").alias("_rows")))
    known = scorecard.select("provider_npi").distinct()
    orphans = per_provider.join(known, "provider_npi", "left_anti")
    return _long(orphans.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_provider_records")))


def _long(one_row: DataFrame) -> DataFrame:
    return one_row.unpivot([], one_row.columns, "measure", "n")


def verdict(measures: DataFrame, coverage: str = "rows") -> DataFrame:
    """One row with every figure, the broken service levels as a JSON list, and PASS or FAIL.

    Validity is that of the loaded rows together with the quarantined ones, if they were
    measured. ``coverage="distinct"`` judges coverage against distinct claims, so that dropped
    duplicates are no loss. An empty batch has 0 percent of both and fails.
    """
    if coverage not in ("rows", "distinct"):
        raise ValueError(f"coverage: {coverage!r}")
    wide = measures.agg(*[
        F.coalesce(F.max(F.when(F.col("measure") == m, F.col("n"))), F.lit(0)).alias(m)
        for m in _MEASURES])

    def covered(base: str) -> Column:
        return rate_pct(F.col("silver_count"), F.greatest(F.col(base), F.lit(1)))

    seen = F.col("silver_count") + F.col("quarantined_count")
    wide = wide.withColumns({
        "silver_coverage_pct": covered("bronze_count"),
        "distinct_coverage_pct": covered("bronze_distinct"),
        "validity_pct": F.coalesce(rate_pct(F.col("valid_count"), seen), F.lit(0.0)),
    })
    wide = wide.withColumn(
        "judged_coverage_pct", F.col("silver_coverage_pct" if coverage == "rows" else "distinct_coverage_pct"))
    judged = F.col("judged_coverage_pct")
    limits = [
        (F.col("validity_pct") < MIN_VALIDITY_PCT, "VALIDITY_BELOW_95: ", F.col("validity_pct"), "%"),
        (F.col("future_dates_count") > 0, "FUTURE_DATES: ", F.col("future_dates_count"), ""),
        (F.col("duplicate_claim_ids") > 0, "DUPLICATES: ", F.col("duplicate_claim_ids"), ""),
        (judged < MIN_COVERAGE_PCT, "LOW_COVERAGE: ", judged, "%"),
    ]
    broken = F.array_compact(F.array(*[
        F.when(test, F.concat(F.lit(label), value.cast("string"), F.lit(unit)))
        for test, label, value, unit in limits]))
    return wide.withColumns({
        "sla_violations": F.to_json(broken),
        "overall_status": F.when(F.size(broken) == 0, "PASS").otherwise("FAIL"),
    })


def check_rows(judged: DataFrame, ages: DataFrame | None = None) -> DataFrame:
    """The verdict as one row per check: name, value and whether it passed. Orphans, and freshness by
    the ``ages`` of tables, are reported but are no part of the verdict; a table passes if it can be
    read and is not empty."""
    def row(name: str, value: Column, passed: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), value.cast("double").alias("value"),
                        passed.alias("passed"))
    c = F.col
    rows = F.array(
        row("coverage", c("judged_coverage_pct"), c("judged_coverage_pct") >= MIN_COVERAGE_PCT),
        row("validity", c("validity_pct"), c("validity_pct") >= MIN_VALIDITY_PCT),
        row("future_dates", c("future_dates_count"), c("future_dates_count") == 0),
        row("duplicates", c("duplicate_claim_ids"), c("duplicate_claim_ids") == 0),
        row("orphan_providers", c("orphan_provider_records"), c("orphan_provider_records") == 0),
    )
    checked = judged.select(F.inline(rows))
    if ages is None:
        return checked
    age = F.col("age_minutes")
    return checked.unionByName(ages.select(
        F.concat(F.lit("freshness_"), "table_name").alias("check"), age.alias("value"),
        ((age > AGE_UNREADABLE) & (age < AGE_EMPTY)).alias("passed")))


def freshness(
    spark: SparkSession, tables: dict[str, DataFrame | None], run_ts: datetime | Column | None = None
) -> DataFrame:
    """Minutes since the last update of each table; fixed values for empty and missing ones."""
    now = run_ts if isinstance(run_ts, Column) else (
        F.current_timestamp() if run_ts is None else F.lit(run_ts))
    result = None
    for name, df in tables.items():
        if df is None:
            continue
        micros = F.unix_micros(now) - F.unix_micros(F.max("gold_updated_at"))
        row = df.agg(F.coalesce(F.round(micros / F.lit(60_000_000.0), 1), F.lit(AGE_EMPTY))
                     .alias("age_minutes")).select(F.lit(name).alias("table_name"), "age_minutes")
        result = row if result is None else result.unionByName(row)
    missing = [(name, AGE_UNREADABLE) for name, df in tables.items() if df is None]
    if missing:
        row = spark.createDataFrame(missing, "table_name string, age_minutes double")
        result = row if result is None else result.unionByName(row)
    return result


def open_tables(spark: SparkSession, names: list[str]) -> dict[str, DataFrame | None]:
    """Update times of tables by name; None for a table that cannot be read."""
    opened: dict[str, DataFrame | None] = {}
    for name in names:
        try:
            opened[name] = spark.table(name).select("gold_updated_at")
        except AnalysisException:
            opened[name] = None
    return opened


def audit_row(
    judged: DataFrame, batch_date: str | date, run_ts: datetime | Column | None = None
) -> DataFrame:
    """The row kept for each run; its coverage is the one that was judged."""
    now = run_ts if isinstance(run_ts, Column) else (
        F.current_timestamp() if run_ts is None else F.lit(run_ts))
    return judged.select(
        F.lit(str(batch_date)).alias("batch_date"), "overall_status", "validity_pct",
        F.col("judged_coverage_pct").alias("silver_coverage_pct"), "future_dates_count",
        F.col("duplicate_claim_ids").alias("duplicate_count"), "sla_violations",
        now.alias("logged_at"),
    )
