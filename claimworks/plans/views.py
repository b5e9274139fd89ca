"""Reporting views over the aggregate tables, and exact versions of measures that cannot be
rolled up from them."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimworks.constants import KPI_SNAPSHOT, RISK_VIEW_MIN_CLAIMS, TOP_DIAGNOSES
from claimworks.functions import amount_mean, amount_sum, share_pct
from claimworks.operators import tables


def _total(column: str) -> Column:
    """Sum of an amount column, the same in every run."""
    return amount_sum(column)


def exec_dashboard(kpi: DataFrame) -> DataFrame:
    """Totals per report date, payer and line of business.

    ``unique_members`` adds up the distinct counts of the groups and ``avg_paid_per_claim`` is
    the mean of their means; ``exec_exact`` gives the exact figures.
    """
    return kpi.groupBy("report_date", "payer_id", "line_of_business").agg(
        F.sum("claim_count").alias("total_claims"),
        F.sum("unique_members").alias("unique_members"),
        _total("total_billed").alias("total_billed"),
        _total("total_paid").alias("total_paid"),
        share_pct(_total("total_paid"), _total("total_billed")).alias("overall_payment_rate_pct"),
        F.sum("denied_count").alias("total_denied"),
        share_pct(F.sum("denied_count"), F.sum("claim_count")).alias("overall_denial_rate_pct"),
        amount_mean("avg_paid_per_claim").alias("avg_paid_per_claim"),
    )


def exec_sketched(sketches: DataFrame) -> DataFrame:
    """Distinct members, distinct providers and median paid of the dashboard groups, united from the
    sketches of ``gold.kpi_sketches``; any coarser grouping unites alike, without a pass over the claims."""
    def united(column: str) -> Column:
        return F.hll_sketch_estimate(F.hll_union_agg(column))

    return sketches.groupBy("report_date", "payer_id", "line_of_business").agg(
        F.sum("claim_count").alias("total_claims"),
        united("members_sketch").alias("unique_members_approx"),
        united("providers_sketch").alias("unique_providers_approx"),
        F.kll_merge_agg_double("paid_sketch").alias("_paid"),
    ).withColumn("median_paid_approx", F.when(
        F.kll_sketch_get_n_double("_paid") > 0, F.kll_sketch_get_quantile_double("_paid", F.lit(0.5)))).drop("_paid")


def exec_exact(claims: DataFrame, report_date: Column | str = "silver_updated_at") -> DataFrame:
    """Distinct members and mean paid per claim of the dashboard groups, from the claims."""
    day = F.to_date(F.col(report_date) if isinstance(report_date, str) else report_date)
    return claims.groupBy(day.alias("report_date"), "payer_id", "line_of_business").agg(
        F.count("claim_id").alias("total_claims"),
        F.count_distinct("member_id").alias("unique_members_exact"),
        (_total("paid_amount") / F.nullif(F.count("paid_amount"), F.lit(0)))
        .alias("avg_paid_per_claim_exact"),
    )


def provider_tier_summary(scorecard: DataFrame) -> DataFrame:
    """Totals per provider and year. ``current_tier`` is the alphabetically last tier of the
    year, as the report has it; ``provider_latest_tier`` gives the tier of the last month."""
    return scorecard.groupBy("provider_npi", "service_year").agg(
        F.max("provider_tier").alias("current_tier"),
        F.sum("total_claims").alias("ytd_claims"),
        F.sum("patients_served").alias("ytd_patients"),
        _total("total_paid").alias("ytd_paid"),
        amount_mean("denial_rate_pct").alias("avg_denial_rate_pct"),
        amount_mean("cost_efficiency_score").alias("avg_cost_efficiency"),
        F.count_distinct("payer_id").alias("payer_count"),
    )


def provider_latest_tier(scorecard: DataFrame) -> DataFrame:
    """Tier of the latest month of a year; of several payers in it, the alphabetically last."""
    return scorecard.groupBy("provider_npi", "service_year").agg(
        F.max(F.struct("service_month", "provider_tier")).alias("_last"),
    ).select("provider_npi", "service_year",
             F.col("_last.service_month").alias("latest_month"),
             F.col("_last.provider_tier").alias("latest_tier"))


def high_risk_members(members: DataFrame) -> DataFrame:
    return members.filter(
        F.col("risk_tier").isin("HIGH", "MEDIUM")
        & (F.col("lifetime_claims") > RISK_VIEW_MIN_CLAIMS)
    ).select(
        "member_id", "payer_id", "line_of_business", "risk_tier", "lifetime_claims",
        "lifetime_paid", "lifetime_billed",
        share_pct(F.col("lifetime_paid"), F.col("lifetime_billed")).alias("lifetime_payment_rate"),
        "unique_providers_seen", "unique_diagnoses", "denied_claims",
        share_pct(F.col("denied_claims"), F.col("lifetime_claims")).alias("member_denial_rate"),
        "first_service_date", "last_service_date", "days_as_patient", "avg_cost_per_episode",
    )


def top_diagnoses(trending: DataFrame, n: int = TOP_DIAGNOSES) -> DataFrame:
    """The ``n`` largest diagnosis and payer pairs of each month; ties go by code, then payer.

    Filtering on the rank lets Spark keep ``n`` rows per month and input partition before the
    shuffle.
    """
    by_volume = Window.partitionBy("service_year", "service_month").orderBy(
        F.col("claim_count").desc(), "icd10_code", "payer_id")
    return trending.select(
        "icd10_code", "payer_id", "service_year", "service_month", "claim_count",
        "patients_affected", "total_paid", "cost_per_patient", "mom_claim_growth_pct",
        F.row_number().over(by_volume).alias("rank_by_volume"),
    ).filter(F.col("rank_by_volume") <= n)


#: View name, source table and function.
VIEWS = {
    "vw_exec_claims_dashboard": ("gold_daily_claims_kpi", exec_dashboard),
    "vw_provider_tier_summary": ("gold_provider_scorecard", provider_tier_summary),
    "vw_high_risk_members": ("gold_member_360", high_risk_members),
    "vw_diagnosis_mom_trend": ("gold_diagnosis_trending", top_diagnoses),
}


def register_views(spark: SparkSession, prefix: str = "") -> None:
    """Register the views over the tables of the session catalog."""
    for view, (table, build) in VIEWS.items():
        build(spark.table(prefix + table)).createOrReplaceTempView(view)


def kpi_snapshot_rows(
    kpi: DataFrame, snapshot_date: str | date | None = None, run_ts: datetime | None = None
) -> DataFrame:
    """One row per payer for one report date, or for each of all dates."""
    if snapshot_date is not None:
        kpi = kpi.filter(F.col("report_date") == F.lit(str(snapshot_date)).cast("date"))
    return (
        kpi.filter(F.col("report_date").isNotNull()).groupBy("report_date", "payer_id").agg(
            F.sum("claim_count").alias("total_claims"),
            _total("total_billed").alias("total_billed"),
            _total("total_paid").alias("total_paid"),
            amount_mean("denial_rate_pct").alias("avg_denial_rate"),
        ).select(
            F.col("report_date").alias("snapshot_date"), "payer_id", "total_claims", "total_billed", "total_paid",
            "avg_denial_rate",
            (F.current_timestamp() if run_ts is None else F.lit(run_ts)).alias("refreshed_at"),
        )
    )


def refresh_kpi_snapshot(
    kpi: DataFrame,
    snapshot_date: str | date | None,
    name: str = KPI_SNAPSHOT,
    location: str | None = None,
    run_ts: datetime | None = None,
) -> int:
    """Upsert the rows of one date, or of all if it is None, on (date, payer); returns the number of rows written."""
    rows = tables.staged(kpi_snapshot_rows(kpi, snapshot_date, run_ts))
    tables.upsert(rows, name, ["snapshot_date", "payer_id"], location=location, unique=True)
    return rows.count()
