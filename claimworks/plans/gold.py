"""The four aggregate tables built from valid claims.

Every builder is a hash aggregate on fixed-width buffers with map-side combine, so a payer or
member with a third of all claims reaches its final task as one partial row per upstream task.
Distinct counts and distinct lists go through Spark's distinct-aggregate rewrite, which shuffles
on group key plus value and so spreads a hot group over its values.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimworks.constants import (
    DENIED, HIGH_CLAIMS, HIGH_PAID, MEDIUM_CLAIMS, MEDIUM_PAID, PREFERRED_BELOW_PCT,
    STANDARD_BELOW_PCT,
)
from claimworks.functions import amount_sum, beyond_cents, cents_sum, mean_amount, rate_pct

#: Names of amount sums inside the aggregates.
_SUMS = {"billed_amount": "_billed", "allowed_amount": "_allowed", "paid_amount": "_paid"}


#: Columns the daily KPI reads; with another report date, that one instead of the update time.
KPI_COLUMNS = ("silver_updated_at", "payer_id", "claim_status", "line_of_business", "network_flag",
               "claim_id", "member_id", "provider_npi", *_SUMS)

#: Columns the scorecard reads.
SCORECARD_COLUMNS = ("provider_npi", "service_year", "service_month", "payer_id", "claim_id", "member_id", "cpt_code",
                     "icd10_code", "claim_status", "billed_amount", "paid_amount")


def _sums(*amounts: str, cents: bool = False) -> list[Column]:
    return [(cents_sum(a) if cents else amount_sum(a)).alias(_SUMS[a]) for a in amounts]


def all_in_cents(claims: DataFrame) -> bool:
    """Whether the builders may take the amounts there are as ``cents``, which spares them buffers and changes
    no sum. Reads the amounts only, up to the first that is no number of cents: for claims that were written."""
    odd = F.lit(False)
    for amount in _SUMS:
        if amount in claims.columns:
            odd = odd | beyond_cents(amount)
    return claims.filter(odd).isEmpty()


def _denied() -> Column:
    return F.count_if(F.col("claim_status") == DENIED)


def _updated(run_ts: datetime | None) -> Column:
    return (F.current_timestamp() if run_ts is None else F.lit(run_ts)).alias("gold_updated_at")


def _distinct_list(column: str) -> Column:
    # DISTINCT inside the list: values are made distinct by the same hash aggregate that counts
    # them, and only distinct values reach the list. collect_set would carry a growing set
    # through every step and force the sort-based path.
    return F.expr(f"array_sort(collect_list(DISTINCT {column}))")


def daily_kpi(
    claims: DataFrame,
    report_date: Column | str = "silver_updated_at",
    accuracy: int = 10_000,
    run_ts: datetime | None = None,
    cents: bool = False,
) -> DataFrame:
    """Claims per report date, payer, status, line of business and network.

    ``report_date`` is the load date; pass ``"service_date"`` to report by day of service.
    The quantile sketch would turn the whole distinct-count rewrite into a sort-based aggregate,
    so it has its own pass over the six columns it needs; the passes meet on the few group keys.
    """
    keys = ["report_date", "payer_id", "claim_status", "line_of_business", "network_flag"]
    day = F.to_date(F.col(report_date) if isinstance(report_date, str) else report_date)
    claims = claims.withColumn("report_date", day)
    counted = claims.groupBy(*keys).agg(
        F.count("claim_id").alias("claim_count"),
        F.count_distinct("member_id").alias("unique_members"),
        F.count_distinct("provider_npi").alias("unique_providers"),
        *_sums("billed_amount", "allowed_amount", "paid_amount", cents=cents),
        F.count("paid_amount").alias("_paid_claims"),
        _denied().alias("denied_count"),
    )
    quantiles = claims.groupBy(*keys).agg(
        F.percentile_approx("paid_amount", [0.5, 0.95], accuracy).alias("_q"))
    right = quantiles.select(*[F.col(k).alias(f"_{k}") for k in keys], "_q")
    same_group = F.lit(True)
    for k in keys:
        same_group = same_group & F.col(k).eqNullSafe(F.col(f"_{k}"))
    paid, billed = F.col("_paid"), F.col("_billed")
    return counted.join(right, same_group).select(
        *keys, "claim_count", "unique_members", "unique_providers",
        billed.alias("total_billed"),
        F.col("_allowed").alias("total_allowed"),
        paid.alias("total_paid"),
        mean_amount(paid, F.col("_paid_claims")).alias("avg_paid_per_claim"),
        F.col("_q")[0].alias("median_paid"),
        F.col("_q")[1].alias("p95_paid"),
        "denied_count",
        rate_pct(F.col("denied_count"), F.col("claim_count")).alias("denial_rate_pct"),
        rate_pct(paid, billed).alias("payment_rate_pct"),
        _updated(run_ts),
    )


#: Registers of a distinct-count sketch, as a power of two: its standard error is 1.04 / sqrt(2^12).
SKETCH_BITS = 12


def kpi_sketches(claims: DataFrame, report_date: Column | str = "silver_updated_at") -> DataFrame:
    """The groups of the daily KPI with mergeable sketches of their members, providers and amounts paid,
    which add up over groups as distinct counts and medians do not."""
    day = F.to_date(F.col(report_date) if isinstance(report_date, str) else report_date)
    return claims.groupBy(day.alias("report_date"), "payer_id", "claim_status", "line_of_business", "network_flag").agg(
        F.count("claim_id").alias("claim_count"),
        F.hll_sketch_agg("member_id", SKETCH_BITS).alias("members_sketch"),
        F.hll_sketch_agg("provider_npi", SKETCH_BITS).alias("providers_sketch"),
        F.kll_sketch_agg_double("paid_amount").alias("paid_sketch"))


def provider_scorecard(claims: DataFrame, run_ts: datetime | None = None, cents: bool = False) -> DataFrame:
    """Claims per provider, month of service and payer, with a tier by denial rate."""
    keys = ["provider_npi", "service_year", "service_month", "payer_id"]
    scored = claims.groupBy(*keys).agg(
        F.count("claim_id").alias("total_claims"),
        F.count_distinct("member_id").alias("patients_served"),
        *_sums("billed_amount", "paid_amount", cents=cents),
        F.count("paid_amount").alias("_paid_claims"),
        _denied().alias("_denied"),
        F.count_distinct("cpt_code").alias("unique_procedures"),
        _distinct_list("icd10_code").alias("icd10_codes_used"),
    )
    paid, billed = F.col("_paid"), F.col("_billed")
    denial = rate_pct(F.col("_denied"), F.col("total_claims"))
    return scored.select(
        *keys, "total_claims", "patients_served",
        billed.alias("total_billed"),
        paid.alias("total_paid"),
        mean_amount(paid, F.col("_paid_claims")).alias("avg_claim_value"),
        denial.alias("denial_rate_pct"),
        # Both are over the same values: one distinct branch less.
        F.size("icd10_codes_used").cast("long").alias("unique_diagnoses"),
        "unique_procedures", "icd10_codes_used",
        rate_pct(paid, billed, 1).alias("cost_efficiency_score"),
        provider_tier(denial).alias("provider_tier"),
        _updated(run_ts),
    )


def provider_tier(denial_rate: Column) -> Column:
    return (F.when(denial_rate < PREFERRED_BELOW_PCT, "PREFERRED")
            .when(denial_rate < STANDARD_BELOW_PCT, "STANDARD").otherwise("REVIEW"))


def member_360(claims: DataFrame, run_ts: datetime | None = None, cents: bool = False) -> DataFrame:
    """Lifetime of a member with a payer and line of business, with a risk tier."""
    keys = ["member_id", "payer_id", "line_of_business"]
    lived = claims.groupBy(*keys).agg(
        F.count("claim_id").alias("lifetime_claims"),
        *_sums("billed_amount", "paid_amount", cents=cents),
        F.min("service_date").alias("first_service_date"),
        F.max("service_date").alias("last_service_date"),
        F.count_distinct("provider_npi").alias("unique_providers_seen"),
        F.count_distinct("icd10_code").alias("unique_diagnoses"),
        _denied().alias("denied_claims"),
        _distinct_list("network_flag").alias("network_usage"),
    )
    claims_n, paid = F.col("lifetime_claims"), F.col("_paid")
    return lived.select(
        *keys, "lifetime_claims",
        F.col("_billed").alias("lifetime_billed"),
        paid.alias("lifetime_paid"),
        "first_service_date", "last_service_date", "unique_providers_seen", "unique_diagnoses",
        "denied_claims", "network_usage",
        F.datediff("last_service_date", "first_service_date").alias("days_as_patient"),
        F.round(paid / F.nullif(claims_n, F.lit(0)), 2).alias("avg_cost_per_episode"),
        risk_tier(claims_n, paid).alias("risk_tier"),
        _updated(run_ts),
    )


def risk_tier(claims_n: Column, paid: Column) -> Column:
    def beyond(n: int, amount: int) -> Column:
        return (claims_n > n) | (paid > amount)
    return (F.when(beyond(HIGH_CLAIMS, HIGH_PAID), "HIGH")
            .when(beyond(MEDIUM_CLAIMS, MEDIUM_PAID), "MEDIUM").otherwise("LOW"))


def diagnosis_monthly(claims: DataFrame, cents: bool = False) -> DataFrame:
    """Claims per diagnosis, month of service and payer. A month needs no claim of another one."""
    monthly = claims.groupBy("icd10_code", "service_year", "service_month", "payer_id").agg(
        F.count("claim_id").alias("claim_count"),
        F.count_distinct("member_id").alias("patients_affected"),
        *_sums("paid_amount", cents=cents),
        F.count("paid_amount").alias("paid_claims"),
        _denied().alias("denied_count"),
    )
    return monthly.withColumnRenamed(_SUMS["paid_amount"], "total_paid")


def diagnosis_growth(
    monthly: DataFrame, calendar: bool = False, run_ts: datetime | None = None
) -> DataFrame:
    """Means and growth over the month before.

    The month before is the previous month with claims; with ``calendar`` it must be the
    calendar month before, else there is no previous value. The window runs on the aggregate,
    one row per month, so its groups stay small whatever the number of claims.
    """
    history = Window.partitionBy("icd10_code", "payer_id").orderBy("service_year", "service_month")
    index = F.col("service_year") * 12 + F.col("service_month")
    before = F.lag("claim_count").over(history)
    if calendar:
        before = F.when(F.lag(index).over(history) == index - 1, before)
    paid, n, prev = F.col("total_paid"), F.col("claim_count"), F.col("prev_month_claims")
    return monthly.withColumn("prev_month_claims", before).select(
        "icd10_code", "service_year", "service_month", "payer_id", "claim_count", "patients_affected",
        "total_paid",
        mean_amount(paid, F.col("paid_claims")).alias("avg_cost_per_episode"),
        "denied_count",
        F.round(paid / F.nullif(F.col("patients_affected"), F.lit(0)), 2).alias("cost_per_patient"),
        "prev_month_claims",
        rate_pct(n - prev, prev).alias("mom_claim_growth_pct"),
        _updated(run_ts),
    )


def diagnosis_trending(
    claims: DataFrame, calendar: bool = False, run_ts: datetime | None = None
) -> DataFrame:
    """Claims per diagnosis, month of service and payer, with growth over the month before."""
    return diagnosis_growth(diagnosis_monthly(claims), calendar, run_ts)


#: Builder of each table, by table name. Fixed names: tables and their columns.
BUILDERS = {
    "gold_daily_claims_kpi": daily_kpi,
    "gold_provider_scorecard": provider_scorecard,
    "gold_member_360": member_360,
    "gold_diagnosis_trending": diagnosis_trending,
}
