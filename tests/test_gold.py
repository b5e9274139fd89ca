from datetime import date

import pytest
from pyspark.sql import functions as F

from claims import SILVER, SILVER_DDL
from claimworks.plans import gold, views


@pytest.fixture(scope="module")
def silver(spark):
    return spark.createDataFrame(SILVER, SILVER_DDL)


def test_daily_kpi(silver):
    rows = gold.daily_kpi(silver).collect()
    assert sum(r["claim_count"] for r in rows if r["payer_id"] == "NORTH") == 2
    one = next(r for r in rows if r["claim_status"] == "APPROVED" and r["payer_id"] == "NORTH")
    assert (one["total_billed"], one["total_paid"], one["payment_rate_pct"]) == (1600.0, 1200.0, 75.0)
    assert (one["median_paid"], one["p95_paid"], one["denial_rate_pct"]) == (1200.0, 1200.0, 0.0)
    assert one["report_date"] == date(2025, 5, 2)


def test_daily_kpi_groups_with_null_keys_survive(spark, silver):
    nulls = silver.withColumn("network_flag", F.lit(None).cast("string"))
    rows = gold.daily_kpi(nulls, report_date="service_date").collect()
    assert len(rows) == 3 and all(r["network_flag"] is None for r in rows)
    assert all(r["median_paid"] is not None for r in rows)


def test_quantiles_are_elements(spark):
    many = spark.range(1, 101).select(
        F.col("id").cast("string").alias("claim_id"), F.lit("m").alias("member_id"),
        F.lit("n").alias("provider_npi"), F.col("id").cast("double").alias("paid_amount"),
        F.lit(1.0).alias("billed_amount"), F.lit(1.0).alias("allowed_amount"),
        F.lit("APPROVED").alias("claim_status"), F.lit("p").alias("payer_id"),
        F.lit("l").alias("line_of_business"), F.lit("IN").alias("network_flag"),
        F.lit("2025-01-01").cast("date").alias("silver_updated_at"))
    row = gold.daily_kpi(many).first()
    assert (row["median_paid"], row["p95_paid"], row["avg_paid_per_claim"]) == (50.0, 95.0, 50.5)


def test_provider_scorecard(silver):
    rows = {r["provider_npi"]: r for r in gold.provider_scorecard(silver).collect()}
    one = rows["DOC0000001"]
    assert (one["denial_rate_pct"], one["provider_tier"]) == (50.0, "REVIEW")
    assert one["icd10_codes_used"] == ["K21.0", "M54.5"] and one["unique_diagnoses"] == 2
    assert one["cost_efficiency_score"] == 60.0
    assert rows["DOC0000002"]["provider_tier"] == "PREFERRED"


@pytest.mark.parametrize("rate, tier", [
    (0, "PREFERRED"), (4.99, "PREFERRED"), (5, "STANDARD"), (14.99, "STANDARD"), (15, "REVIEW")])
def test_provider_tier_edges(spark, rate, tier):
    assert spark.range(1).select(gold.provider_tier(F.lit(float(rate)))).first()[0] == tier


@pytest.mark.parametrize("n, paid, tier", [
    (50, 100000.0, "MEDIUM"), (51, 0.0, "HIGH"), (1, 100000.01, "HIGH"), (20, 30000.0, "LOW"),
    (21, 0.0, "MEDIUM"), (1, 30000.5, "MEDIUM")])
def test_risk_tier_edges(spark, n, paid, tier):
    assert spark.range(1).select(gold.risk_tier(F.lit(n), F.lit(paid))).first()[0] == tier


def test_member_360(silver):
    rows = {(r["member_id"], r["payer_id"]): r for r in gold.member_360(silver).collect()}
    one = rows["PA", "NORTH"]
    assert (one["risk_tier"], one["days_as_patient"], one["network_usage"]) == ("LOW", 0, ["IN"])
    assert one["avg_cost_per_episode"] == 1200.0


def monthly(spark, months):
    rows = [(f"C{y}{m}{i}", "M1", "N", date(y, m, 1), 10.0, 10.0, 5.0, "APPROVED", "P", "D", "1",
             "L", "IN", y, m, date(2025, 5, 2)) for y, m, n in months for i in range(n)]
    return spark.createDataFrame(rows, SILVER_DDL)


def test_growth_over_previous_row_and_previous_month(spark):
    claims = monthly(spark, [(2024, 12, 2), (2025, 1, 3), (2025, 3, 6)])
    by_row = {r["service_month"]: r for r in gold.diagnosis_trending(claims).collect()}
    assert by_row[12]["prev_month_claims"] is None
    assert by_row[1]["mom_claim_growth_pct"] == 50.0 and by_row[3]["mom_claim_growth_pct"] == 100.0
    by_month = {r["service_month"]: r for r in gold.diagnosis_trending(claims, calendar=True).collect()}
    assert by_month[1]["prev_month_claims"] == 2 and by_month[3]["prev_month_claims"] is None


def test_cost_per_patient_without_a_patient(spark):
    claims = monthly(spark, [(2025, 1, 2)]).withColumn("member_id", F.lit(None).cast("string"))
    row = gold.diagnosis_trending(claims).first()
    assert (row["patients_affected"], row["cost_per_patient"]) == (0, None)


def test_top_diagnoses_breaks_ties_by_code_then_payer(spark):
    rows = [(f"D{i:03}", 2025, 1, p, 7) for i in range(40) for p in ("A", "B")]
    trending = spark.createDataFrame(
        rows, "icd10_code string, service_year int, service_month int, payer_id string, claim_count bigint"
    ).withColumns({c: F.lit(1.0) for c in (
        "patients_affected", "total_paid", "cost_per_patient", "mom_claim_growth_pct")})
    top = views.top_diagnoses(trending).orderBy("rank_by_volume").collect()
    assert len(top) == 50
    assert [(r["icd10_code"], r["payer_id"]) for r in top[:3]] == [("D000", "A"), ("D000", "B"), ("D001", "A")]


def test_tier_summary_and_latest_tier(spark, silver):
    later = silver.filter("claim_id = 'S-1'").withColumn("service_month", F.lit(5))
    scored = gold.provider_scorecard(silver.unionByName(later))
    summary = {r["provider_npi"]: r for r in views.provider_tier_summary(scored).collect()}
    assert summary["DOC0000001"]["current_tier"] == "REVIEW"
    assert summary["DOC0000001"]["avg_denial_rate_pct"] == 25.0
    latest = {r["provider_npi"]: r for r in views.provider_latest_tier(scored).collect()}
    assert (latest["DOC0000001"]["latest_month"], latest["DOC0000001"]["latest_tier"]) == (5, "PREFERRED")


def test_dashboard_adds_up_and_exact_does_not_double_count(silver):
    kpi = gold.daily_kpi(silver.withColumn("payer_id", F.lit("P")))
    board = views.exec_dashboard(kpi).first()
    assert (board["total_claims"], board["unique_members"]) == (3, 3)
    assert board["overall_denial_rate_pct"] == 33.33
    exact = views.exec_exact(silver.withColumn("payer_id", F.lit("P"))).first()
    assert exact["unique_members_exact"] == 2


def test_high_risk_members(spark, silver):
    members = gold.member_360(silver).withColumns({"risk_tier": F.lit("HIGH"), "lifetime_claims": F.lit(6)})
    assert views.high_risk_members(members).count() == 3
    assert views.high_risk_members(members.withColumn("lifetime_claims", F.lit(5))).count() == 0
    assert views.high_risk_members(members.withColumn("risk_tier", F.lit("LOW"))).count() == 0


def test_snapshot_of_all_days(spark, silver, new_table):
    name, location = new_table("snaps")
    kpi = gold.daily_kpi(silver)
    want = {(r[0], r[1]) for r in kpi.select("report_date", "payer_id").collect() if r[0] is not None}
    assert views.refresh_kpi_snapshot(kpi, None, name, location) == len(want)
    assert views.refresh_kpi_snapshot(kpi, "2025-05-02", name, location) == 2
    assert {(r["snapshot_date"], r["payer_id"]) for r in spark.table(name).collect()} == want


def test_snapshot_creates_then_updates(spark, silver, new_table):
    name, location = new_table("snap")
    kpi = gold.daily_kpi(silver)
    assert views.refresh_kpi_snapshot(kpi, "2025-05-02", name, location) == 2
    more = gold.daily_kpi(silver.unionByName(silver.filter("payer_id = 'NORTH'")))
    assert views.refresh_kpi_snapshot(more, "2025-05-02", name, location) == 2
    assert views.refresh_kpi_snapshot(kpi, "2024-01-01", name, location) == 0
    got = {r["payer_id"]: r["total_claims"] for r in spark.table(name).collect()}
    assert got == {"NORTH": 4, "SOUTH": 1}


def test_views_over_catalog_tables(spark, silver, new_table):
    prefix, _ = new_table("g")
    for table, build in gold.BUILDERS.items():
        build(silver).write.saveAsTable(f"{prefix}_{table}")
    views.register_views(spark, f"{prefix}_")
    assert spark.table("vw_exec_claims_dashboard").count() == 2
    assert spark.table("vw_diagnosis_mom_trend").count() == 3


def test_amounts_of_any_size_add_up_and_average(spark):
    from claimworks.functions import amount_mean, amount_sum
    rows = [("a", 0.1), ("a", 0.2), ("a", 1e17), ("b", 2e19), ("b", 2e19), ("b", 0.5), ("c", 1e300), ("c", 1.0), ("c", 3e25),
            ("d", None), ("e", -2e19), ("e", 2e19), ("f", 9.999999999999999e27), ("f", 1e28)]
    got = {r[0]: (r[1], r[2]) for r in spark.createDataFrame(rows, "k string, v double").groupBy("k").agg(
        amount_sum("v"), amount_mean("v")).collect()}
    assert got == {"a": (1e17 + 0.3, (1e17 + 0.3) / 3), "b": (4e19, 4e19 / 3), "c": (1e300, 1e300 / 3), "d": (None, None),
                   "e": (0.0, 0.0), "f": (9.999999999999999e27 + 1e28, (9.999999999999999e27 + 1e28) / 2)}


def test_monthly_trending_of_some_months_is_part_of_the_whole(spark):
    from test_scale import claims

    from claimworks.plans.gold import diagnosis_growth, diagnosis_monthly, diagnosis_trending
    df = claims(spark, 900)
    parts = [diagnosis_monthly(df.filter(test)) for test in ("service_month <= 3", "service_month > 3")]
    joined = diagnosis_growth(parts[0].unionByName(parts[1])).drop("gold_updated_at")
    assert sorted(map(str, joined.collect())) == sorted(map(str, diagnosis_trending(df).drop("gold_updated_at").collect()))
