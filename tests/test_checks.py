from datetime import datetime

import pytest
from pyspark.sql import functions as F

from claimworks.operators import access, checks

MEASURES = {"bronze_count": 100, "bronze_distinct": 100, "silver_count": 95, "valid_count": 95,
            "future_dates_count": 0, "duplicate_claim_ids": 0, "quarantined_count": 5,
            "orphan_provider_records": 0}


def judge(spark, coverage="rows", **changes):
    rows = list({**MEASURES, **changes}.items())
    return checks.verdict(spark.createDataFrame(rows, "measure string, n bigint"), coverage).first()


@pytest.mark.parametrize("changes, status, violations", [
    ({}, "PASS", "[]"),
    ({"orphan_provider_records": 9}, "PASS", "[]"),
    ({"bronze_count": 10000, "silver_count": 9499, "valid_count": 9499, "quarantined_count": 501},
     "FAIL", '["VALIDITY_BELOW_95: 94.99%"]'),
    ({"silver_count": 90, "valid_count": 90, "quarantined_count": 0}, "PASS", "[]"),
    ({"silver_count": 89, "valid_count": 89, "quarantined_count": 0}, "FAIL", '["LOW_COVERAGE: 89.0%"]'),
    ({"future_dates_count": 1, "duplicate_claim_ids": 2}, "FAIL", '["FUTURE_DATES: 1","DUPLICATES: 2"]'),
    ({k: 0 for k in MEASURES}, "FAIL", '["VALIDITY_BELOW_95: 0.0%","LOW_COVERAGE: 0.0%"]'),
])
def test_verdict(spark, changes, status, violations):
    row = judge(spark, **changes)
    assert (row["overall_status"], row["sla_violations"]) == (status, violations)


def test_coverage_of_distinct_claims(spark):
    changes = {"bronze_count": 200, "bronze_distinct": 100}
    assert judge(spark, **changes)["overall_status"] == "FAIL"
    row = judge(spark, "distinct", **changes)
    assert row["overall_status"] == "PASS"
    assert (row["silver_coverage_pct"], row["distinct_coverage_pct"]) == (47.5, 95.0)


def test_rows_and_audit_report_the_coverage_that_was_judged(spark):
    rows = [(k, v) for k, v in {**MEASURES, "bronze_count": 200}.items()]
    for coverage, value in (("rows", 47.5), ("distinct", 95.0)):
        judged = checks.verdict(spark.createDataFrame(rows, "measure string, n bigint"), coverage)
        row = checks.check_rows(judged).filter("check = 'coverage'").first()
        assert (row["value"], row["passed"]) == (value, coverage == "distinct")
        assert checks.audit_row(judged, "2025-01-01").first()["silver_coverage_pct"] == value


def test_measures_not_taken_count_as_zero(spark):
    only = spark.createDataFrame([("bronze_count", 3)], "measure string, n bigint")
    assert checks.verdict(only).first()["quarantined_count"] == 0


def test_silver_and_bronze_measures(spark):
    silver = spark.sql("""SELECT * FROM VALUES
        ('a', 'n', DATE '2025-01-01', true, DATE '2025-02-01'),
        ('a', 'n', DATE '2030-01-01', false, DATE '2025-02-01'),
        (CAST(NULL AS STRING), 'm', DATE '2025-01-01', true, DATE '2025-02-01'),
        ('z', 'n', DATE '2030-01-01', true, DATE '2025-02-02')
        AS t(claim_id, provider_npi, service_date, is_valid, silver_batch_date)""")
    got = dict(checks.silver_measures(silver, "2025-02-01", "2025-12-31").collect())
    assert got == {"silver_count": 3, "valid_count": 2, "future_dates_count": 1, "duplicate_claim_ids": 2}
    card = spark.createDataFrame([("n",), ("n",)], "provider_npi string")
    assert dict(checks.orphan_measures(silver, card, "2025-02-01").collect()) == {"orphan_provider_records": 1}
    assert dict(checks.orphan_measures(silver, card, "1999-01-01").collect()) == {"orphan_provider_records": 0}
    nobody = silver.withColumn("provider_npi", F.lit(None).cast("string"))
    assert dict(checks.orphan_measures(nobody, card, "2025-02-01").collect()) == {"orphan_provider_records": 3}
    bronze = spark.sql("""SELECT * FROM VALUES ('a', false), ('a', false), (CAST(NULL AS STRING), false),
        (CAST(NULL AS STRING), false), ('b', true) AS t(claim_id, is_corrupt)""").withColumn(
        "ingestion_date", F.lit("2025-02-01").cast("date"))
    assert dict(checks.bronze_measures(bronze, "2025-02-01").collect()) == {
        "bronze_count": 4, "bronze_distinct": 3}


def test_freshness(spark, new_table):
    name, _ = new_table("fresh")
    spark.createDataFrame([(datetime(2025, 1, 1, 0, 0),)], "gold_updated_at timestamp").write.saveAsTable(name)
    empty = f"{name}_empty"
    spark.table(name).limit(0).write.saveAsTable(empty)
    opened = checks.open_tables(spark, [name, empty, "no_such_table"])
    ages = dict(checks.freshness(spark, opened, datetime(2025, 1, 1, 1, 30, 3)).collect())
    assert ages == {name: 90.1, empty: 9999.0, "no_such_table": -1.0}


def test_restrict_rows(spark):
    df = spark.createDataFrame([("P1",), ("P2",), (None,)], "payer_id string")
    assert access.restrict_rows(df, is_admin=True).count() == 3
    assert [r[0] for r in access.restrict_rows(df, "P1").collect()] == ["P1"]
    assert access.restrict_rows(df).count() == 0


def test_masks(spark):
    df = spark.createDataFrame([("MBR-001", "1234567890"), (None, None)], "member_id string, provider_npi string")
    shown = access.mask_columns(df).collect()
    assert tuple(shown[0]) == ("XXX-nnn", "nnnnnnnnnn") and tuple(shown[1]) == (None, None)
    hashed = access.mask_columns(df, method="hash", salt="y").first()
    assert len(hashed["member_id"]) == 64
    assert access.mask_columns(df, method="hash", salt="x").first() != hashed
    with pytest.raises(ValueError):
        access.mask_columns(df, method="hash")
    with pytest.raises(ValueError):
        access.mask_columns(df, method="none")


def test_row_function_shows_the_callers_rows(spark):
    spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], "payer_id string, n int").createOrReplaceTempView("held_rows")
    access.row_function(spark, "held_rows", "my_rows")

    def seen(*caller, **options):
        access.set_caller(spark, *caller, **options)
        return sorted(r["n"] for r in spark.sql("SELECT * FROM my_rows()").collect())

    assert spark.sql("SELECT * FROM my_rows()").isEmpty()
    assert [seen("A"), seen("B"), seen("C"), seen(None)] == [[1], [2], [], []]
    assert seen(is_admin=True) == [1, 2, 3] and seen("' OR true --") == []
    access.row_function(spark, "held_rows", "my_rows")  # again, for the caller that is set
    assert seen("B") == [2]


def test_check_rows_with_freshness(spark):
    rows = list(MEASURES.items())
    judged = checks.verdict(spark.createDataFrame(rows, "measure string, n bigint"))
    ages = spark.createDataFrame([("a", 12.5), ("empty", 9999.0), ("gone", -1.0)], "table_name string, age_minutes double")
    got = {r["check"]: (r["value"], r["passed"]) for r in checks.check_rows(judged, ages).collect()}
    assert got["freshness_a"] == (12.5, True) and got["freshness_empty"] == (9999.0, False) and got["freshness_gone"] == (-1.0, False)
    assert len(got) == 8
