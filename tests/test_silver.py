from pyspark.sql import functions as F

from claims import AS_OF, RAW
from claimworks.operators.cleaning import clean
from claimworks.operators.dedup import dedup_latest
from claimworks.operators.rules import (
    THREE_VALUED, apply_rules, claim_rules, quarantine_rows, rule_counts, valid_rows, validity,
)
from claimworks.plans.silver import validated_claims
from claimworks.constants import RAW_COLUMNS
from claimworks.schemas import RAW as RAW_SCHEMA


def raw(spark, rows=RAW):
    return spark.createDataFrame(rows, RAW_SCHEMA).withColumn(
        "ingestion_ts", F.lit("2025-03-01 00:00:00").cast("timestamp"))


def changed(**fields):
    names = RAW_COLUMNS
    return tuple(fields.get(n, v) for n, v in zip(names, RAW[0]))


def flags(spark, row, policy="null_safe"):
    out = validated_claims(raw(spark, [row]), AS_OF, policy).first()
    return out["is_valid"], out["dq_flags"]


def test_clean_types_and_derives(spark):
    row = clean(raw(spark)).filter("claim_id = 'T-1'").first()
    assert str(row["service_date"]) == "2025-04-15"
    assert (row["billed_amount"], row["paid_amount"]) == (2000.0, 1500.0)
    assert row["claim_status"] == "APPROVED"
    assert (row["payment_rate_pct"], row["adjustment_amount"]) == (75.0, 500.0)
    assert (row["service_year"], row["service_month"], row["service_ym"]) == (2025, 4, "2025-04")


def test_zero_billed_has_no_rate(spark):
    assert clean(raw(spark, [changed(billed_amount="0")])).first()["payment_rate_pct"] is None


def test_dedup_keeps_one_row_per_claim(spark):
    out = dedup_latest(raw(spark), ["claim_id"], [F.desc("ingestion_ts")])
    assert sorted(r["claim_id"] for r in out.collect()) == ["T-1", "T-2", "T-3", "T-4"]


def test_dedup_takes_the_newest_and_breaks_ties_alike_in_any_row_order(spark):
    df = spark.createDataFrame(
        [("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), ("l", 1, "x")], "id string, v int, t string")
    first = None
    for parts in (1, 3, 7):
        for order in ("t", "v"):
            shuffled = df.orderBy(F.desc(order)).repartition(parts)
            got = {r["id"]: r["t"] for r in dedup_latest(shuffled, ["id"], [F.desc("v")]).collect()}
            first = first or got
            assert got == first and got["k"] in "bc" and got["l"] == "x"
    newest = dedup_latest(df, ["id"], [F.desc("v"), F.desc("t")]).collect()
    assert {r["id"]: r["t"] for r in newest} == {"k": "c", "l": "x"}
    assert newest[0].asDict().keys() == {"id", "v", "t"}


def test_dedup_reads_its_input_once(spark, tmp_path):
    raw(spark).write.parquet(str(tmp_path / "r"))
    plan = dedup_latest(spark.read.parquet(str(tmp_path / "r")), ["claim_id"], [F.desc("ingestion_ts")])
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_null_keys_are_kept_or_collapsed(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1), ("a", 2)], "id string, v int")
    assert dedup_latest(df, ["id"], [F.desc("v")]).count() == 3
    assert dedup_latest(df, ["id"], [F.desc("v")], "collapse").count() == 2


def test_rules_on_the_five_rows(spark):
    out = validated_claims(raw(spark), AS_OF)
    got = {r["claim_id"]: (r["is_valid"], r["dq_flags"]) for r in out.collect()}
    assert got == {
        "T-1": (True, "[]"), "T-2": (True, "[]"),
        "T-3": (False, '["NULL_MEMBER_ID"]'),
        "T-4": (False, '["NEGATIVE_AMOUNT","PAID_EXCEEDS_BILLED"]'),
    }
    summary = validity(out).first()
    assert (summary["total"], summary["valid"], summary["invalid"]) == (4, 2, 2)
    assert (summary["validity_pct"], summary["status"]) == (50.0, "DQ_WARNING")


def test_each_rule(spark):
    for fields, flag in [
        ({"claim_id": None}, "NULL_CLAIM_ID"), ({"member_id": None}, "NULL_MEMBER_ID"),
        ({"claim_status": "ODD"}, "INVALID_STATUS"), ({"claim_status": None}, "INVALID_STATUS"),
        ({"billed_amount": "-2000", "paid_amount": "-3000"}, "NEGATIVE_AMOUNT"),
        ({"service_date": "2026-01-01"}, "FUTURE_DATE"), ({"service_date": "x"}, "NULL_SERVICE_DATE"),
        ({"service_date": None}, "NULL_SERVICE_DATE"), ({"paid_amount": "2001"}, "PAID_EXCEEDS_BILLED"),
        ({"provider_npi": "12345678901"}, "INVALID_NPI_LENGTH"),
        ({"provider_npi": None}, "INVALID_NPI_LENGTH"), ({"provider_npi": "  "}, "INVALID_NPI_LENGTH"),
    ]:
        assert flags(spark, changed(**fields)) == (False, f'["{flag}"]'), fields
    for fields in ({"provider_npi": "12345"}, {"service_date": AS_OF}, {"paid_amount": "$2,000.00"},
                   {"member_id": ""}, {"billed_amount": "?"}):
        assert flags(spark, changed(**fields)) == (True, "[]"), fields


def test_three_valued_policy_loses_rows_with_unknown_flags(spark):
    assert flags(spark, changed(service_date=None), THREE_VALUED) == (None, '["NULL_SERVICE_DATE"]')
    assert flags(spark, changed(claim_status=None), THREE_VALUED)[0] is None
    assert flags(spark, changed(member_id=None), THREE_VALUED) == (False, '["NULL_MEMBER_ID"]')
    assert flags(spark, changed(provider_npi="12345678901"), THREE_VALUED) == (True, "[]")


def test_every_row_is_valid_or_quarantined(spark):
    rows = RAW + [changed(claim_id=None, **{c: None}) for c in RAW_COLUMNS[1:]]
    out = validated_claims(raw(spark, rows), AS_OF)
    assert valid_rows(out).count() + quarantine_rows(out).count() == out.count() == 4 + 12


def test_rule_counts_and_array(spark):
    cleaned = clean(raw(spark))
    got = dict(rule_counts(cleaned, claim_rules(AS_OF)).collect())
    assert got["NULL_MEMBER_ID"] == 1 and got["NULL_CLAIM_ID"] == 0 and len(got) == 8
    named = apply_rules(cleaned, claim_rules(AS_OF), keep_array=True)
    assert named.filter("claim_id = 'T-3'").first()["dq_flag_names"] == ["NULL_MEMBER_ID"]


def test_validity_of_nothing(spark):
    row = validity(validated_claims(raw(spark, []), AS_OF)).first()
    assert (row["total"], row["validity_pct"], row["status"]) == (0, 0.0, "DQ_WARNING")
