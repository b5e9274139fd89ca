"""What the plans must look like to hold on large, skewed data, and that skew changes no result."""

import glob
from collections import Counter

import pytest
from pyspark.sql import functions as F

from claims import SILVER_DDL
from claimworks import fixture as fx
from claimworks.operators import checks, tables
from claimworks.operators.dedup import dedup_latest
from claimworks.plans import gold
from claimworks.plans.silver import validated_claims
from claimworks.session import session_conf
from claimworks.sources.raw import read_batch

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_cut_before_the_shuffle(spark):
    bronze = fx.bronze_claims(spark, SF)
    text = plan(validated_claims(bronze, fx.AS_OF, order_by=fx.newest_first()))
    before_shuffle = text[text.index("hashpartitioning(claim_id"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert "null_keys" not in text


def test_dedup_of_a_key_with_a_third_of_all_rows(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("claim_id"),
        (F.col("id") * 7919 % 10_007).alias("ts"), F.col("id").alias("n"))
    best: dict = {}
    nulls = 0
    for r in rows.collect():
        if r["claim_id"] is None:
            nulls += 1
        elif r["claim_id"] not in best or (r["ts"], r["n"]) > best[r["claim_id"]]:
            best[r["claim_id"]] = (r["ts"], r["n"])
    got = dedup_latest(rows.repartition(16), ["claim_id"], [F.desc("ts")]).collect()
    assert Counter(r["claim_id"] for r in got)[None] == nulls == 10_000
    assert {r["claim_id"]: (r["ts"], r["n"]) for r in got if r["claim_id"]} == best


def claims(spark, n=6_000):
    """A third of all claims belong to one member, provider, payer, status and diagnosis."""
    i = F.col("id")
    hot = i % 3 == 0

    def skewed(prefix, width):
        return F.concat(F.lit(prefix), F.when(hot, F.lit(0)).otherwise(i * 31 % width).cast("string"))

    day = F.date_add(F.lit("2024-01-01").cast("date"), (i % 300).cast("int"))
    return spark.range(n).select(
        F.concat(F.lit("C"), i).alias("claim_id"), skewed("M", 97).alias("member_id"),
        skewed("N", 41).alias("provider_npi"), day.alias("service_date"),
        (i % 1000 + 0.25).alias("billed_amount"), (i % 900 + 0.25).alias("allowed_amount"),
        (i % 800 + 0.25).alias("paid_amount"),
        F.when(i % 5 == 0, "DENIED").otherwise("APPROVED").alias("claim_status"),
        skewed("P", 5).alias("payer_id"), skewed("D", 23).alias("icd10_code"),
        skewed("T", 11).alias("cpt_code"), F.lit("L").alias("line_of_business"),
        F.when(i % 7 == 0, "OUT").otherwise("IN").alias("network_flag"),
        F.year(day).alias("service_year"), F.month(day).alias("service_month"),
        F.lit("2025-01-01").cast("date").alias("silver_updated_at"),
    ).select(*[f.split()[0] for f in SILVER_DDL.split(", ")])


def test_aggregates_of_skewed_claims_against_brute_force(spark):
    rows = claims(spark).collect()
    df = claims(spark).repartition(16)

    def groups(*keys):
        out: dict = {}
        for r in rows:
            out.setdefault(tuple(r[k] for k in keys), []).append(r)
        return out

    want = groups("silver_updated_at", "payer_id", "claim_status", "line_of_business", "network_flag")
    for r in gold.daily_kpi(df).collect():
        g = want.pop((r["report_date"], r["payer_id"], r["claim_status"], r["line_of_business"], r["network_flag"]))
        paid = sorted(x["paid_amount"] for x in g)
        assert r["claim_count"] == len(g)
        assert r["unique_members"] == len({x["member_id"] for x in g})
        assert r["unique_providers"] == len({x["provider_npi"] for x in g})
        assert r["total_paid"] == sum(paid)
        assert r["median_paid"] == paid[-(-len(paid) // 2) - 1]
        assert r["p95_paid"] == paid[-(-len(paid) * 95 // 100) - 1]
    assert not want

    want = groups("provider_npi", "service_year", "service_month", "payer_id")
    for r in gold.provider_scorecard(df).collect():
        g = want.pop((r["provider_npi"], r["service_year"], r["service_month"], r["payer_id"]))
        assert r["icd10_codes_used"] == sorted({x["icd10_code"] for x in g})
        assert r["unique_procedures"] == len({x["cpt_code"] for x in g})
        assert r["total_billed"] == sum(x["billed_amount"] for x in g)
    assert not want

    want = groups("member_id", "payer_id", "line_of_business")
    for r in gold.member_360(df).collect():
        g = want.pop((r["member_id"], r["payer_id"], r["line_of_business"]))
        assert r["network_usage"] == sorted({x["network_flag"] for x in g})
        assert r["days_as_patient"] == (max(x["service_date"] for x in g) - min(x["service_date"] for x in g)).days
        assert r["denied_claims"] == sum(x["claim_status"] == "DENIED" for x in g)
    assert not want


@pytest.mark.parametrize("table", sorted(gold.BUILDERS))
def test_builders_combine_before_the_shuffle(spark, table):
    text = plan(gold.BUILDERS[table](claims(spark)))
    assert "partial_count" in text and "partial_sum" in text
    for line in text.splitlines():
        if "Aggregate" in line and "percentile_approx" not in line and "collect_list" not in line:
            assert "ObjectHashAggregate" not in line and "SortAggregate" not in line


def test_batch_read_prunes_partitions_and_columns(spark, new_table):
    name, location = new_table()
    bronze = claims(spark).select("claim_id", "member_id", F.col("service_date").alias("ingestion_date"),
                                  F.lit(False).alias("is_corrupt"))
    tables.create(bronze, name, ["ingestion_date"], location)
    text = read_batch(spark.table(name), "2024-02-01").select("claim_id")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in text
    assert "ReadSchema: struct<claim_id:string,is_corrupt:boolean>" in text


def test_orphans_meet_on_one_row_per_provider(spark):
    silver = claims(spark).withColumn("silver_batch_date", F.lit("2025-01-01").cast("date"))
    orphans = checks.orphan_measures(silver, gold.provider_scorecard(claims(spark, 30)), "2025-01-01")
    known = {r["provider_npi"] for r in claims(spark, 30).select("provider_npi").collect()}
    want = sum(r["provider_npi"] not in known for r in silver.select("provider_npi").collect())
    assert orphans.first()["n"] == want > 0


def test_hot_partition_is_written_by_many_tasks(spark, new_table):
    name, location = new_table()
    rows = spark.range(200_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 8).otherwise(F.lit(99)).cast("int").alias("part"))
    with session_conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="1m"):
        tables.create(rows.repartition(8), name, ["part"], location)
    assert len(glob.glob(f"{location}/part=99/*.parquet")) > 2
    assert spark.table(name).groupBy("part").count().agg(F.sum("count")).first()[0] == 200_000
