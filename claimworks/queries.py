"""Registered queries: every operator over the whole of the given tables.

Each takes a session and the folder of the tables. Those that write use tables of their own in
the shared folder and return what they wrote.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks import fixture as fx
from claimworks.constants import (
    AMOUNT_COLUMNS, BRONZE, BRONZE_LOG, BRONZE_STREAM, DIAGNOSIS, KPI_SNAPSHOT, RAW_COLUMNS, SCORECARD, SILVER,
)
from claimworks.operators import access, checks, rules, tables
from claimworks.operators.cleaning import NPI_LENGTH, clean, cleaned_columns
from claimworks.operators.dedup import dedup_latest
from claimworks.plans import batch, gold, views
from claimworks.plans.silver import silver_rows, validated_claims
from claimworks.session import remove_scratch, scratch_path, shuffles_freed
from claimworks.sources import events as ev
from claimworks.sources import raw as src
from claimworks.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Load time of everything that is compared, and the last month of the first of two loads.
RUN_TS = "2024-12-15 06:00:00"
FIRST_LOAD, SECOND_LOAD = "1998-06-01", "2001-12-01"
ORDER_COLUMNS = ("ingestion_ts", "tie_part", "tie_supplier")
#: Order among copies of a claim in files, which have no load time of their own.
LOAD_ORDER = ("billed_amount", "allowed_amount", "paid_amount", "service_date", "claim_status", "member_id",
              "provider_npi", "icd10_code", "cpt_code", "payer_id", "line_of_business", "network_flag")


def _load_order() -> tuple:
    return tuple(F.desc_nulls_last(c) for c in LOAD_ORDER)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _run_ts():
    return F.lit(RUN_TS).cast("timestamp")


def _claims(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return fx.claims_raw(spark, sf, columns or RAW_COLUMNS)


def _validated(spark, sf, policy=rules.NULL_SAFE, null_keys="keep", columns=RAW_COLUMNS, **options):
    bronze = fx.claims_raw(spark, sf, [*columns, *ORDER_COLUMNS])
    return validated_claims(bronze, fx.AS_OF, policy, null_keys, fx.newest_first(), **options)


def _valid(spark, sf) -> DataFrame:
    """Valid claims as the silver table holds them, without its order columns."""
    return silver_rows(_validated(spark, sf).drop(*ORDER_COLUMNS), fx.AS_OF, _run_ts())


def _table(spark: SparkSession, label: str) -> tuple[str, str]:
    """A table name nobody uses and its folder."""
    return f"{label}_{uuid.uuid4().hex}", scratch_path(spark, label)


def _contents(spark: SparkSession, name: str, location: str) -> DataFrame:
    """The rows of a written table. Its name stays too: the catalog knows where its partitions lie."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


# -- columns ----------------------------------------------------------------------------------

@query
def parse_dates(spark, sf):
    return _claims(spark, sf, "service_date").select(
        F.col("service_date").alias("service_date_text"),
        cleaned_columns()["service_date"].alias("service_date"))


@query
def parse_amounts(spark, sf):
    parsed = cleaned_columns()
    return _claims(spark, sf, *AMOUNT_COLUMNS).select(
        *[F.col(c).alias(f"{c}_text") for c in AMOUNT_COLUMNS],
        *[parsed[c].alias(c) for c in AMOUNT_COLUMNS])


@query
def normalise_codes(spark, sf):
    codes = ("claim_status", "icd10_code", "cpt_code", "payer_id", "line_of_business",
             "network_flag", "member_id")
    normal = cleaned_columns()
    return _claims(spark, sf, *codes).select(*[normal[c].alias(c) for c in codes])


@query
def pad_npi(spark, sf):
    return _claims(spark, sf, "provider_npi").select(
        F.col("provider_npi").alias("npi_text"),
        cleaned_columns()["provider_npi"].alias("provider_npi"),
        F.length(F.trim("provider_npi")).alias(NPI_LENGTH))


@query
def derived_amounts(spark, sf):
    return clean(_claims(spark, sf)).select(
        "claim_id", "billed_amount", "paid_amount", "payment_rate_pct", "adjustment_amount",
        "service_year", "service_month", "service_ym")


# -- bronze -----------------------------------------------------------------------------------

def _bronze(spark, sf, batch_date=None) -> DataFrame:
    """The claims as bronze rows, one batch per load month or all in the given one."""
    claims = fx.claims_raw(spark, sf, [*RAW_COLUMNS, *ORDER_COLUMNS, "ingestion_date"])
    claims = claims.withColumnsRenamed({"ingestion_ts": "_ts", "ingestion_date": "_day"})
    day = F.col("_day") if batch_date is None else batch_date
    return src.add_provenance(claims, day, F.col("_ts"), F.lit("lineitem")).drop("_ts", "_day")


@query
def bronze_provenance(spark, sf):
    return _bronze(spark, sf).drop("tie_part", "tie_supplier", "ingestion_ts", "source_file")


@query
def incremental_batch(spark, sf):
    """Written by load month, then one month read back through partition pruning."""
    name, location = _table(spark, "incremental")
    tables.replace_partitions(_bronze(spark, sf), name, ["ingestion_date"], location, rebalance=True)
    rows = _contents(spark, name, location)
    return src.read_batch(rows, FIRST_LOAD).select(*RAW_COLUMNS, "ingestion_date")


def _events(spark, sf, mixed: bool = False) -> DataFrame:
    """Envelopes around the events table; an error event has a body that is no JSON. ``mixed``
    gives some events the claims of line items and identifiers that are too long or blank."""
    e = fx.load(spark, sf, "events")
    c = F.col
    kind = (F.when(c("event_type") == "signup", "SUBMIT")
            .when(c("event_type") == "purchase", "ADJUDICATE").otherwise("UPDATE"))
    day = F.to_date("ts")
    user = c("user_id").cast("string")
    claim, npi = F.concat(F.lit("CLM"), user), (c("user_id") + 12345).cast("string")
    if mixed:
        claim = F.when(c("user_id") % 3 == 0, F.concat(F.lit("CLM"), F.lpad(user, 8, "0"), F.lit("-1"))).otherwise(claim)
        npi = (F.when(c("user_id") % 10 == 3, (c("user_id") + 10_000_000_000).cast("string"))
               .when(c("user_id") % 10 == 5, "  ").otherwise(npi))
    body = F.to_json(F.struct(
        claim.alias("claim_id"),
        F.concat(F.lit("MBR"), (c("user_id") % 97).cast("string")).alias("member_id"),
        npi.alias("provider_npi"),
        F.when(c("event_id") % 2 == 0, F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.date_format(day, "MM/dd/yyyy")).alias("service_date"),
        (c("value") * 2).alias("billed_amount"),
        c("value").alias("paid_amount"),
        F.lit(" approved").alias("claim_status"),
        F.concat(F.lit("PYR"), (c("user_id") % 5).cast("string")).alias("payer_id"),
        kind.alias("event_type"),
    ))
    return e.select(
        c("ts").cast("timestamp").alias("enqueuedTime"),
        F.when(c("event_type") == "error", F.lit("{broken")).otherwise(body)
        .cast("binary").alias("body"),
        (c("event_id") % 4).cast("string").alias("partition"),
        c("event_id").cast("string").alias("offset"),
    )


EVENT_COLUMNS = (
    "claim_id", "member_id", "provider_npi", "service_date", "billed_amount", "paid_amount",
    "claim_status", "payer_id", "event_type", "event_time", "partition_id", "eh_offset")


def _event_time_text(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query
def bronze_union(spark, sf):
    """Batch rows and stream rows side by side, counted by where they came from and status."""
    stream = ingest.parse_events(ev.select_envelope(_events(spark, sf)))
    both = clean(src.bronze_union(_bronze(spark, sf), stream))
    return both.groupBy(
        F.col("partition_id").isNull().alias("from_batch"), "claim_status", "payer_id").agg(
        F.count("*").alias("n"), gold.amount_sum("paid_amount").alias("paid"))


# -- duplicates and rules ---------------------------------------------------------------------

def _dedup_latest(spark, sf):
    bronze = fx.claims_raw(spark, sf, [*RAW_COLUMNS, *ORDER_COLUMNS])
    return dedup_latest(bronze, ["claim_id"], fx.newest_first()).select(*RAW_COLUMNS)


QUERIES["dedup_latest"] = _dedup_latest


@query
def dedup_null_collapsed(spark, sf):
    bronze = fx.claims_raw(spark, sf, [*RAW_COLUMNS, *ORDER_COLUMNS])
    return dedup_latest(bronze, ["claim_id"], fx.newest_first(), "collapse").select(*RAW_COLUMNS)


@query
def dedup_removed_count(spark, sf):
    """Rows before, after and removed, from one aggregate per claim instead of two counts."""
    per_claim = fx.claims_raw(spark, sf, ["claim_id"]).groupBy("claim_id").agg(
        F.count("*").alias("n"))
    kept = F.when(F.col("claim_id").isNull(), F.col("n")).otherwise(F.lit(1))
    return per_claim.agg(
        F.sum("n").alias("rows_before"), F.sum(kept).alias("rows_after"),
        (F.sum("n") - F.sum(kept)).alias("rows_removed"))


#: Raw columns each rule looks at.
RULE_COLUMNS = {
    "NULL_CLAIM_ID": (),
    "NULL_MEMBER_ID": ("member_id",),
    "INVALID_STATUS": ("claim_status",),
    "NEGATIVE_AMOUNT": ("billed_amount", "paid_amount"),
    "FUTURE_DATE": ("service_date",),
    "NULL_SERVICE_DATE": ("service_date",),
    "PAID_EXCEEDS_BILLED": ("billed_amount", "paid_amount"),
    "INVALID_NPI_LENGTH": ("provider_npi",),
}


def _rule_query(rule: str, columns: tuple[str, ...]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        bronze = fx.claims_raw(spark, sf, ["claim_id", *columns, *ORDER_COLUMNS])
        newest = dedup_latest(bronze, ["claim_id"], fx.newest_first())
        typed = cleaned_columns()
        if "provider_npi" in columns:
            newest = newest.withColumn(
                NPI_LENGTH, F.coalesce(F.length(F.trim("provider_npi")), F.lit(0)))
        newest = newest.withColumns({c: typed[c] for c in columns})
        return newest.filter(rules.claim_rules(fx.AS_OF)[rule]).select("claim_id", *columns)
    return run


for _rule, _columns in RULE_COLUMNS.items():
    QUERIES[f"rule_{_rule.lower()}"] = _rule_query(_rule, _columns)


@query
def rule_counts(spark, sf):
    bronze = fx.claims_raw(spark, sf, [*RAW_COLUMNS, *ORDER_COLUMNS])
    newest = clean(dedup_latest(bronze, ["claim_id"], fx.newest_first()))
    return rules.rule_counts(newest, rules.claim_rules(fx.AS_OF))


@query
def rule_flags_json(spark, sf):
    return _validated(spark, sf).select("claim_id", "member_id", "is_valid", "dq_flags")


@query
def rule_flags_three_valued(spark, sf):
    checked = _validated(spark, sf, rules.THREE_VALUED, "collapse")
    return checked.groupBy("is_valid", "dq_flags").agg(F.count("*").alias("n"))


@query
def validity_rate(spark, sf):
    return rules.validity(_validated(spark, sf))


@query
def quarantine_rows(spark, sf):
    return rules.quarantine_rows(_validated(spark, sf)).select(
        "claim_id", "member_id", "provider_npi", "service_date", "billed_amount", "paid_amount",
        "claim_status", "quarantine_reason")


@query
def lost_rows_reference_policy(spark, sf):
    return (_validated(spark, sf, rules.THREE_VALUED, "collapse").filter("is_valid IS NULL")
            .select("claim_id", "service_date", "claim_status", "provider_npi"))


@query
def silver_claims(spark, sf):
    return _valid(spark, sf).drop("silver_updated_at")


# -- aggregate tables and views ---------------------------------------------------------------

def _kpi(spark, sf, **options):
    """The builder passes over the claims twice, so they are written once, as in a load."""
    claims = tables.staged(_valid(spark, sf).select(*gold.KPI_COLUMNS, "service_date"))
    return gold.daily_kpi(claims, cents=gold.all_in_cents(claims), **options)


@query
def gold_daily_kpi(spark, sf):
    return _kpi(spark, sf).drop("gold_updated_at")


@query
def gold_kpi_by_service_date(spark, sf):
    return _kpi(spark, sf, report_date="service_date").drop("gold_updated_at")


def _joined(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.array_join(column, ","))


@query
def gold_provider_scorecard(spark, sf):
    """The claims are written once, so that the shuffles that made them are gone when theirs are made."""
    claims = tables.staged(_valid(spark, sf).select(*gold.SCORECARD_COLUMNS))
    scored = gold.provider_scorecard(claims, cents=gold.all_in_cents(claims)).drop("gold_updated_at")
    return _joined(scored, "icd10_codes_used")


@query
def gold_member_360(spark, sf):
    return _joined(gold.member_360(_valid(spark, sf)).drop("gold_updated_at"), "network_usage")


@query
def gold_diagnosis_trending(spark, sf):
    return gold.diagnosis_trending(_valid(spark, sf)).drop("gold_updated_at")


@query
def mom_calendar(spark, sf):
    """Growth over the calendar month before. Codes are split by provider, so that pairs of code
    and payer have months without claims."""
    claims = _valid(spark, sf).withColumn(
        "icd10_code", F.concat("icd10_code", F.lit("/"), "provider_npi"))
    return gold.diagnosis_trending(claims, calendar=True).drop("gold_updated_at")


@query
def view_exec_dashboard(spark, sf):
    return views.exec_dashboard(_kpi(spark, sf, report_date="service_date"))


def _extreme(spark, sf) -> DataFrame:
    """Valid claims of which one payer's amounts reach 1e20 and the others' have parts of a millionth."""
    valid = _valid(spark, sf)
    for c in AMOUNT_COLUMNS:
        valid = valid.withColumn(c, F.when(F.col("payer_id") == "PYR001", F.floor(c).cast("double") * 1e16)
                                 .otherwise(F.col(c) + 0.000004))
    return valid


@query
def gold_extreme_amounts(spark, sf):
    """Lifetime amounts when one payer's are far beyond any currency."""
    return gold.member_360(_extreme(spark, sf)).select(
        "member_id", "payer_id", "line_of_business", "lifetime_claims", "lifetime_billed", "lifetime_paid")


@query
def view_extreme_amounts(spark, sf):
    """The dashboard over such amounts."""
    claims = tables.staged(_extreme(spark, sf).select(*gold.KPI_COLUMNS, "service_date"))
    return views.exec_dashboard(gold.daily_kpi(claims, report_date="service_date"))


@query
def view_extreme_tiers(spark, sf):
    """Provider summaries over such amounts, and over claims with next to nothing billed."""
    tiny = F.when(F.col("payer_id") == "PYR002", F.lit(1e-9)).otherwise(F.col("billed_amount"))
    return views.provider_tier_summary(gold.provider_scorecard(_extreme(spark, sf).withColumn("billed_amount", tiny)))


@query
def view_exec_exact_members(spark, sf):
    return views.exec_exact(_valid(spark, sf), "service_date")


@query
def view_exec_sketched(spark, sf):
    """Distinct members and providers united from sketches, beside the exact ones, and whether they are
    within four standard errors and one, and the median within three percent of the ranks."""
    claims = tables.staged(_valid(spark, sf).select(*gold.KPI_COLUMNS, "service_date"))
    approx = views.exec_sketched(gold.kpi_sketches(claims, "service_date"))
    keys = ["report_date", "payer_id", "line_of_business"]
    exact = claims.groupBy(F.col("service_date").alias("report_date"), *keys[1:]).agg(
        F.count_distinct("member_id").alias("unique_members"), F.count_distinct("provider_npi").alias("unique_providers"),
        F.expr("percentile_disc(0.47) WITHIN GROUP (ORDER BY paid_amount)").alias("low"),
        F.expr("percentile_disc(0.53) WITHIN GROUP (ORDER BY paid_amount)").alias("high"))
    off = 4 * 1.04 / 2 ** (gold.SKETCH_BITS / 2)

    def close(column: str) -> F.Column:
        return F.abs(F.col(f"{column}_approx") - F.col(column)) <= F.col(column) * off + 1

    return approx.join(exact, keys).select(
        *keys, "total_claims", "unique_members", "unique_providers",
        close("unique_members").alias("members_close"), close("unique_providers").alias("providers_close"),
        F.coalesce(F.col("median_paid_approx").between(F.col("low"), F.col("high")), F.col("low").isNull()).alias("median_close"))


@query
def cluster_interleaved(spark, sf):
    by = ["payer_id", "service_date", "claim_status", "member_id"]
    return _written(_silver_part(spark, sf), "interleaved", ["service_year", "service_month"],
                    lambda name: tables.cluster(spark, name, by, interleave=True))


@query
def view_provider_tier(spark, sf):
    return views.provider_tier_summary(gold.provider_scorecard(_valid(spark, sf)))


@query
def provider_latest_tier(spark, sf):
    return views.provider_latest_tier(gold.provider_scorecard(_valid(spark, sf)))


@query
def view_high_risk_members(spark, sf):
    return views.high_risk_members(gold.member_360(_valid(spark, sf)))


@query
def view_top50_diagnoses(spark, sf):
    return views.top_diagnoses(gold.diagnosis_trending(_valid(spark, sf)))


# -- table writes -----------------------------------------------------------------------------

def _load(spark, sf, first: bool) -> DataFrame:
    """Valid claims of the load months up to, or after, the cut between the two loads."""
    bronze = fx.claims_raw(spark, sf, [*RAW_COLUMNS, *ORDER_COLUMNS, "ingestion_date"])
    cut = F.lit(FIRST_LOAD).cast("date")
    part = bronze.filter(F.col("ingestion_date") <= cut if first else F.col("ingestion_date") > cut)
    checked = validated_claims(part, fx.AS_OF, order_by=fx.newest_first())
    return silver_rows(checked.drop(*ORDER_COLUMNS), FIRST_LOAD if first else SECOND_LOAD, _run_ts())


def _upsert_loads(spark, sf, name: str, location: str, order: tuple[bool, bool] = (True, False), **options) -> None:
    """The two loads into a table; the rows of one are deleted before the next is made."""
    for first in order:
        rows = tables.staged(_load(spark, sf, first))
        tables.upsert(rows, name, ["claim_id"], ["service_year", "service_month"], location,
                      newer_than="silver_batch_date", **options)
        tables.release(rows)


@query
def upsert_claims(spark, sf):
    """Two loads into one table: claims of the second replace those of the first, some in
    another partition."""
    name, location = _table(spark, "upsert")
    _upsert_loads(spark, sf, name, location)
    return _contents(spark, name, location).drop("silver_updated_at", "ingestion_date")


@query
def upsert_claims_indexed(spark, sf):
    """The two loads with a key index: old copies are looked for only where it says."""
    name, location = _table(spark, "indexed")
    _upsert_loads(spark, sf, name, location, key_buckets=8)
    return _contents(spark, name, location).drop("silver_updated_at", "ingestion_date")


@query
def upsert_claims_old_batch(spark, sf):
    """The loads in the wrong order: newer rows stay, only unknown claims come in."""
    name, location = _table(spark, "upsert")
    _upsert_loads(spark, sf, name, location, (False, True))
    return _contents(spark, name, location).drop("silver_updated_at", "ingestion_date")


@query
def upsert_corrected_batch(spark, sf):
    """Two loads, then the first again without one payer's claims: its old rows go."""
    name, location = _table(spark, "corrected")
    first, second = tables.staged(_load(spark, sf, True)), tables.staged(_load(spark, sf, False))
    for rows, day in ((first, FIRST_LOAD), (second, SECOND_LOAD),
                      (first.filter("payer_id != 'PYR003'"), FIRST_LOAD)):
        tables.upsert(rows, name, ["claim_id"], ["service_year", "service_month"], location,
                      newer_than="silver_batch_date", stale=F.col("silver_batch_date") == F.lit(day).cast("date"))
    return _contents(spark, name, location).drop("silver_updated_at", "ingestion_date")


@query
def upsert_kpi_snapshot(spark, sf):
    """Snapshots of all days of service, refreshed twice."""
    name, location = _table(spark, "snapshot")
    kpi = tables.staged(_kpi(spark, sf, report_date="service_date"))
    for _ in range(2):
        views.refresh_kpi_snapshot(kpi, None, name, location)
    return _contents(spark, name, location).drop("refreshed_at")


@query
def upsert_kpi_all_days(spark, sf):
    """Snapshots of all days of service in one upsert, and one of them once more."""
    name, location = _table(spark, "snapshots")
    kpi = tables.staged(_kpi(spark, sf, report_date="service_date"))
    for day in (None, "2024-03-01"):
        views.refresh_kpi_snapshot(kpi, day, name, location)
    return _contents(spark, name, location).drop("refreshed_at")


def _written(df: DataFrame, label: str, partition_by: list[str], write) -> DataFrame:
    spark = df.sparkSession
    name, location = _table(spark, label)
    tables.create(df, name, partition_by, location)
    write(name)
    return _contents(spark, name, location)


@query
def append_partitioned(spark, sf):
    """Two appends by load month; the second has a column the table did not have."""
    name, location = _table(spark, "append")
    bronze = _bronze(spark, sf).select("claim_id", "member_id", "paid_amount", "batch_id",
                                       "ingestion_date")
    cut = F.lit(FIRST_LOAD).cast("date")
    for part in (bronze.filter(F.col("ingestion_date") <= cut).drop("batch_id"),
                 bronze.filter(F.col("ingestion_date") > cut)):
        tables.append(part, name, ["ingestion_date"], location, rebalance=True)
    return _contents(spark, name, location)


@query
def replace_batches(spark, sf):
    """Every month loaded twice: the second load replaces the first."""
    bronze = _bronze(spark, sf).select("claim_id", "member_id", "paid_amount", "ingestion_date")
    return _written(bronze, "replace", ["ingestion_date"], lambda name: tables.replace_partitions(
        bronze, name, ["ingestion_date"], rebalance=True))


@query
def overwrite_refresh(spark, sf):
    """A full refresh with other columns than before."""
    name, location = _table(spark, "refresh")
    trending = tables.staged(gold.diagnosis_trending(_valid(spark, sf)))
    tables.overwrite(trending.select("icd10_code", "claim_count"), name, location)
    tables.overwrite(trending.drop("gold_updated_at"), name, location)
    return _contents(spark, name, location)


def _silver_part(spark, sf) -> DataFrame:
    return _valid(spark, sf).select(
        "claim_id", "payer_id", "service_date", "claim_status", "member_id", "paid_amount",
        "service_year", "service_month")


@query
def compact(spark, sf):
    return _written(_silver_part(spark, sf), "compact", ["service_year", "service_month"],
                    lambda name: tables.compact(
                        spark, name, [{"service_year": 2024, "service_month": m} for m in range(1, 7)]))


@query
def sized_write(spark, sf):
    """All claims in files of at most 1,000 rows; there have to be several."""
    name, location = _table(spark, "sized")
    tables.create(_silver_part(spark, sf), name, location=location, max_records_per_file=1_000)
    rows = _contents(spark, name, location)
    return rows.withColumn("several_files", F.lit(len(rows.inputFiles()) > 1))


@query
def schema_only_clone(spark, sf):
    """Columns and types of an empty table cloned from the silver rows, and its number of rows."""
    name, location = _table(spark, "clone")
    tables.clone_schema(_silver_part(spark, sf), name, location)
    types, rows = spark.table(name).dtypes, spark.table(name).count()
    spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame([(c, t, rows) for c, t in types], "column string, type string, n_rows bigint")


@query
def cluster_rewrite(spark, sf):
    return _written(
        _silver_part(spark, sf), "cluster", ["service_year", "service_month"],
        lambda name: tables.cluster(
            spark, name, ["payer_id", "service_date", "claim_status", "member_id"]))


# -- checks -----------------------------------------------------------------------------------

def _newest(bronze: DataFrame) -> DataFrame:
    """The claims of ``_validated``, from bronze rows."""
    return validated_claims(bronze.select(*RAW_COLUMNS, *ORDER_COLUMNS), fx.AS_OF, order_by=fx.newest_first())


def _loaded(spark, sf, bronze: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bronze, silver and quarantine of a load where nothing was dropped: every cleaned row is in
    the loaded table, so each check has something to find."""
    bronze = _bronze(spark, sf, fx.AS_OF) if bronze is None else bronze
    cleaned = rules.apply_rules(clean(bronze), rules.claim_rules(fx.AS_OF))
    silver = cleaned.drop("is_corrupt", NPI_LENGTH).withColumn(
        "silver_batch_date", F.lit(fx.AS_OF).cast("date"))
    return bronze, silver, silver.filter("NOT is_valid")


def _measures(spark, sf, loaded: bool, bronze: DataFrame | None = None) -> DataFrame:
    """``bronze`` holds the rows of the load, written once, however many measures read them."""
    bronze, everything, _ = _loaded(spark, sf, tables.staged(_bronze(spark, sf, fx.AS_OF)) if bronze is None else bronze)
    checked = _newest(bronze).drop("ingestion_ts").withColumn(
        "ingestion_date", F.lit(fx.AS_OF).cast("date"))
    if loaded:  # each measure reads them, as it reads tables in a load
        checked = tables.staged(checked)
    valid = silver_rows(checked, fx.AS_OF, _run_ts())
    silver = valid if loaded else everything
    measures = (
        checks.bronze_measures(bronze, fx.AS_OF)
        .unionByName(checks.silver_measures(silver, fx.AS_OF, fx.AS_OF))
        .unionByName(checks.orphan_measures(silver, gold.provider_scorecard(valid), fx.AS_OF))
    )
    if loaded:
        measures = measures.unionByName(checks.quarantine_measures(
            rules.quarantine_rows(checked, _run_ts()), fx.AS_OF))
    return measures


@query
def check_coverage(spark, sf):
    bronze, silver, _ = _loaded(spark, sf)
    return checks.verdict(checks.bronze_measures(bronze, fx.AS_OF).unionByName(
        checks.silver_measures(silver.filter("is_valid"), fx.AS_OF, fx.AS_OF))).select(
        "bronze_count", "bronze_distinct", "silver_count", "silver_coverage_pct",
        "distinct_coverage_pct")


def _silver_check(*columns: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        _, silver, _ = _loaded(spark, sf)
        return checks.verdict(checks.silver_measures(silver, fx.AS_OF, fx.AS_OF)).select(*columns)
    return run


QUERIES["check_validity"] = _silver_check("silver_count", "valid_count", "validity_pct")
QUERIES["check_future"] = _silver_check("silver_count", "future_dates_count")
QUERIES["check_duplicates"] = _silver_check("silver_count", "duplicate_claim_ids")


@query
def check_orphans(spark, sf):
    """Rows of the unfiltered load whose provider has no valid claim."""
    _, silver, _ = _loaded(spark, sf)
    return checks.verdict(checks.orphan_measures(
        silver, gold.provider_scorecard(_valid(spark, sf)), fx.AS_OF)).select(
        "orphan_provider_records")


VERDICT_COLUMNS = ("silver_coverage_pct", "distinct_coverage_pct", "validity_pct",
                   "future_dates_count", "duplicate_claim_ids", "orphan_provider_records",
                   "sla_violations", "overall_status")


@query
def check_verdict(spark, sf):
    return checks.verdict(_measures(spark, sf, loaded=False)).select(*VERDICT_COLUMNS)


@query
def check_verdict_silver(spark, sf):
    return checks.verdict(_measures(spark, sf, loaded=True), "distinct").select(*VERDICT_COLUMNS)


@query
def check_rows(spark, sf):
    return checks.check_rows(checks.verdict(_measures(spark, sf, loaded=False)))


@query
def check_gold_freshness(spark, sf):
    """All check rows of the unfiltered load, with the age of each aggregate table of all claims."""
    bronze = tables.staged(_bronze(spark, sf, fx.AS_OF))
    claims = tables.staged(silver_rows(_newest(bronze).drop(*ORDER_COLUMNS), fx.AS_OF, _run_ts()))
    built = {"gold_daily_claims_kpi": "2024-12-15 05:30:00", "gold_provider_scorecard": "2024-12-15 04:00:00",
             "gold_member_360": "2024-12-14 06:00:00", "gold_diagnosis_trending": RUN_TS}
    ages = checks.freshness(spark, {
        name: gold.BUILDERS[name](claims, run_ts=datetime.fromisoformat(at)) for name, at in built.items()}, _run_ts())
    return checks.check_rows(checks.verdict(_measures(spark, sf, False, bronze)), ages)


@query
def check_freshness(spark, sf):
    """Minutes since the last event of each kind; one table is empty and one is missing."""
    events = fx.load(spark, sf, "events").select(
        "event_type", "value", F.col("ts").cast("timestamp").alias("gold_updated_at"))
    kinds: dict[str, DataFrame | None] = {
        k: events.filter(F.col("event_type") == k)
        for k in ("click", "error", "purchase", "signup", "view")}
    kinds["empty"] = events.filter(F.col("value") < 0)
    kinds["missing"] = None
    return checks.freshness(spark, kinds, _run_ts())


@query
def audit_log(spark, sf):
    """Two runs of the checks appended to the audit table."""
    name, location = _table(spark, "audit")
    bronze = tables.staged(_bronze(spark, sf, fx.AS_OF))
    for loaded, day in ((False, FIRST_LOAD), (True, SECOND_LOAD)):
        judged = checks.verdict(_measures(spark, sf, loaded, bronze), "distinct" if loaded else "rows")
        row = checks.audit_row(judged, day, _run_ts())
        tables.append(row, name, location=location)
    return _contents(spark, name, location).drop("logged_at")


# -- access -----------------------------------------------------------------------------------

@query
def restrict_payer(spark, sf):
    return access.restrict_rows(_kpi(spark, sf), "PYR002").select(
        "payer_id", "claim_status", "line_of_business", "network_flag", "claim_count")


@query
def restrict_admin(spark, sf):
    return access.restrict_rows(_kpi(spark, sf), is_admin=True).select(
        "payer_id", "claim_status", "line_of_business", "network_flag", "claim_count")


@query
def row_access_by_role(spark, sf):
    """What a payer, an administrator and a caller without a payer read through the row function."""
    view, function = f"kpi_{uuid.uuid4().hex}", f"my_kpi_{uuid.uuid4().hex}"
    tables.staged(_kpi(spark, sf)).createOrReplaceTempView(view)
    access.row_function(spark, view, function)
    seen = None
    for role, payer, is_admin in (("payer", "PYR002", False), ("admin", None, True), ("nobody", None, False)):
        access.set_caller(spark, payer, is_admin)
        rows = spark.sql(f"SELECT '{role}' AS role, payer_id, claim_status, line_of_business, network_flag, claim_count FROM {function}()")
        seen = rows if seen is None else seen.unionByName(rows)
    return seen


@query
def mask_ids(spark, sf):
    pattern = _claims(spark, sf, "member_id", "provider_npi")
    hashed = {f"{c}_hash": F.col(c) for c in ("member_id", "provider_npi")}
    return access.mask_columns(
        access.mask_columns(pattern.withColumns(hashed)), list(hashed), "hash", "s")


# -- events -----------------------------------------------------------------------------------

@query
def event_parse(spark, sf):
    parsed = ingest.parse_events(ev.select_envelope(_events(spark, sf)))
    return _event_time_text(parsed.select(*EVENT_COLUMNS))


@query
def event_upsert_latest(spark, sf):
    parsed = ingest.parse_events(ev.select_envelope(_events(spark, sf)))
    return _event_time_text(ingest.latest_events(parsed).select(*EVENT_COLUMNS))


def _event_files(spark, sf) -> str:
    path = scratch_path(spark, "envelopes")
    _events(spark, sf).repartitionByRange(6, "enqueuedTime").write.parquet(path)
    return path


@query
def stream_ingest(spark, sf):
    """The same events through a stream, two files per micro-batch, into a table."""
    name, location = _table(spark, "stream")
    stream = ev.envelope_stream(spark, _event_files(spark, sf), max_files_per_trigger=2)
    ingest.start_ingest(
        ingest.parse_events(ev.select_envelope(stream)), name,
        scratch_path(spark, "stream-state"), location, every=None).awaitTermination()
    return _event_time_text(_contents(spark, name, location).select(*EVENT_COLUMNS))


@query
def compact_stream_table(spark, sf):
    """The real-time table after micro-batches and a compaction."""
    name, location = _table(spark, "stream")
    stream = ev.envelope_stream(spark, _event_files(spark, sf), max_files_per_trigger=3)
    ingest.start_ingest(
        ingest.parse_events(ev.select_envelope(stream)), name,
        scratch_path(spark, "stream-state"), location, every=None).awaitTermination()
    tables.compact(spark, name)
    return _event_time_text(_contents(spark, name, location).select(*EVENT_COLUMNS))


@query
def stream_restart(spark, sf):
    """Half of the events, then the rest by a second run over the same checkpoint, with a timer."""
    name, location = _table(spark, "restart")
    path, state = scratch_path(spark, "envelopes"), scratch_path(spark, "restart-state")
    half = F.col("offset").cast("bigint") % 2
    for part, every in ((0, None), (1, "1 second")):
        _events(spark, sf).filter(half == part).write.mode("append").parquet(path)
        run = ingest.start_ingest(
            ingest.parse_events(ev.select_envelope(ev.envelope_stream(spark, path))), name, state, location, every)
        if every is None:
            run.awaitTermination()
        else:
            run.processAllAvailable()
            run.stop()
    return _event_time_text(_contents(spark, name, location).select(*EVENT_COLUMNS))


@query
def stream_latest_state(spark, sf):
    """Newest event of each claim, from the changes that micro-batches wrote."""
    name, location = _table(spark, "state")
    stream = ev.envelope_stream(spark, _event_files(spark, sf), max_files_per_trigger=2)
    ingest.start_latest_state(
        ingest.parse_events(ev.select_envelope(stream)), name,
        scratch_path(spark, "state-state"), location, every=None).awaitTermination()
    return _event_time_text(ingest.latest_state(spark, name).select(*EVENT_COLUMNS))


def _event_parts(spark, sf, path: str):
    """Adds the events to a folder in two parts, odd ones first."""
    for part in (1, 0):
        _events(spark, sf).filter(F.col("offset").cast("bigint") % 2 == part).write.mode("append").parquet(path)
        yield ev.select_envelope(ev.envelope_stream(spark, path))


@query
def stream_state_compaction(spark, sf):
    """The table of newest events itself, compacted after each of two runs."""
    name, location = _table(spark, "state")
    state = scratch_path(spark, "state-state")
    for envelope in _event_parts(spark, sf, scratch_path(spark, "envelopes")):
        ingest.start_latest_state(ingest.parse_events(envelope), name, state, location, every=None).awaitTermination()
        ingest.compact_latest_state(spark, name)
    return _event_time_text(_contents(spark, name, location).select(*EVENT_COLUMNS))


@query
def stream_resent_events(spark, sf):
    """Every event is sent twice, half of them once more after a restart; each comes once."""
    name, location = _table(spark, "resent")
    path, state = scratch_path(spark, "envelopes"), scratch_path(spark, "resent-state")
    for envelope in _event_parts(spark, sf, path):
        _events(spark, sf).filter(F.col("offset").cast("bigint") % 2 == 1).write.mode("append").parquet(path)
        stream = ingest.drop_resent(ingest.parse_events(envelope))
        ingest.start_ingest(stream, name, state, location, every=None).awaitTermination()
    return _event_time_text(_contents(spark, name, location).select(*EVENT_COLUMNS))


@query
def stream_dead_letters(spark, sf):
    """Where each event went: to the real-time table, or with its body to the dead letters."""
    name, location = _table(spark, "letters")
    stream = ev.envelope_stream(spark, _event_files(spark, sf), max_files_per_trigger=2)
    ingest.start_ingest(ingest.parse_events(ev.select_envelope(stream), bodies=True), name,
                        scratch_path(spark, "letters-state"), location, None, f"{name}_dead").awaitTermination()
    rows = _contents(spark, name, location).select("partition_id", "eh_offset", "claim_id", F.lit(None).cast("string").alias("payload"))
    dead = _contents(spark, f"{name}_dead", location).select("partition_id", "eh_offset", F.lit(None).alias("claim_id"), "payload")
    return rows.unionByName(dead)


# -- files and whole loads --------------------------------------------------------------------

def _write_csv(claims: DataFrame, path: str) -> None:
    """Adds CSV files to a folder, texts as they are."""
    with shuffles_freed(claims.sparkSession):
        claims.write.mode("append").options(header=True, ignoreLeadingWhiteSpace=False,
                             ignoreTrailingWhiteSpace=False).csv(path)


def _with_broken_lines(claims: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sound, short and long lines. Out-of-network voided claims come without their last fields
    and out-of-network adjusted ones with one too many, as broken feeds send them."""
    short = F.col("claim_status").eqNullSafe("voided") & (F.col("network_flag") == "out")
    long = F.col("claim_status").eqNullSafe("Adjusted") & (F.col("network_flag") == "out")
    return (claims.filter(~short & ~long),
            claims.filter(short).drop("line_of_business", "network_flag"),
            claims.filter(long).withColumn("surplus", F.lit("x")))


@query
def csv_roundtrip_corrupt(spark, sf):
    """All claims through CSV files, some of whose lines have too few or too many fields."""
    path = scratch_path(spark, "raw")
    for rows in _with_broken_lines(_claims(spark, sf)):
        _write_csv(rows, path)
    read = src.read_raw(spark, path)
    name, location = _table(spark, "csv")
    tables.replace_partitions(src.add_provenance(read, fx.AS_OF), name, ["ingestion_date"], location)
    return _contents(spark, name, location).select(*RAW_COLUMNS, "is_corrupt", "batch_id")


@query
def run_log(spark, sf):
    """The ingestion log after the files of two batches, with broken lines, were loaded."""
    root = scratch_path(spark, "log")
    cfg = batch.BatchConfig(raw_root=f"{root}/raw", prefix=f"log_{uuid.uuid4().hex}_",
                            root=f"{root}/tables")
    claims = fx.claims_raw(spark, sf, [*RAW_COLUMNS, "ingestion_date"])
    first = F.col("ingestion_date") <= F.lit(FIRST_LOAD).cast("date")
    for day, part in ((FIRST_LOAD, first), (SECOND_LOAD, ~first)):
        for rows in _with_broken_lines(claims.filter(part).drop("ingestion_date")):
            _write_csv(rows, f"{cfg.raw_root}/{day}")
        batch.load_bronze(spark, cfg, day)
    spark.sql(f"DROP TABLE {cfg.name(BRONZE)}")
    log = _contents(spark, cfg.name(BRONZE_LOG), cfg.location(BRONZE_LOG))
    return log.drop("source_path", "logged_at")


@query
def source_files(spark, sf):
    """Rows of the bronze table by the folder their file lay in, after two batches were loaded."""
    root = scratch_path(spark, "files")
    cfg = batch.BatchConfig(raw_root=f"{root}/raw", prefix=f"files_{uuid.uuid4().hex}_", root=f"{root}/tables")
    claims = fx.claims_raw(spark, sf, [*RAW_COLUMNS, "ingestion_date"])
    first = F.col("ingestion_date") <= F.lit(FIRST_LOAD).cast("date")
    for day, part in ((FIRST_LOAD, first), (SECOND_LOAD, ~first)):
        for rows in _with_broken_lines(claims.filter(part).drop("ingestion_date")):
            _write_csv(rows, f"{cfg.raw_root}/{day}")
        batch.load_bronze(spark, cfg, day)
    folder = F.regexp_extract("source_file", r"/raw/([^/]+)/[^/]+\.csv$", 1)
    return spark.table(cfg.name(BRONZE)).groupBy(
        folder.alias("folder"), F.date_format("ingestion_date", "yyyy-MM-dd").alias("batch_date"), "is_corrupt").agg(
        F.count("*").alias("n"))


def _run(spark, sf, repaired: bool = False) -> tuple[list[batch.StageResult], batch.BatchConfig]:
    """Two whole loads. Those of the repaired claims pass their gates; they run on their batch dates. An
    error in a stage is raised: tables that it did not bring up to date are no result."""
    root = scratch_path(spark, "load")
    cfg = batch.BatchConfig(
        raw_root=f"{root}/raw", prefix=f"load_{uuid.uuid4().hex}_", root=f"{root}/tables",
        as_of=fx.AS_OF, order_by=_load_order())
    claims = fx.claims_raw(spark, sf, [*RAW_COLUMNS, "ingestion_date", "tie_part", "tie_supplier"])
    claims = fx.repaired(claims) if repaired else claims
    cut = F.lit(FIRST_LOAD).cast("date")
    results = []
    for day, part in ((FIRST_LOAD, F.col("ingestion_date") <= cut),
                      (SECOND_LOAD, F.col("ingestion_date") > cut)):
        _write_csv(claims.filter(part).select(*RAW_COLUMNS), f"{cfg.raw_root}/{day}")
        at = datetime.fromisoformat(f"{day} 06:00:00") if repaired else None
        results += batch.completed(batch.run_batch(spark, replace(cfg, run_ts=at), day))
        remove_scratch(spark, f"{cfg.raw_root}/{day}")  # its rows are in the bronze table
    return results, cfg


@query
def run_batch_passing(spark, sf):
    """Two whole loads whose checks pass, files to snapshot."""
    results, _ = _run(spark, sf, repaired=True)
    return batch.results_frame(spark, results).filter(~F.col("metric").isin("gold_freshness_mins"))


@query
def kpi_snapshot_after_loads(spark, sf):
    """The snapshots that two passing loads leave, each of the rows its load brought."""
    _, cfg = _run(spark, sf, repaired=True)
    return _contents(spark, cfg.name(KPI_SNAPSHOT), "").drop("refreshed_at")


def _refreshed_gold(spark, sf, table: str) -> DataFrame:
    """An aggregate table after two loads; the second refreshes the months that changed."""
    _, cfg = _run(spark, sf)
    return _contents(spark, cfg.name(table), "").drop("gold_updated_at")


@query
def gold_incremental_scorecard(spark, sf):
    return _joined(_refreshed_gold(spark, sf, SCORECARD), "icd10_codes_used")


@query
def gold_incremental_trending(spark, sf):
    return _refreshed_gold(spark, sf, DIAGNOSIS)


@query
def silver_with_stream(spark, sf):
    """Valid claims of one batch of all line items and all events, some of the same claims."""
    cfg = batch.BatchConfig(
        raw_root="", prefix=f"both_{uuid.uuid4().hex}_", root=scratch_path(spark, "both"), as_of=fx.AS_OF,
        run_ts=datetime.fromisoformat(RUN_TS), with_stream=True, layout=False,
        order_by=(F.desc_nulls_last("tie_part"), F.desc_nulls_last("tie_supplier")))
    tables.create(_bronze(spark, sf, fx.AS_OF), cfg.name(BRONZE), ["ingestion_date"], cfg.location(BRONZE), rebalance=False)
    events = ingest.parse_events(ev.select_envelope(_events(spark, sf, mixed=True)), datetime(2024, 12, 15, 3))
    tables.append(events, cfg.name(BRONZE_STREAM), ["ingestion_date"], cfg.location(BRONZE_STREAM))
    batch.load_silver(spark, cfg, fx.AS_OF)
    rows = _contents(spark, cfg.name(SILVER), cfg.location(SILVER))
    return rows.drop("silver_updated_at", "ingestion_date", "ingestion_ts", "source_file", "tie_part", "tie_supplier")


@query
def silver_late_stream(spark, sf):
    """Two batches, each with half of the line items. A third of the events is in the real-time table
    before the first. A third that was loaded earlier still, but is committed between the batches,
    and a third that is loaded later come with the second."""
    cfg = batch.BatchConfig(
        raw_root="", prefix=f"late_{uuid.uuid4().hex}_", root=scratch_path(spark, "late"), as_of=fx.AS_OF,
        run_ts=datetime.fromisoformat(RUN_TS), with_stream=True, layout=False,
        order_by=(F.desc_nulls_last("tie_part"), F.desc_nulls_last("tie_supplier")))
    cut, table = F.lit(FIRST_LOAD).cast("date"), cfg.name(BRONZE_STREAM)
    day = F.when(F.col("_day") <= cut, cut).otherwise(F.lit(SECOND_LOAD).cast("date"))
    tables.create(_bronze(spark, sf, day), cfg.name(BRONZE), ["ingestion_date"], cfg.location(BRONZE), rebalance=False)

    def commit(part: int, hour: int) -> None:
        path = scratch_path(spark, "late-envelopes")
        _events(spark, sf, mixed=True).filter(F.col("offset").cast("bigint") % 3 == part).write.parquet(path)
        stream = ingest.parse_events(ev.select_envelope(ev.envelope_stream(spark, path)), datetime(2024, 12, 15, hour))
        ingest.start_ingest(stream, table, scratch_path(spark, "late-state"), cfg.location(BRONZE_STREAM), None).awaitTermination()
        remove_scratch(spark, path)  # its events are in the table

    commit(0, 3)
    batch.load_silver(spark, cfg, FIRST_LOAD)
    commit(1, 2)
    commit(2, 5)
    for again in (SECOND_LOAD, FIRST_LOAD):
        batch.load_silver(spark, cfg, again)
    rows = _contents(spark, cfg.name(SILVER), cfg.location(SILVER))
    return rows.drop("silver_updated_at", "ingestion_date", "ingestion_ts", "source_file", "tie_part", "tie_supplier")


@query
def run_batch_summary(spark, sf):
    """Two whole loads, files to verdict. The second load's gate stays shut when validity is
    under its level, and the snapshot is not refreshed."""
    results, cfg = _run(spark, sf)
    for table in spark.catalog.listTables(pattern=f"{cfg.prefix}*"):
        spark.sql(f"DROP TABLE {table.name}")
    return batch.results_frame(spark, results).filter(
        ~F.col("metric").isin("gold_freshness_mins"))
