"""The daily load: bronze, silver, gold, checks and snapshot, each gated by the one before."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks import constants as C
from claimworks import schemas
from claimworks.operators import checks, tables
from claimworks.operators.rules import NULL_SAFE, quarantine_rows, validity
from claimworks.plans.gold import (
    all_in_cents, daily_kpi, diagnosis_growth, diagnosis_monthly, member_360, provider_scorecard,
)
from claimworks.plans.silver import silver_rows, validated_claims
from claimworks.plans.views import refresh_kpi_snapshot
from claimworks.session import shuffles_freed
from claimworks.sources.raw import add_provenance, bronze_union, read_batch, read_raw
from claimworks.streaming.ingest import commits_of

_SILVER_PARTITIONS = ("service_year", "service_month")
_STREAM_ONLY = ("event_time", "partition_id", "eh_offset", "event_type", "submission_ts", "micro_batch")
_CLUSTER_BY = ("payer_id", "service_date", "claim_status", "member_id")


@dataclass(frozen=True)
class BatchConfig:
    """Where a load reads and writes, and what it may leave to defaults.

    ``raw_root`` has one folder per batch date. ``prefix`` goes before every table name, for
    example ``"claims."`` for a database. With ``root`` tables are external, one folder each.
    ``with_stream`` adds the rows of the event table that no batch has taken yet; a batch that runs
    again takes the same rows. Loads with it run one after the other. Of the copies of a claim the last
    loaded wins, then the newest event, then the first by ``order_by``, then by file.
    ``key_buckets`` is the number of parts of the index of silver keys: one for some ten million claims;
    0 does without and looks through the keys of all claims. ``coverage="distinct"`` judges coverage by distinct claims, so that dropped copies are no loss;
    ``"rows"`` counts them as one. Tables are compacted and silver is clustered unless ``layout``
    is off.
    """

    raw_root: str
    prefix: str = ""
    root: str | None = None
    as_of: str | None = None
    run_ts: datetime | None = None
    policy: str = NULL_SAFE
    coverage: str = "distinct"
    report_date: str = "silver_updated_at"
    layout: bool = True
    order_by: tuple[Column | str, ...] = ()
    key_buckets: int = 16
    with_stream: bool = False

    def name(self, table: str) -> str:
        return f"{self.prefix}{table}"

    def location(self, table: str) -> str | None:
        return f"{self.root.rstrip('/')}/{table}" if self.root else None


@dataclass(frozen=True)
class StageResult:
    """Outcome of a stage. ``error`` is what a stage raised that did not come to an outcome."""

    stage: str
    status: str
    metrics: dict = field(default_factory=dict)
    error: Exception | None = field(default=None, compare=False, repr=False)


class LoadError(RuntimeError):
    """A stage of a load raised, so tables hold what earlier stages and loads left."""


def load_bronze(spark: SparkSession, cfg: BatchConfig, batch_date: str) -> StageResult:
    """Raw files to one partition; loading a date again replaces it.

    Rows are counted in the written partition, where the count comes from file metadata and one
    small column. Counting during the write would count rows twice when a lost task runs again.
    """
    path = f"{cfg.raw_root.rstrip('/')}/{batch_date}/"
    name = cfg.name(C.BRONZE)
    rows = add_provenance(read_raw(spark, path), batch_date, cfg.run_ts)
    if tables.table_exists(spark, name) and rows.isEmpty():
        tables.drop_partition(spark, name, {"ingestion_date": batch_date})  # no row names it
    else:
        tables.replace_partitions(rows, name, ["ingestion_date"], cfg.location(C.BRONZE))
    day = F.lit(batch_date).cast("date")
    counted = spark.table(name).filter(F.col("ingestion_date") == day).agg(
        F.count("*").alias("records_ingested"),
        F.count_if("is_corrupt").alias("corrupt_records")).first().asDict()
    log = spark.createDataFrame(
        [(batch_date, counted["records_ingested"], counted["corrupt_records"], path, "SUCCESS",
          cfg.run_ts or datetime.now())], schemas.INGESTION_LOG)
    tables.append(log, cfg.name(C.BRONZE_LOG), location=cfg.location(C.BRONZE_LOG))
    loaded = {"ingestion_date": date.fromisoformat(batch_date)}
    if cfg.layout and counted["records_ingested"] and tables.has_small_files(spark, name, loaded):
        tables.compact(spark, name, [loaded])
    return StageResult("bronze", "SUCCESS", {"batch_date": batch_date, **counted})


def load_silver(spark: SparkSession, cfg: BatchConfig, batch_date: str) -> StageResult:
    """Clean, drop duplicates, apply the rules, quarantine and upsert.

    The checked rows are written to the shared folder once; the counts, the quarantine and the
    upsert all read that copy.
    """
    bronze = read_batch(spark.table(cfg.name(C.BRONZE)), batch_date)
    order = [F.col("ingestion_ts").desc_nulls_last(), *cfg.order_by, F.col("source_file").desc_nulls_last()]
    if cfg.with_stream:
        bronze = bronze_union(bronze, stream_rows(spark, cfg, batch_date))
        order[1:1] = [F.col("event_time").desc_nulls_last(), F.col("eh_offset").try_cast("bigint").desc_nulls_last()]
    checked = tables.staged(validated_claims(
        bronze, cfg.as_of, cfg.policy, order_by=order).drop(*_STREAM_ONLY).withColumn(
            "ingestion_date", F.lit(batch_date).cast("date")))
    counts = validity(checked).first().asDict()
    status = counts.pop("status")

    quarantine = cfg.name(C.QUARANTINE)
    if counts["invalid"]:
        tables.replace_partitions(quarantine_rows(checked, cfg.run_ts), quarantine,
                                  ["ingestion_date"], cfg.location(C.QUARANTINE))
    elif tables.table_exists(spark, quarantine):
        tables.drop_partition(spark, quarantine, {"ingestion_date": batch_date})

    valid = silver_rows(checked, batch_date, cfg.run_ts or datetime.now())  # one time, however often it is read
    tables.upsert(
        valid, cfg.name(C.SILVER), ["claim_id"], _SILVER_PARTITIONS, cfg.location(C.SILVER),
        newer_than="silver_batch_date", unique=True,
        stale=F.col("silver_batch_date") == F.lit(batch_date).cast("date"),
        cluster_by=_CLUSTER_BY if cfg.layout else (),
        announce=lambda months: _announce(spark, cfg, batch_date, months), key_buckets=cfg.key_buckets)
    removed = bronze.count() - counts["total"]
    tables.release(checked)
    return StageResult("silver", status, {"batch_date": batch_date, **counts, "dupes_removed": removed})


def stream_rows(spark: SparkSession, cfg: BatchConfig, batch_date: str) -> DataFrame:
    """Rows of the real-time table for this batch: of all micro-batches that no batch has taken.

    What a batch takes is written down first, by name and not by time, so a micro-batch that is
    committed late comes with the next batch, and a batch that runs again takes its own once more.
    """
    log, at = cfg.name(C.STREAM_LOG), cfg.run_ts or datetime.now()
    stream = _refreshed(spark, cfg.name(C.BRONZE_STREAM))
    known = _committed(spark, cfg, stream)
    taken = _refreshed(spark, log) if tables.table_exists(spark, log) else spark.createDataFrame([], schemas.STREAM_LOG)
    if taken.filter(F.col("batch_date") == batch_date).isEmpty():
        free = known.filter(F.col("committed_at") <= F.lit(at)).join(taken, "micro_batch", "left_anti")
        mark = spark.range(1).select(F.lit(None).cast("string").alias("micro_batch"))
        rows = tables.staged(free.select("micro_batch").unionByName(mark).select(
            F.lit(batch_date).alias("batch_date"), "micro_batch", F.lit(at).alias("taken_at")))
        tables.append(rows.coalesce(1), log, location=cfg.location(C.STREAM_LOG))
        tables.release(rows)
        taken = _refreshed(spark, log)
    own = taken.filter((F.col("batch_date") == batch_date) & F.col("micro_batch").isNotNull()).select("micro_batch").distinct()
    spans = known.join(own, "micro_batch", "left_semi")
    days = spans.select(F.explode(F.sequence("first_date", "last_date")).alias("ingestion_date")).distinct().collect()
    held = stream.filter(tables.in_partitions(["ingestion_date"], days)).withColumn("micro_batch", _unit(stream))
    return held.join(own, "micro_batch", "left_semi")


def _refreshed(spark: SparkSession, name: str) -> DataFrame:
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _unit(stream: DataFrame) -> Column:
    """Micro-batch of a row; rows that no stream wrote belong together by load time."""
    loaded = F.concat(F.lit("loaded-"), F.unix_micros("ingestion_ts").cast("string"))
    return F.coalesce(F.col("micro_batch"), loaded) if "micro_batch" in stream.columns else loaded


def _committed(spark: SparkSession, cfg: BatchConfig, stream: DataFrame) -> DataFrame:
    """Name, load dates and commit time of what is in the real-time table. With the stream's table of
    commits nothing else is read; a table that was filled otherwise is looked through, two narrow
    columns of it, and its load times stand for commits."""
    name = commits_of(cfg.name(C.BRONZE_STREAM))
    if tables.table_exists(spark, name):
        long_ago = F.lit("0001-01-01").cast("timestamp")  # it is committed, whenever the run says it is
        return _refreshed(spark, name).groupBy("micro_batch").agg(
            F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date")).withColumn("committed_at", long_ago)
    return stream.groupBy(_unit(stream).alias("micro_batch")).agg(
        F.min("ingestion_date").alias("first_date"), F.max("ingestion_date").alias("last_date"),
        F.max("ingestion_ts").alias("committed_at"))


def load_gold(spark: SparkSession, cfg: BatchConfig, batch_date: str) -> StageResult:
    """Bring the aggregate tables up to date with all valid claims.

    Tables by month of service are computed for the months that changed since they were last; each
    of them from all claims of the month. Growth is worked out from the monthly table, since any
    later month may come after a changed one. The others are rebuilt.
    """
    claims = _refreshed(spark, cfg.name(C.SILVER)).filter("is_valid")
    changes = _pending_changes(spark, cfg)
    months = [row.asDict() for row in changes.select(*_SILVER_PARTITIONS).distinct().collect()]
    cents = all_in_cents(claims)

    def scorecard() -> None:
        _refresh_months(spark, cfg, claims, C.SCORECARD, months,
                        lambda df: provider_scorecard(df, run_ts=cfg.run_ts, cents=cents))

    def diagnosis() -> None:
        _refresh_months(spark, cfg, claims, C.DIAGNOSIS_MONTHLY, months, lambda df: diagnosis_monthly(df, cents))
        rebuild(C.DIAGNOSIS, diagnosis_growth(_refreshed(spark, cfg.name(C.DIAGNOSIS_MONTHLY)), run_ts=cfg.run_ts))

    def rebuild(table: str, rows: DataFrame) -> None:
        tables.overwrite(rows.hint("rebalance"), cfg.name(table), cfg.location(table))

    # None reads another's table, so the last tasks of one need not be waited for by the next.
    _at_once(spark, scorecard, diagnosis,
             lambda: rebuild(C.MEMBER_360, member_360(claims, run_ts=cfg.run_ts, cents=cents)),
             lambda: rebuild(C.DAILY_KPI, daily_kpi(claims, cfg.report_date, run_ts=cfg.run_ts, cents=cents)))
    done = changes.select("change_id").distinct().withColumn("refreshed_at", F.lit(cfg.run_ts or datetime.now()))
    tables.append(tables.local_copy(done), cfg.name(C.GOLD_LOG), location=cfg.location(C.GOLD_LOG))
    counts = {table: spark.table(cfg.name(table)).count() for table in C.GOLD_TABLES}
    return StageResult("gold", "SUCCESS", {"batch_date": batch_date, **counts})


def _at_once(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Run independent writes side by side; all have ended when the first error is raised."""
    with shuffles_freed(spark), ThreadPoolExecutor(len(writes)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
    for write in started:
        write.result()


def _refresh_months(spark: SparkSession, cfg: BatchConfig, claims: DataFrame, table: str, months: list[dict], build) -> None:
    name = cfg.name(table)
    if not tables.table_exists(spark, name):
        tables.create(build(claims), name, _SILVER_PARTITIONS, cfg.location(table))
    elif months:
        changed = build(claims.filter(tables.in_partitions(list(_SILVER_PARTITIONS), months)))
        tables.replace_partitions(changed, name, _SILVER_PARTITIONS, rebalance=True, emptied=months)


def _announce(spark: SparkSession, cfg: BatchConfig, batch_date: str, months: list[dict]) -> None:
    """Write down which months are about to change, so that none is forgotten after a crash."""
    if months:
        change, at = uuid.uuid4().hex, cfg.run_ts or datetime.now()
        rows = [(change, batch_date, m["service_year"], m["service_month"], at) for m in months]
        tables.append(spark.createDataFrame(rows, schemas.SILVER_CHANGES).coalesce(1), cfg.name(C.SILVER_CHANGES),
                      location=cfg.location(C.SILVER_CHANGES))


def _pending_changes(spark: SparkSession, cfg: BatchConfig) -> DataFrame:
    """Changes of the silver table that the aggregate tables have not seen."""
    if not tables.table_exists(spark, cfg.name(C.SILVER_CHANGES)):
        return spark.createDataFrame([], schemas.SILVER_CHANGES)
    changes = _refreshed(spark, cfg.name(C.SILVER_CHANGES))
    if not tables.table_exists(spark, cfg.name(C.GOLD_LOG)):
        return changes
    return changes.join(_refreshed(spark, cfg.name(C.GOLD_LOG)), "change_id", "left_anti")


def batch_verdict(spark: SparkSession, cfg: BatchConfig, batch_date: str) -> DataFrame:
    """The one-row verdict on a loaded batch."""
    silver = spark.table(cfg.name(C.SILVER))
    measures = (
        checks.bronze_measures(spark.table(cfg.name(C.BRONZE)), batch_date)
        .unionByName(checks.silver_measures(silver, batch_date, cfg.as_of))
        .unionByName(checks.orphan_measures(silver, spark.table(cfg.name(C.SCORECARD)), batch_date))
    )
    if tables.table_exists(spark, cfg.name(C.QUARANTINE)):
        measures = measures.unionByName(
            checks.quarantine_measures(spark.table(cfg.name(C.QUARANTINE)), batch_date))
    return checks.verdict(measures, cfg.coverage)


def run_checks(spark: SparkSession, cfg: BatchConfig, batch_date: str) -> StageResult:
    """Measure, judge and keep an audit row."""
    judged = tables.staged(batch_verdict(spark, cfg, batch_date))
    tables.append(checks.audit_row(judged, batch_date, cfg.run_ts), cfg.name(C.CHECK_LOG),
                  location=cfg.location(C.CHECK_LOG))
    figures = judged.first().asDict()
    names = [cfg.name(t) for t in C.GOLD_TABLES]
    ages = checks.freshness(spark, checks.open_tables(spark, names), cfg.run_ts).collect()
    tables.release(judged)
    figures["gold_freshness_mins"] = {row["table_name"]: row["age_minutes"] for row in ages}
    return StageResult("checks", figures.pop("overall_status"), {"batch_date": batch_date, **figures})


def refresh_snapshot(spark: SparkSession, cfg: BatchConfig, batch_date: str) -> StageResult:
    rows = refresh_kpi_snapshot(
        spark.table(cfg.name(C.DAILY_KPI)), batch_date, cfg.name(C.KPI_SNAPSHOT),
        cfg.location(C.KPI_SNAPSHOT), cfg.run_ts)
    return StageResult("snapshot", "SUCCESS", {"batch_date": batch_date, "rows_affected": rows})


#: Stages in order, with the outcomes after which the next one may run. Low validity is a
#: warning of the silver stage and does not stop the load; the checks judge it.
STAGES = (
    (load_bronze, ("SUCCESS",)),
    (load_silver, ("SUCCESS", "DQ_WARNING")),
    (load_gold, ("SUCCESS",)),
    (run_checks, ("PASS",)),
    (refresh_snapshot, ("SUCCESS",)),
)


def run_batch(spark: SparkSession, cfg: BatchConfig, batch_date: str) -> list[StageResult]:
    """Run the stages up to the first one whose gate stays shut; an error is such an outcome, for
    the caller to look at or to raise (``completed``) before it reads a table of the load."""
    results = []
    for stage, passing in STAGES:
        try:
            result = stage(spark, cfg, batch_date)
        except Exception as error:  # noqa: BLE001 - recorded, and the load stops here
            result = StageResult(stage.__name__, "FAILED",
                                 {"batch_date": batch_date, "error": f"{type(error).__name__}: {error}"}, error)
        results.append(result)
        if result.status not in passing:
            break
    return results


def completed(results: list[StageResult]) -> list[StageResult]:
    """The results of a load none of whose stages raised; the error of one that did is raised.
    A gate that stays shut is an outcome of the data and no error."""
    for result in results:
        if result.status == "FAILED":
            raise LoadError(f"{result.stage} of {result.metrics.get('batch_date')} failed: "
                            f"{result.metrics.get('error')}") from result.error
    return results


def results_frame(spark: SparkSession, results: list[StageResult]) -> DataFrame:
    """The results of one run, one row per stage and figure."""
    rows = [(i, r.stage, r.status, key, str(value))
            for i, r in enumerate(results) for key, value in r.metrics.items()]
    return spark.createDataFrame(
        rows, "step int, stage string, status string, metric string, value string")
