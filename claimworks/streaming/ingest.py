"""Claim events: parse, clean with the batch functions, append to a table, keep latest states.

The chain from source to table is stateless and has no shuffle; its rate is set by the source
(``maxFilesPerTrigger`` or ``maxOffsetsPerTrigger``) and by the trigger. Micro-batches go into an
ordinary partitioned table, so compaction and batch loads treat it like any other. A micro-batch
whose rows are all in the table gets a row in the table of commits, by which a batch load takes it.
"""

from __future__ import annotations

import hashlib
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimworks.functions import norm_code, pad_npi, parse_date
from claimworks.operators import tables
from claimworks.operators.dedup import dedup_latest
from claimworks.schemas import EVENT, STREAM_COMMITS

#: Column that names the micro-batch a row of the real-time table came in.
MICRO_BATCH = "micro_batch"
#: Name of the compacted partition of a state table, before its number.
BASE = "base-"


def parse_events(envelope: DataFrame, ingestion_ts: datetime | None = None, bodies: bool = False) -> DataFrame:
    """JSON bodies as typed, cleaned columns; a body that is no JSON gives NULL fields.

    Works on streams and on tables alike. The offset stays, so that events can be told apart, and so
    does the identifier as it was sent: after padding its length says nothing, and the row rules of
    a batch test the length. ``bodies`` keeps the text of the body and whether it is a JSON object,
    for ``start_ingest(dead_letters=...)``.
    """
    now = F.current_timestamp() if ingestion_ts is None else F.lit(ingestion_ts)
    kept = [F.col("payload"), F.json_object_keys("payload").isNotNull().alias("is_json")] if bodies else []
    fields = envelope.withColumn("data", F.from_json("payload", EVENT)).select(
        "data.*", "event_time", "partition_id", "eh_offset",
        now.alias("ingestion_ts"), F.to_date(now).alias("ingestion_date"), *kept,
    )
    return fields.withColumns({
        "service_date": parse_date("service_date"),
        "claim_status": norm_code("claim_status"),
        "provider_npi": pad_npi("provider_npi"),
        "provider_npi_text": F.trim("provider_npi"),
    })


def drop_resent(parsed: DataFrame, within: str = "24 hours") -> DataFrame:
    """Events a sender repeats, by partition and offset, come once; restarts remember them.

    The watermark is on the load time, which never goes back, so no event is ever too late and
    dropped: one that is repeated more than ``within`` after it was first loaded comes again.
    Events without an offset are told apart by what they say.
    """
    said = [c for c in parsed.columns if c not in ("ingestion_ts", "ingestion_date")]
    same = F.when(F.col("eh_offset").isNull(), F.xxhash64(*said))
    return (parsed.withColumn("_same", same).withWatermark("ingestion_ts", within)
            .dropDuplicatesWithinWatermark(["partition_id", "eh_offset", "_same"]).drop("_same"))


def commits_of(table: str) -> str:
    """Name of the table of commits of a real-time table."""
    return f"{table}_commits"


def start_ingest(
    parsed: DataFrame,
    table: str,
    checkpoint: str,
    location: str | None = None,
    every: str | None = "10 seconds",
    dead_letters: str | None = None,
) -> StreamingQuery:
    """Append to a table partitioned by load date; ``every=None`` takes what is there and stops.

    The checkpoint makes a restart go on where the last run ended. Rows carry the name of their
    micro-batch. Only the first micro-batch of a run can be the repetition of one that failed: it
    is left out if it was committed, and what it had written without a commit is replaced, which
    is looked for from the last committed load date on. Later ones read nothing of the table.
    ``dead_letters`` names a table that takes events whose body is no JSON object, with the body,
    in the same micro-batch; the table itself does not get them then.
    """
    stream, checked = _stream_name(checkpoint), []

    def write(rows: DataFrame, batch_id: int) -> None:
        spark, name = rows.sparkSession, f"{stream}-{batch_id}"
        if rows.isEmpty() and tables.table_exists(spark, table):
            return
        first = not checked
        checked.append(name)
        if first and not _cleared(spark, [table, *([dead_letters] if dead_letters else [])], stream, name):
            return
        rows = rows.withColumn(MICRO_BATCH, F.lit(name))
        if dead_letters:
            broken = rows.filter(~F.col("is_json")).select(
                "event_time", "partition_id", "eh_offset", "payload", "ingestion_ts", "ingestion_date", MICRO_BATCH)
            tables.append(broken, dead_letters, ["ingestion_date"], f"{location}_dead_letters" if location else None)
            rows = rows.filter("is_json").drop("is_json", "payload")
        days = Observation()
        seen = rows.observe(days, F.min("ingestion_date").alias("first"), F.max("ingestion_date").alias("last"))
        tables.append(seen, table, ["ingestion_date"], location)
        row = [(name, days.get["first"], days.get["last"], datetime.now())]
        tables.append(spark.createDataFrame(row, STREAM_COMMITS).coalesce(1), commits_of(table),
                      location=f"{location}_commits" if location else None)

    return _start(parsed, write, checkpoint, every)


def _stream_name(checkpoint: str) -> str:
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


def _cleared(spark: SparkSession, names: list[str], stream: str, name: str) -> bool:
    """Whether a micro-batch is still to be written; rows it wrote without a commit are removed."""
    since = None
    if tables.table_exists(spark, commits_of(names[0])):
        spark.catalog.refreshTable(commits_of(names[0]))
        own = spark.table(commits_of(names[0])).filter(F.col(MICRO_BATCH).startswith(f"{stream}-"))
        found = own.agg(F.max("last_date").alias("since"), F.count_if(F.col(MICRO_BATCH) == name).alias("n")).first()
        if found["n"]:
            return False
        since = found["since"]
    for table in names:
        tables.remove_rows(spark, table, _rows_of(name, since))
    return True


def _rows_of(name: str, since: date | None) -> Column:
    test = F.col(MICRO_BATCH) == name
    return test if since is None else test & (F.col("ingestion_date") >= F.lit(since))


def _start(rows: DataFrame, write, checkpoint: str, every: str | None, mode: str = "append") -> StreamingQuery:
    writer = rows.writeStream.option("checkpointLocation", checkpoint).outputMode(mode).foreachBatch(write)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def latest_events(events: DataFrame) -> DataFrame:
    """Newest event of each claim, by event time, then offset; events without an id are left to
    the raw table."""
    return dedup_latest(
        events.filter(F.col("claim_id").isNotNull()), ["claim_id"],
        [F.col("event_time").desc(), F.col("eh_offset").try_cast("bigint").desc_nulls_last()],
        null_keys="collapse",
    )


def start_latest_state(
    parsed: DataFrame,
    table: str,
    checkpoint: str,
    location: str | None = None,
    every: str | None = "10 seconds",
) -> StreamingQuery:
    """Keep the newest event of each claim: in the state of the stream, and in a table of changes.

    A micro-batch writes one row for each of its claims into a partition of its own, whatever the
    size of the state, and one that runs again replaces its own partition. ``latest_state`` merges
    on reading, ``compact_latest_state`` is to be run now and then. The state holds one row per
    claim; for many claims give the session the RocksDB state store.
    """
    stream = _stream_name(checkpoint)

    def write(rows: DataFrame, batch_id: int) -> None:
        named = rows.withColumn(MICRO_BATCH, F.lit(f"{stream}-{batch_id}"))
        if not tables.table_exists(rows.sparkSession, table) or not rows.isEmpty():
            tables.replace_partitions(named, table, [MICRO_BATCH], location)

    claims = parsed.filter(F.col("claim_id").isNotNull())
    rest = [c for c in claims.columns if c != "claim_id"]
    age = F.struct("event_time", F.col("eh_offset").try_cast("bigint").alias("number"), F.xxhash64(*sorted(rest)).alias("tie"))
    newest = claims.groupBy("claim_id").agg(F.max_by(F.struct(*rest), age).alias("event")).select("claim_id", "event.*")
    return _start(newest, write, checkpoint, every, "update")


def latest_state(spark: SparkSession, table: str) -> DataFrame:
    """The newest event of each claim from a table of changes."""
    spark.catalog.refreshTable(table)
    return latest_events(spark.table(table).drop(MICRO_BATCH))


def compact_latest_state(spark: SparkSession, table: str) -> None:
    """One row per claim in a new partition, then the partitions it was made of are dropped.

    A stream may go on writing meanwhile: its new partitions are left alone. Between the two steps,
    or after a crash there, some rows are in the table twice, which reading merges.
    """
    spark.catalog.refreshTable(table)
    old = [row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    if len(old) > 1:
        number = 1 + max([int(n.removeprefix(BASE)) for n in old if n.startswith(BASE)], default=-1)
        rows = latest_events(spark.table(table).filter(F.col(MICRO_BATCH).isin(old)).drop(MICRO_BATCH))
        tables.append(rows.withColumn(MICRO_BATCH, F.lit(f"{BASE}{number}")), table, [MICRO_BATCH])
        for name in old:
            tables.drop_partition(spark, table, {MICRO_BATCH: name})
