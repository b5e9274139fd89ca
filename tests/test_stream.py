import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from claimworks.schemas import ENVELOPE
from claimworks.sources.events import envelope_stream, from_kafka, select_envelope
from claimworks.sources.raw import bronze_union
from claimworks.operators import tables
from claimworks.streaming import ingest
from claimworks.streaming.ingest import (
    MICRO_BATCH, commits_of, compact_latest_state, drop_resent, latest_events, latest_state, parse_events, start_ingest,
    start_latest_state,
)

START = datetime(2025, 1, 1)


def body(claim, **fields):
    return json.dumps({"claim_id": claim, "provider_npi": "12345", "service_date": "01/05/2025",
                       "paid_amount": 12.5, "claim_status": " approved", "event_type": "SUBMIT", **fields})


def envelopes(spark, rows):
    return spark.createDataFrame(
        [(START + timedelta(minutes=minute), bytearray(text, "utf-8"), str(i % 2), str(i))
         for i, (minute, text) in enumerate(rows)], ENVELOPE)


def write_files(spark, path, rows):
    for row in rows:
        envelopes(spark, [row]).coalesce(1).write.mode("append").parquet(path)


def test_parse_cleans_and_keeps_the_offset(spark):
    good, bad = parse_events(select_envelope(envelopes(
        spark, [(0, body("C1")), (1, "{broken")]))).orderBy("eh_offset").collect()
    assert (str(good["service_date"]), good["claim_status"], good["provider_npi"]) == (
        "2025-01-05", "APPROVED", "0000012345")
    assert (good["eh_offset"], good["partition_id"], good["event_type"]) == ("0", "0", "SUBMIT")
    assert bad["claim_id"] is None and bad["event_time"] is not None


def test_kafka_columns(spark):
    kafka = spark.sql("SELECT timestamp'2025-01-01' AS timestamp, CAST('{}' AS BINARY) AS value, 3 AS partition, 9L AS offset")
    row = select_envelope(from_kafka(kafka)).first()
    assert (row["payload"], row["partition_id"], row["eh_offset"]) == ("{}", "3", "9")


def test_stream_equals_batch_and_restart_goes_on(spark, tmp_path, new_table):
    name, location = new_table("stream")
    path, state = str(tmp_path / "in"), str(tmp_path / "state")
    write_files(spark, path, [(0, body("C1")), (1, body("C2"))])

    def run():
        stream = parse_events(select_envelope(envelope_stream(spark, path, max_files_per_trigger=1)))
        query = start_ingest(stream, name, state, location, every=None)
        query.awaitTermination(120)
        return query

    first = run()
    assert len([p for p in first.recentProgress if p["numInputRows"]]) == 2  # one file at a time
    write_files(spark, path, [(2, body("C3")), (3, "no json")])
    run()
    run()
    keep = ["claim_id", "service_date", "paid_amount", "event_time", "eh_offset"]
    table = spark.table(name)
    batch = parse_events(select_envelope(spark.read.schema(ENVELOPE).parquet(path)))
    assert sorted(map(str, table.select(keep).collect())) == sorted(map(str, batch.select(keep).collect()))
    assert table.count() == 4
    assert table.select("ingestion_date").distinct().count() == 1


def test_latest_state_never_goes_back(spark, tmp_path, new_table):
    name, location = new_table("state")
    path, state = str(tmp_path / "in"), str(tmp_path / "state")

    def run():
        stream = parse_events(select_envelope(envelope_stream(spark, path, max_files_per_trigger=1)))
        start_latest_state(stream, name, state, location, every=None).awaitTermination(120)
        return {r["claim_id"]: r["event_type"] for r in latest_state(spark, name).collect()}

    write_files(spark, path, [(5, body("C1", event_type="UPDATE")), (1, body("C2")), (0, "no json")])
    assert run() == {"C1": "UPDATE", "C2": "SUBMIT"}
    write_files(spark, path, [(3, body("C1", event_type="LATE")), (9, body("C2", event_type="ADJUDICATE"))])
    assert run() == {"C1": "UPDATE", "C2": "ADJUDICATE"}


def test_latest_events_orders_equal_times_by_number(spark):
    rows = [(0, body("C1", event_type=str(i))) for i in range(12)]
    assert latest_events(parse_events(select_envelope(envelopes(spark, rows)))).first()["event_type"] == "11"


def test_bronze_union_reads_stream_values_back(spark):
    from claimworks.operators.cleaning import clean
    stream = parse_events(select_envelope(envelopes(spark, [(0, body("C1", paid_amount=12345678.9))])))
    batch = spark.createDataFrame([("B1", "$5.00", "2025-01-01", False)],
                                  "claim_id string, paid_amount string, service_date string, is_corrupt boolean")
    both = bronze_union(batch.withColumns({c: F.lit(None).cast("string") for c in (
        "member_id", "provider_npi", "icd10_code", "cpt_code", "billed_amount", "allowed_amount",
        "claim_status", "payer_id", "line_of_business", "network_flag")}), stream)
    rows = {r["claim_id"]: r for r in clean(both).collect()}
    assert rows["B1"]["paid_amount"] == 5.0 and rows["C1"]["paid_amount"] == 12345678.9
    assert str(rows["C1"]["service_date"]) == "2025-01-05"
    assert rows["C1"]["eh_offset"] == "0" and rows["B1"]["eh_offset"] is None


@pytest.mark.parametrize("every", ["1 second"])
def test_processing_time_trigger(spark, tmp_path, new_table, every):
    name, location = new_table("timed")
    path = str(tmp_path / "in")
    write_files(spark, path, [(0, body("C1"))])
    stream = parse_events(select_envelope(envelope_stream(spark, path)))
    query = start_ingest(stream, name, str(tmp_path / "state"), location, every)
    try:
        query.processAllAvailable()
        assert spark.table(name).count() == 1
    finally:
        query.stop()


def test_the_real_time_table_can_be_compacted(spark, tmp_path, new_table):
    name, location = new_table("compact")
    path, state = str(tmp_path / "in"), str(tmp_path / "state")

    def run():
        stream = parse_events(select_envelope(envelope_stream(spark, path, max_files_per_trigger=1)))
        start_ingest(stream, name, state, location, every=None).awaitTermination(120)
        spark.catalog.refreshTable(name)
        return sorted(r["eh_offset"] + (r["claim_id"] or "") for r in spark.table(name).collect())

    write_files(spark, path, [(0, body("C1")), (1, body("C2"))])
    assert run() == ["0C1", "0C2"]
    tables.compact(spark, name)
    write_files(spark, path, [(2, body("C3"))])
    assert run() == ["0C1", "0C2", "0C3"]


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path, new_table):
    name, location = new_table("again")
    rows = parse_events(select_envelope(envelopes(spark, [(0, body("C1")), (1, body("C2"))])), START)
    for batch in ("x-0", "x-1", "x-1"):
        tables.remove_rows(spark, name, F.col(MICRO_BATCH) == batch)
        tables.append(rows.withColumn(MICRO_BATCH, F.lit(batch)), name, ["ingestion_date"], location)
    assert sorted(r[MICRO_BATCH] for r in spark.table(name).collect()) == ["x-0", "x-0", "x-1", "x-1"]


def state_run(spark, path, name, state, location):
    stream = parse_events(select_envelope(envelope_stream(spark, path)))
    start_latest_state(stream, name, state, location, every=None).awaitTermination(120)
    spark.catalog.refreshTable(name)
    return {r["claim_id"]: r["event_type"] for r in latest_state(spark, name).collect()}


def test_a_micro_batch_writes_its_own_claims_only_and_compaction_merges(spark, tmp_path, new_table):
    name, location = new_table("state")
    path, state = str(tmp_path / "in"), str(tmp_path / "state")
    many = [(i, body(f"C{i}")) for i in range(50)]
    envelopes(spark, many).coalesce(1).write.parquet(path)
    want = {f"C{i}": "SUBMIT" for i in range(50)}
    assert state_run(spark, path, name, state, location) == want
    write_files(spark, path, [(90, body("C7", event_type="UPDATE"))])
    want["C7"] = "UPDATE"
    assert state_run(spark, path, name, state, location) == want
    sizes = sorted(r["count"] for r in spark.table(name).groupBy(MICRO_BATCH).count().collect())
    assert sizes == [1, 50]
    compact_latest_state(spark, name)
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == [f"{MICRO_BATCH}=base-0"]
    assert spark.table(name).count() == 50
    write_files(spark, path, [(1, body("C7", event_type="LATE")), (99, body("NEW"))])
    want["NEW"] = "SUBMIT"
    assert state_run(spark, path, name, state, location) == want
    compact_latest_state(spark, name)
    assert {r["claim_id"]: r["event_type"] for r in spark.table(name).collect()} == want


def test_compaction_that_dies_leaves_the_state_as_it_is(spark, tmp_path, new_table, monkeypatch):
    name, location = new_table("state")
    path, state = str(tmp_path / "in"), str(tmp_path / "state")
    for rows in ([(0, body("C1")), (1, body("C2"))], [(2, body("C1", event_type="UPDATE"))]):
        envelopes(spark, rows).coalesce(1).write.mode("append").parquet(path)
        want = state_run(spark, path, name, state, location)
    drop = tables.drop_partition

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "drop_partition", dies)
    with pytest.raises(RuntimeError, match="lost"):
        compact_latest_state(spark, name)
    assert {r["claim_id"]: r["event_type"] for r in latest_state(spark, name).collect()} == want
    monkeypatch.setattr(tables, "drop_partition", drop)
    compact_latest_state(spark, name)
    assert {r["claim_id"]: r["event_type"] for r in spark.table(name).collect()} == want


def test_resent_events_come_once_also_after_a_restart(spark, tmp_path, new_table):
    name, location = new_table("resent")
    path, state = str(tmp_path / "in"), str(tmp_path / "state")

    def run():
        stream = drop_resent(parse_events(select_envelope(envelope_stream(spark, path, max_files_per_trigger=1))))
        start_ingest(stream, name, state, location, every=None).awaitTermination(120)
        spark.catalog.refreshTable(name)
        return sorted((r["claim_id"], r["eh_offset"]) for r in spark.table(name).collect())

    first = [(0, body("C1")), (1, body("C2"))]
    for rows in (first, first):
        envelopes(spark, rows).coalesce(1).write.mode("append").parquet(path)
    assert run() == [("C1", "0"), ("C2", "1")]
    # old events, sent again after a restart, and one that is much older but new
    envelopes(spark, [*first, (-500_000, body("OLD"))]).coalesce(1).write.mode("append").parquet(path)
    assert run() == [("C1", "0"), ("C2", "1"), ("OLD", "2")]


def test_events_without_an_offset_are_told_apart_by_content(spark, tmp_path, new_table):
    name, location = new_table("resent")
    path = str(tmp_path / "in")
    rows = envelopes(spark, [(0, body("C1")), (0, body("C1")), (0, body("C2"))]).withColumn("offset", F.lit(None).cast("string"))
    rows.withColumn("partition", F.lit("0")).coalesce(1).write.parquet(path)
    stream = drop_resent(parse_events(select_envelope(envelope_stream(spark, path))))
    start_ingest(stream, name, str(tmp_path / "state"), location, every=None).awaitTermination(120)
    assert sorted(r["claim_id"] for r in spark.table(name).collect()) == ["C1", "C2"]


def test_bodies_that_are_no_json_object_are_dead_letters(spark, tmp_path, new_table):
    name, location = new_table("letters")
    path, state = str(tmp_path / "in"), str(tmp_path / "state")
    bodies = [body("C1"), "{broken", "[1, 2]", "5", "", body("C2", paid_amount="many"), "{}"]
    envelopes(spark, list(enumerate(bodies))).coalesce(1).write.parquet(path)

    def run():
        stream = parse_events(select_envelope(envelope_stream(spark, path)), bodies=True)
        start_ingest(stream, name, state, location, None, f"{name}_dead").awaitTermination(120)
        return (sorted(r["eh_offset"] for r in spark.table(name).collect()),
                sorted((r["eh_offset"], r["payload"]) for r in spark.table(f"{name}_dead").collect()))

    good, dead = run()
    assert good == ["0", "5", "6"] and dead == [("1", "{broken"), ("2", "[1, 2]"), ("3", "5"), ("4", "")]
    assert "payload" not in spark.table(name).columns
    assert run() == (good, dead)


def ingest_run(spark, path, name, state, location):
    stream = parse_events(select_envelope(envelope_stream(spark, path, max_files_per_trigger=1)))
    start_ingest(stream, name, state, location, every=None).awaitTermination(120)
    spark.catalog.refreshTable(name)
    return sorted(r["claim_id"] for r in spark.table(name).collect())


def test_only_the_first_micro_batch_of_a_run_looks_for_its_rows(spark, tmp_path, new_table, monkeypatch):
    name, location = new_table("looked")
    path, state, tests = str(tmp_path / "in"), str(tmp_path / "state"), []
    remove = tables.remove_rows
    monkeypatch.setattr(tables, "remove_rows", lambda s, t, test: tests.append(test) or remove(s, t, test))
    write_files(spark, path, [(0, body("C1")), (1, body("C2")), (2, body("C3"))])
    assert ingest_run(spark, path, name, state, location) == ["C1", "C2", "C3"]
    assert len(tests) == 1
    write_files(spark, path, [(0, body("C4"))])
    assert ingest_run(spark, path, name, state, location) == ["C1", "C2", "C3", "C4"]
    assert len(tests) == 2
    plan = spark.table(name).filter(tests[1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan and "ingestion_date#" in plan


def test_a_micro_batch_that_failed_after_its_rows_or_its_commit_comes_once(spark, tmp_path, new_table, monkeypatch):
    name, location = new_table("failed")
    path, state = str(tmp_path / "in"), str(tmp_path / "state")
    write_files(spark, path, [(0, body("C1")), (1, body("C2"))])
    append, seen = tables.append, []

    def dies(when):
        def run(df, table, *args, **kwargs):
            if when == "before the commit" and table == commits_of(name) and len(seen) == 1:
                raise RuntimeError("lost")
            append(df, table, *args, **kwargs)
            if table == commits_of(name):
                seen.append(table)
                if when == "after it" and len(seen) == 2:
                    raise RuntimeError("lost")
        return run

    for when in ("before the commit", "after it"):
        monkeypatch.setattr(tables, "append", dies(when))
        with pytest.raises(Exception, match="lost"):
            ingest_run(spark, path, name, state, location)
    monkeypatch.setattr(tables, "append", append)
    assert ingest_run(spark, path, name, state, location) == ["C1", "C2"]
    assert spark.table(commits_of(name)).select(MICRO_BATCH).distinct().count() == 2
    assert ingest.MICRO_BATCH in spark.table(name).columns
