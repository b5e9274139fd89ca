from datetime import datetime

import pytest

from claims import AS_OF, RAW
from claimworks import constants as C
from claimworks.constants import RAW_COLUMNS
from claimworks.plans import batch
from claimworks.schemas import RAW as RAW_SCHEMA


def config(tmp_path, new_table, **options):
    prefix, _ = new_table("b")
    return batch.BatchConfig(raw_root=str(tmp_path / "raw"), prefix=f"{prefix}_",
                             root=str(tmp_path / "tables"), as_of=AS_OF, **options)


def write_raw(spark, cfg, day, rows, extra_lines=()):
    spark.createDataFrame(rows, RAW_SCHEMA).coalesce(1).write.mode("overwrite").csv(
        f"{cfg.raw_root}/{day}", header=True)
    if extra_lines:
        with open(f"{cfg.raw_root}/{day}/extra.csv", "w") as f:
            f.write("\n".join([",".join(RAW_COLUMNS), *extra_lines]) + "\n")


def good(i, **fields):
    values = dict(zip(RAW_COLUMNS, RAW[0])) | {"claim_id": f"G{i:03}"} | fields
    return tuple(values[n] for n in RAW_COLUMNS)


def stages(results):
    return {r.stage: r for r in results}


def test_whole_load(spark, tmp_path, new_table):
    now = datetime.now().replace(microsecond=0)
    day = now.date().isoformat()
    cfg = config(tmp_path, new_table, run_ts=now)
    write_raw(spark, cfg, day, [good(i) for i in range(40)] + [good(0)] + [good(99, member_id=None)],
              ["SHORT,MBR", ",".join(["LONG"] + ["x"] * 20)])
    got = stages(batch.run_batch(spark, cfg, day))
    assert {s: r.status for s, r in got.items()} == {
        "bronze": "SUCCESS", "silver": "SUCCESS", "gold": "SUCCESS", "checks": "PASS", "snapshot": "SUCCESS"}
    assert (got["bronze"].metrics["records_ingested"], got["bronze"].metrics["corrupt_records"]) == (44, 2)
    silver = got["silver"].metrics
    assert (silver["total"], silver["valid"], silver["invalid"], silver["dupes_removed"]) == (41, 40, 1, 1)
    assert got["gold"].metrics[C.MEMBER_360] == 1
    assert got["checks"].metrics["silver_coverage_pct"] == 95.24
    assert set(got["checks"].metrics["gold_freshness_mins"].values()) == {0.0}
    assert got["snapshot"].metrics["rows_affected"] == 1
    snapshot = spark.table(cfg.name(C.KPI_SNAPSHOT)).first()
    assert (snapshot["payer_id"], snapshot["total_claims"], snapshot["total_paid"]) == ("NORTH", 40, 60000.0)
    bronze = spark.table(cfg.name(C.BRONZE))
    assert bronze.filter("source_file LIKE '%extra.csv' AND is_corrupt").count() == 2
    assert bronze.first()["batch_id"] == "batch_" + day.replace("-", "")
    log = spark.table(cfg.name(C.BRONZE_LOG)).first()
    assert (log["status"], log["records_ingested"], log["logged_at"]) == ("SUCCESS", 44, now)
    audit = spark.table(cfg.name(C.CHECK_LOG)).first()
    assert (audit["overall_status"], audit["sla_violations"], audit["logged_at"]) == ("PASS", "[]", now)


def test_failed_gate_stops_the_load(spark, tmp_path, new_table):
    cfg = config(tmp_path, new_table)
    write_raw(spark, cfg, "2025-03-01", RAW)
    results = batch.run_batch(spark, cfg, "2025-03-01")
    assert [(r.stage, r.status) for r in results] == [
        ("bronze", "SUCCESS"), ("silver", "DQ_WARNING"), ("gold", "SUCCESS"), ("checks", "FAIL")]
    assert not spark.catalog.tableExists(cfg.name(C.KPI_SNAPSHOT))
    assert spark.table(cfg.name(C.CHECK_LOG)).first()["sla_violations"].startswith('["VALIDITY_BELOW_95: 50.0%"')
    reasons = {r["quarantine_reason"] for r in spark.table(cfg.name(C.QUARANTINE)).collect()}
    assert reasons == {'["NULL_MEMBER_ID"]', '["NEGATIVE_AMOUNT","PAID_EXCEEDS_BILLED"]'}


def test_error_is_recorded_and_stops_the_load(spark, tmp_path, new_table):
    results = batch.run_batch(spark, config(tmp_path, new_table), "2025-03-01")
    assert [(r.stage, r.status) for r in results] == [("load_bronze", "FAILED")]
    assert "PATH_NOT_FOUND" in results[0].metrics["error"]


def test_results_of_a_load_that_failed_are_no_results(spark, tmp_path, new_table):
    results = batch.run_batch(spark, config(tmp_path, new_table), "2025-03-01")
    with pytest.raises(batch.LoadError, match="load_bronze of 2025-03-01 failed: AnalysisException") as raised:
        batch.completed(results)
    assert raised.value.__cause__ is results[0].error
    shut = [batch.StageResult("checks", "FAIL", {})]
    assert batch.completed(shut) is shut


@pytest.mark.parametrize("query", ["gold_incremental_scorecard", "kpi_snapshot_after_loads"])
def test_a_query_raises_what_a_stage_of_its_second_load_raised(spark, monkeypatch, query):
    from claimworks.queries import QUERIES, SECOND_LOAD

    def load_gold(spark, cfg, batch_date):
        if batch_date == SECOND_LOAD:
            raise OSError("No space left on device")
        return batch.load_gold(spark, cfg, batch_date)

    monkeypatch.setattr(batch, "STAGES", tuple(
        (load_gold if stage is batch.load_gold else stage, passing) for stage, passing in batch.STAGES))
    with pytest.raises(batch.LoadError, match="No space left on device"):
        QUERIES[query](spark, "/root/testdata/sf0.001")


def test_loading_again_changes_nothing_and_old_batches_do_not_win(spark, tmp_path, new_table):
    cfg = config(tmp_path, new_table)
    write_raw(spark, cfg, "2025-03-01", [good(1), good(2), good(3, member_id=None)])
    write_raw(spark, cfg, "2025-03-02", [good(1, service_date="2025-02-01", paid_amount="7")])

    def silver():
        return sorted((r["claim_id"], r["paid_amount"], r["service_month"], str(r["silver_batch_date"]))
                      for r in spark.table(cfg.name(C.SILVER)).collect())

    for day in ("2025-03-01", "2025-03-02"):
        batch.run_batch(spark, cfg, day)
    expected = [("G001", 7.0, 2, "2025-03-02"), ("G002", 1500.0, 4, "2025-03-01")]
    assert silver() == expected
    batch.run_batch(spark, cfg, "2025-03-01")
    assert silver() == expected
    assert spark.table(cfg.name(C.BRONZE)).count() == 4
    assert spark.table(cfg.name(C.QUARANTINE)).count() == 1
    write_raw(spark, cfg, "2025-03-01", [good(1), good(2), good(3)])
    batch.run_batch(spark, cfg, "2025-03-01")
    assert spark.table(cfg.name(C.QUARANTINE)).count() == 0
    assert [row[0] for row in silver()] == ["G001", "G002", "G003"]


def test_empty_batch_fails_the_checks(spark, tmp_path, new_table):
    cfg = config(tmp_path, new_table)
    write_raw(spark, cfg, "2025-03-01", [good(1)])
    batch.run_batch(spark, cfg, "2025-03-01")
    write_raw(spark, cfg, "2025-03-02", [])
    got = stages(batch.run_batch(spark, cfg, "2025-03-02"))
    assert got["bronze"].metrics["records_ingested"] == 0
    assert got["checks"].status == "FAIL" and got["checks"].metrics["validity_pct"] == 0.0
    assert spark.table(cfg.name(C.BRONZE)).count() == 1
    write_raw(spark, cfg, "2025-03-01", [])
    assert batch.load_bronze(spark, cfg, "2025-03-01").metrics["records_ingested"] == 0
    assert spark.table(cfg.name(C.BRONZE)).count() == 0


def test_stream_rows_join_the_batch(spark, tmp_path, new_table):
    from test_stream import body, envelopes

    from claimworks.operators import tables
    from claimworks.sources.events import select_envelope
    from claimworks.streaming.ingest import parse_events

    day = datetime(2025, 3, 1, 5)
    cfg = config(tmp_path, new_table, with_stream=True)
    full = {"member_id": "M", "billed_amount": 20.0, "payer_id": "P"}
    events = envelopes(spark, [(0, body("S1", **full)), (1, body("S2", **{**full, "billed_amount": 1.0})),
                               (2, "no json"), (3, body("G001", **full))])
    tables.append(parse_events(select_envelope(events), day), cfg.name(C.BRONZE_STREAM),
                  ["ingestion_date"], cfg.location(C.BRONZE_STREAM))
    write_raw(spark, cfg, "2025-03-01", [good(1), good(2)])
    batch.run_batch(spark, cfg, "2025-03-01")
    silver = {r["claim_id"]: r["billed_amount"] for r in spark.table(cfg.name(C.SILVER)).collect()}
    assert set(silver) == {"G001", "G002", "S1"} and silver["S1"] == 20.0
    assert silver["G001"] == 2000.0  # loaded later than the event
    reasons = sorted(r["quarantine_reason"] for r in spark.table(cfg.name(C.QUARANTINE)).collect())
    assert reasons[1] == '["PAID_EXCEEDS_BILLED"]' and reasons[0].startswith('["NULL_CLAIM_ID"')
    assert "eh_offset" not in spark.table(cfg.name(C.SILVER)).columns


def stream_table(spark, cfg, *batches):
    """Events in the real-time table: (load time, rows) each."""
    from test_stream import envelopes

    from claimworks.operators import tables
    from claimworks.sources.events import select_envelope
    from claimworks.streaming.ingest import parse_events
    for loaded, rows in batches:
        tables.append(parse_events(select_envelope(envelopes(spark, rows)), loaded), cfg.name(C.BRONZE_STREAM),
                      ["ingestion_date"], cfg.location(C.BRONZE_STREAM))


def test_stream_the_newest_event_wins_and_identifiers_are_judged_as_sent(spark, tmp_path, new_table):
    from test_stream import body

    cfg = config(tmp_path, new_table, with_stream=True, run_ts=datetime(2025, 3, 1, 6))
    full = {"member_id": "M", "billed_amount": 900.0, "payer_id": "P", "provider_npi": "1234567890"}
    stream_table(spark, cfg, (datetime(2025, 3, 1, 5), [
        (0, body("S1", **{**full, "allowed_amount": 800.0, "claim_status": "PENDING"})),
        (30, body("S1", **{**full, "allowed_amount": 100.0, "claim_status": "DENIED"})),
        (1, body("LONG", **{**full, "provider_npi": "12345678901"})), (1, body("BLANK", **{**full, "provider_npi": " "}))]))
    write_raw(spark, cfg, "2025-03-01", [good(1)])
    batch.run_batch(spark, cfg, "2025-03-01")
    silver = {r["claim_id"]: r for r in spark.table(cfg.name(C.SILVER)).collect()}
    assert set(silver) == {"G001", "S1"} and silver["S1"]["claim_status"] == "DENIED"
    bad = spark.table(cfg.name(C.QUARANTINE)).collect()
    assert {(r["claim_id"], r["quarantine_reason"]) for r in bad} == {
        ("LONG", '["INVALID_NPI_LENGTH"]'), ("BLANK", '["INVALID_NPI_LENGTH"]')}


def test_late_stream_rows_come_with_the_next_batch(spark, tmp_path, new_table):
    from dataclasses import replace

    from test_stream import body

    cfg = config(tmp_path, new_table, with_stream=True, run_ts=datetime(2025, 3, 1, 2))
    full = {"member_id": "M", "billed_amount": 900.0, "payer_id": "P"}
    stream_table(spark, cfg, (datetime(2025, 3, 1, 1), [(0, body("EARLY", **full))]),
                 (datetime(2025, 3, 1, 20), [(0, body("LATE", **full))]), (datetime(2025, 3, 2, 1), [(0, body("NEXT", **full))]))
    for day in ("2025-03-01", "2025-03-02"):
        write_raw(spark, cfg, day, [good(int(day[-1]))])

    def silver():
        spark.catalog.refreshTable(cfg.name(C.SILVER))
        return {(r["claim_id"], str(r["silver_batch_date"])) for r in spark.table(cfg.name(C.SILVER)).collect()}

    batch.run_batch(spark, cfg, "2025-03-01")
    first = {("G001", "2025-03-01"), ("EARLY", "2025-03-01")}
    assert silver() == first
    batch.run_batch(spark, replace(cfg, run_ts=datetime(2025, 3, 2, 2)), "2025-03-02")
    second = first | {("G002", "2025-03-02"), ("LATE", "2025-03-02"), ("NEXT", "2025-03-02")}
    assert silver() == second
    batch.run_batch(spark, replace(cfg, run_ts=datetime(2025, 3, 5)), "2025-03-01")  # its own rows again
    assert silver() == second


def test_a_corrected_batch_takes_its_old_rows_away(spark, tmp_path, new_table):
    cfg = config(tmp_path, new_table)
    write_raw(spark, cfg, "2025-03-01", [good(1, service_date="2025-01-05"), good(2)])
    batch.run_batch(spark, cfg, "2025-03-01")
    write_raw(spark, cfg, "2025-03-01", [good(1, member_id=None), good(2)])
    batch.run_batch(spark, cfg, "2025-03-01")
    assert [r["claim_id"] for r in spark.table(cfg.name(C.SILVER)).collect()] == ["G002"]
    assert [r["claim_id"] for r in spark.table(cfg.name(C.QUARANTINE)).collect()] == ["G001"]


def test_an_absurd_amount_harms_no_load(spark, tmp_path, new_table):
    cfg = config(tmp_path, new_table)
    write_raw(spark, cfg, "2025-03-01", [good(1, billed_amount="1e16", paid_amount="1e16"), good(2),
                                         good(3, billed_amount="1e300", paid_amount="0.00004")])
    got = stages(batch.run_batch(spark, cfg, "2025-03-01"))
    assert got["gold"].status == "SUCCESS"
    row = spark.table(cfg.name(C.MEMBER_360)).first()
    assert row["lifetime_billed"] == 1e300 and row["lifetime_paid"] == 1e16 + 1500


def test_order_by_decides_between_copies(spark, tmp_path, new_table):
    cfg = config(tmp_path, new_table, order_by=("paid_amount",))
    write_raw(spark, cfg, "2025-03-01", [good(1, paid_amount="70"), good(1, paid_amount="8"), good(1, paid_amount="90")])
    batch.run_batch(spark, cfg, "2025-03-01")
    assert [r["paid_amount"] for r in spark.table(cfg.name(C.SILVER)).collect()] == [8.0]


def test_a_load_leaves_no_scratch(spark, tmp_path, new_table):
    import os

    from claimworks.session import shared_folder
    folder = shared_folder(spark).removeprefix("file://").removeprefix("file:")

    def held():
        return {f for f in os.listdir(folder) if f.startswith("stage-")} if os.path.isdir(folder) else set()

    before = held()
    cfg = config(tmp_path, new_table)
    write_raw(spark, cfg, "2025-03-01", [good(1), good(2, member_id=None)])
    for _ in range(2):
        batch.run_batch(spark, cfg, "2025-03-01")
    assert held() == before


def test_results_as_rows(spark):
    frame = batch.results_frame(spark, [batch.StageResult("bronze", "SUCCESS", {"a": 1, "b": None})])
    assert [tuple(r) for r in frame.collect()] == [
        (0, "bronze", "SUCCESS", "a", "1"), (0, "bronze", "SUCCESS", "b", "None")]


@pytest.mark.parametrize("prefix, root", [("db.", None), ("", "/x/")])
def test_names_and_locations(prefix, root):
    cfg = batch.BatchConfig("raw", prefix, root)
    assert cfg.name("t") == f"{prefix}t"
    assert cfg.location("t") == (None if root is None else "/x/t")


def test_a_micro_batch_committed_late_comes_with_the_next_batch_once(spark, tmp_path, new_table):
    """Loaded before the first batch ran, committed after it had read the table."""
    from test_stream import body, envelopes

    from claimworks.sources.events import envelope_stream, select_envelope
    from claimworks.streaming.ingest import parse_events, start_ingest

    cfg = config(tmp_path, new_table, with_stream=True, run_ts=datetime(2025, 3, 1, 2), layout=False)
    full = {"member_id": "M", "billed_amount": 900.0, "payer_id": "P"}

    def commit(loaded, *claims):
        path = str(tmp_path / f"in{loaded:%d%H%M%S}")
        rows = [(i, body(c, **full)) for i, c in enumerate(claims)]
        envelopes(spark, rows).coalesce(1).write.parquet(path)
        stream = parse_events(select_envelope(envelope_stream(spark, path)), loaded)
        start_ingest(stream, cfg.name(C.BRONZE_STREAM), f"{path}-state", cfg.location(C.BRONZE_STREAM), None).awaitTermination(120)

    def run(day):
        write_raw(spark, cfg, day, [good(int(day[-1]))])
        assert stages(batch.run_batch(spark, cfg, day))["silver"].status != "FAILED"
        spark.catalog.refreshTable(cfg.name(C.SILVER))
        return {(r["claim_id"], str(r["silver_batch_date"])[-2:]) for r in spark.table(cfg.name(C.SILVER)).collect()}

    commit(datetime(2025, 3, 1, 1), "A")
    first = {("G001", "01"), ("A", "01")}
    assert run("2025-03-01") == first
    commit(datetime(2025, 3, 1, 1, 59, 55), "B")
    commit(datetime(2025, 2, 20), "OLDER")
    commit(datetime(2025, 3, 1, 3), "D")
    second = first | {("G002", "02"), ("B", "02"), ("OLDER", "02"), ("D", "02")}
    assert run("2025-03-02") == second
    assert run("2025-03-01") == second  # its own rows again
    assert run("2025-03-03") == second | {("G003", "03")}
    log = spark.table(cfg.name(C.STREAM_LOG))
    assert log.filter("micro_batch IS NOT NULL").groupBy("micro_batch").count().filter("count > 1").isEmpty()
    assert sorted(r["batch_date"] for r in log.filter("micro_batch IS NULL").collect()) == ["2025-03-01", "2025-03-02", "2025-03-03"]


def test_a_batch_reads_only_the_load_dates_of_its_micro_batches(spark, tmp_path, new_table):
    cfg = config(tmp_path, new_table, with_stream=True, run_ts=datetime(2025, 3, 1, 2))
    from test_stream import body
    stream_table(spark, cfg, (datetime(2025, 2, 1), [(0, body("OLD"))]))
    batch.stream_rows(spark, cfg, "2025-02-01")
    stream_table(spark, cfg, (datetime(2025, 3, 1), [(0, body("NEW"))]))
    rows = batch.stream_rows(spark, cfg, "2025-03-01")
    assert [r["claim_id"] for r in rows.collect()] == ["NEW"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "ingestion_date" in plan.split("PartitionFilters", 1)[1]
    assert len([f for f in rows.inputFiles() if "bronze_claims_realtime" in f]) == 1


def test_gold_refreshes_the_months_that_changed(spark, tmp_path, new_table):
    cfg = config(tmp_path, new_table)

    def load(day, *rows):
        write_raw(spark, cfg, day, rows)
        results = batch.run_batch(spark, cfg, day)
        assert all(r.status in ("SUCCESS", "PASS") for r in results), results
        out = {}
        for table in (C.SCORECARD, C.DIAGNOSIS, C.DIAGNOSIS_MONTHLY):
            spark.catalog.refreshTable(cfg.name(table))
            out[table] = spark.table(cfg.name(table))
        return out

    def months(table):
        return sorted((r["service_month"], r["total_claims"]) for r in table.collect())

    got = load("2025-03-01", good(1, service_date="2025-01-05"), good(2, service_date="2025-02-05"), good(3, service_date="2025-04-05"))
    assert months(got[C.SCORECARD]) == [(1, 1), (2, 1), (4, 1)]
    before = {f for f in got[C.SCORECARD].filter("service_month = 4").inputFiles()}
    got = load("2025-03-02", good(2, service_date="2025-01-09"), good(4, service_date="2025-03-05"))
    assert months(got[C.SCORECARD]) == [(1, 2), (3, 1), (4, 1)]  # February's only claim moved
    assert {f for f in got[C.SCORECARD].filter("service_month = 4").inputFiles()} == before
    growth = {r["service_month"]: r["prev_month_claims"] for r in got[C.DIAGNOSIS].collect()}
    assert growth == {1: None, 3: 2, 4: 1}  # a later month sees the changed one before it
    pending = batch._pending_changes(spark, cfg)
    assert pending.isEmpty()


def test_changes_that_gold_has_not_seen_wait(spark, tmp_path, new_table, monkeypatch):
    cfg = config(tmp_path, new_table)
    write_raw(spark, cfg, "2025-03-01", [good(1, service_date="2025-01-05")])
    write_raw(spark, cfg, "2025-03-02", [good(2, service_date="2025-02-05")])
    write_raw(spark, cfg, "2025-03-03", [good(3, service_date="2025-04-05")])
    batch.run_batch(spark, cfg, "2025-03-01")
    batch.load_bronze(spark, cfg, "2025-03-02")
    batch.load_silver(spark, cfg, "2025-03-02")  # and no gold
    batch.run_batch(spark, cfg, "2025-03-03")
    spark.catalog.refreshTable(cfg.name(C.SCORECARD))
    assert sorted(r["service_month"] for r in spark.table(cfg.name(C.SCORECARD)).collect()) == [1, 2, 4]


def test_a_refresh_reads_only_its_months(spark, tmp_path, new_table):
    from claimworks.operators import tables
    cfg = config(tmp_path, new_table)
    write_raw(spark, cfg, "2025-03-01", [good(i, service_date=f"2025-0{i}-05") for i in range(1, 5)])
    batch.run_batch(spark, cfg, "2025-03-01")
    claims = spark.table(cfg.name(C.SILVER)).filter("is_valid")
    some = claims.filter(tables.in_partitions(["service_year", "service_month"], [{"service_year": 2025, "service_month": 2}]))
    assert len(claims.inputFiles()) == 4 and len(some.inputFiles()) == 1
