"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the folder of the tables, ``BENCH_CPUS`` the number of local cores. A query is
timed from plan to last row, without sending rows to the driver. Throughput is measured on raw
claims and silver tables written before the clock starts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from claimworks import fixture as fx  # noqa: E402
from claimworks import queries as q  # noqa: E402
from claimworks.constants import RAW_COLUMNS  # noqa: E402
from claimworks.operators import tables  # noqa: E402
from claimworks.plans import gold  # noqa: E402
from claimworks.plans.silver import silver_rows, validated_claims  # noqa: E402
from claimworks.session import local_session, scratch_path  # noqa: E402
from claimworks.sources import events as ev  # noqa: E402
from claimworks.streaming import ingest  # noqa: E402

HEADLINE = (
    "silver_claims", "rule_flags_json", "quarantine_rows", "gold_daily_kpi",
    "gold_provider_scorecard", "gold_member_360", "gold_diagnosis_trending",
    "view_exec_dashboard", "view_top50_diagnoses", "upsert_claims", "check_verdict_silver",
    "csv_roundtrip_corrupt", "stream_ingest",
)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def throughput(spark, sf: str) -> dict[str, float]:
    """Rows per second of each step of a load, from tables that are already written."""
    raw = tables.staged(fx.claims_raw(spark, sf, [*RAW_COLUMNS, *q.ORDER_COLUMNS]).repartition(8))
    n = raw.count()
    checked = validated_claims(raw, fx.AS_OF, order_by=fx.newest_first())
    rates = {"clean_dedup_rules": n / timed(lambda: drain(checked))}
    silver = tables.staged(silver_rows(checked.drop(*q.ORDER_COLUMNS), fx.AS_OF, q._run_ts()))
    m = silver.count()
    for name, build in gold.BUILDERS.items():
        rates[name] = m / timed(lambda build=build: drain(build(silver)))
    name, location = "bench_upsert", scratch_path(spark, "bench")
    parts = ["service_year", "service_month"]
    tables.create(silver, name, parts, location)
    rates["upsert"] = m / timed(lambda: tables.upsert(silver, name, ["claim_id"]))
    rates["upsert_newer_than"] = m / timed(lambda: tables.upsert(
        silver, name, ["claim_id"], newer_than="silver_batch_date", unique=True))
    spark.sql(f"DROP TABLE {name}")
    return {step: round(rate) for step, rate in rates.items()}


def latency(spark, sf: str, every: str = "10 seconds") -> float:
    """Seconds from the arrival of a file of events to their rows in the table, under a timed trigger
    that is already running: the trigger's wait and the micro-batch."""
    name, location, path = "bench_stream", scratch_path(spark, "bench"), scratch_path(spark, "arriving")
    events = q._events(spark, sf).limit(10_000)
    events.limit(1).write.mode("append").parquet(path)
    stream = ingest.parse_events(ev.select_envelope(ev.envelope_stream(spark, path)))
    run = ingest.start_ingest(stream, name, scratch_path(spark, "bench-state"), location, every)
    run.processAllAvailable()
    events.write.mode("append").parquet(path)
    start = time.perf_counter()
    while spark.read.parquet(location).count() < 2:
        time.sleep(0.2)
    taken = time.perf_counter() - start
    run.stop()
    spark.sql(f"DROP TABLE {name}")
    return round(taken, 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    drain(q.QUERIES["gold_daily_kpi"](spark, sf))  # start-up and compilation stay outside
    seconds = {name: timed(lambda name=name: drain(q.QUERIES[name](spark, sf))) for name in HEADLINE}
    print(json.dumps({
        "metric": "claims_headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
        "rows_per_sec": throughput(spark, sf), "stream_latency_sec": latency(spark, sf),
    }))


if __name__ == "__main__":
    main()
