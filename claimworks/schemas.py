"""Declared schemas as DDL text: nothing in this package infers one."""

from __future__ import annotations

from claimworks.constants import RAW_COLUMNS

CORRUPT = "_corrupt_record"

RAW = ", ".join(f"{c} string" for c in RAW_COLUMNS)
RAW_WITH_CORRUPT = f"{RAW}, {CORRUPT} string"

# Fixed names: the fields of an event body and of its envelope.
EVENT = """claim_id string, member_id string, provider_npi string, service_date string,
    icd10_code string, cpt_code string, billed_amount double, allowed_amount double,
    paid_amount double, claim_status string, payer_id string, event_type string,
    submission_ts string"""
ENVELOPE = "enqueuedTime timestamp, body binary, partition string, offset string"

# Fixed names: the log of loads. The stream log keeps which micro-batches each batch has taken, and a
# row without one for the batch itself; commits are micro-batches that are wholly in the table.
INGESTION_LOG = """batch_date string, records_ingested bigint, corrupt_records bigint,
    source_path string, status string, logged_at timestamp"""
STREAM_LOG = "batch_date string, micro_batch string, taken_at timestamp"
STREAM_COMMITS = "micro_batch string, first_date date, last_date date, committed_at timestamp"
SILVER_CHANGES = "change_id string, batch_date string, service_year int, service_month int, changed_at timestamp"
GOLD_LOG = "change_id string, refreshed_at timestamp"
