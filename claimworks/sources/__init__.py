"""Where rows come from: raw files, tables and event envelopes."""

from claimworks.sources.events import envelope_stream, from_kafka, select_envelope
from claimworks.sources.raw import add_provenance, bronze_union, read_batch, read_raw

__all__ = [
    "add_provenance", "bronze_union", "envelope_stream", "from_kafka", "read_batch", "read_raw",
    "select_envelope",
]
