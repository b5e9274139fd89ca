"""Claims analytics as reusable Spark DataFrame operators.

Sub-packages: ``functions`` (column expressions), ``sources`` (raw files, event envelopes),
``operators`` (cleaning, dedup, rules, table writes, access, checks), ``plans`` (aggregate
tables, views, the daily batch) and ``streaming`` (event ingest).
"""
