"""Aggregate tables, reporting views and the daily batch, composed from the operators."""
