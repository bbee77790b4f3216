"""Idempotent writers: replace-by-key tables and keyed upserts."""

from tallyspark.sinks.store import TableStore  # noqa: F401
