"""Structured Streaming form of the CCU job."""

from tallyspark.streaming.ccu_stream import ccu_per_minute, minute_totals, start_ccu_stream  # noqa: F401
