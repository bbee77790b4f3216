"""Replay backfill (R34): picks for a series of buckets in one plan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.dates import BUCKET_FORMAT, in_bucket_series
from tallyspark.operators.replay import fetch_best

PY_BUCKET_FORMAT = "%Y%m%d%H%M"
DEFAULT_INTERVAL = 60


def bucket_keys(start_key: str, end_key: str, interval_minutes: int = DEFAULT_INTERVAL) -> list[str]:
    """Bucket keys from ``start_key`` in steps of ``interval_minutes`` while
    not past ``end_key``; always holds ``start_key``."""
    start = dt.datetime.strptime(start_key, PY_BUCKET_FORMAT)
    end = dt.datetime.strptime(end_key, PY_BUCKET_FORMAT)
    step = dt.timedelta(minutes=interval_minutes)
    keys = [start.strftime(PY_BUCKET_FORMAT)]
    cur = start + step
    while cur <= end:
        keys.append(cur.strftime(PY_BUCKET_FORMAT))
        cur += step
    return keys


def previous_bucket(now: dt.datetime, interval_minutes: int = DEFAULT_INTERVAL) -> str:
    """Default bucket of a run at ``now``: the previous whole bucket."""
    back = interval_minutes + now.minute % interval_minutes
    return (now - dt.timedelta(minutes=back)).strftime(PY_BUCKET_FORMAT)


def replay_backfill(replay: DataFrame, start_key: str | None = None, end_key: str | None = None,
                    interval_minutes: int | None = None) -> DataFrame:
    """Picks for every bucket from ``start_key`` to ``end_key`` (an absent
    bound is open): with ``interval_minutes`` those of the series that starts
    at ``start_key``, as the launcher steps; without it every bucket that the
    table has, whatever its interval."""
    if interval_minutes and start_key:
        # A predicate, not a literal list: a year of hourly buckets would be
        # 8,760 literals, too many for the scan's pushdown.
        last = end_key or replay.agg(F.max("dateHour")).first()[0] or start_key
        return fetch_best(replay, in_bucket_series("dateHour", start_key, last, interval_minutes))
    pred = F.lit(True)
    if start_key:
        pred = pred & (F.col("dateHour") >= start_key)
    if end_key:
        pred = pred & (F.col("dateHour") <= end_key)
    return fetch_best(replay, pred)


__all__ = ["BUCKET_FORMAT", "bucket_keys", "previous_bucket", "replay_backfill"]
