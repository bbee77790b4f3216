"""Calendar helpers as Spark Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day numbers as .NET counts them (Sunday = 0); Spark's dayofweek() is Sunday = 1.
WEEKDAYS = {"sunday": 0, "monday": 1, "tuesday": 2, "wednesday": 3,
            "thursday": 4, "friday": 5, "saturday": 6}

# Fixed value: replay bucket key format.
BUCKET_FORMAT = "yyyyMMddHHmm"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_run_dates(ts: Column | str) -> Column:
    """Run dates an event belongs to under the closed ``time between d and
    d+1`` slice: its own day, and the day before when the stamp is exactly
    midnight."""
    ts = _col(ts)
    day = F.to_date(ts)
    at_midnight = ts == day.cast("timestamp")
    return F.when(at_midnight, F.array(day, F.date_sub(day, 1))).otherwise(F.array(day))


def first_day_of_week(d: Column | str, start: str = "monday") -> Column:
    """First day of the week holding ``d`` for weeks starting on ``start``."""
    s = WEEKDAYS[start.lower()]
    d = _col(d)
    back = F.pmod(F.dayofweek(d) - F.lit(1 + s), F.lit(7))
    return F.date_sub(d, back)


def last_day_of_week(d: Column | str, start: str = "monday") -> Column:
    return F.date_add(first_day_of_week(d, start), 6)


def first_day_of_month(d: Column | str) -> Column:
    return F.trunc(_col(d), "MM")


def last_day_of_month(d: Column | str) -> Column:
    return F.last_day(_col(d))


def minute_floor(ts: Column | str) -> Column:
    return F.date_trunc("minute", _col(ts))


def bucket_key_before(now: Column | str, interval_minutes: int) -> Column:
    """Key of the replay bucket a run at ``now`` works on: ``now`` minus
    ``interval + minute(now) % interval`` minutes, as ``yyyyMMddHHmm``
    (seconds are dropped by the format)."""
    now = _col(now)
    back = F.lit(interval_minutes) + F.minute(now) % F.lit(interval_minutes)
    return F.date_format(now - F.make_dt_interval(F.lit(0), F.lit(0), back), BUCKET_FORMAT)


def in_bucket_series(key: Column | str, start_key: str, end_key: str, interval_minutes: int) -> Column:
    """``key`` is one of the bucket keys from ``start_key`` stepping
    ``interval_minutes`` up to ``end_key`` (always including ``start_key``),
    without listing them: a text range (pushed to the Parquet scan) and an
    alignment test on the minutes since ``start_key``."""
    key = _col(key)
    end_key = max(start_key, end_key)
    start = F.to_timestamp(F.lit(start_key), BUCKET_FORMAT)
    minutes = (F.unix_seconds(F.try_to_timestamp(key, F.lit(BUCKET_FORMAT))) - F.unix_seconds(start)) / 60
    return (key.between(F.lit(start_key), F.lit(end_key))
            & (F.length(key) == len("yyyyMMddHHmm"))
            & (F.pmod(minutes, F.lit(interval_minutes)) == 0))


def bucket_series(start_key: Column | str, end_key: Column | str, interval_minutes: int) -> Column:
    """Array of bucket keys from ``start_key`` stepping ``interval_minutes``
    while not past ``end_key``; always holds ``start_key``."""
    start = F.to_timestamp(_col(start_key), BUCKET_FORMAT)
    end = F.greatest(start, F.to_timestamp(_col(end_key), BUCKET_FORMAT))
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(interval_minutes))
    return F.transform(F.sequence(start, end, step), lambda t: F.date_format(t, BUCKET_FORMAT))
