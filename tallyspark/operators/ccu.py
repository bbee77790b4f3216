"""Concurrent users (R29): sum of live servers' CCU at one minute."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.rundates import ts_lit

# Key prefix of game-server status hashes; liveness modes.
STATUS_PREFIX = "ServerDesc:"

STALENESS_MODES = ("as_reference", "strict")


def ccu(server_status: DataFrame, now: dt.datetime, staleness: str = "as_reference",
        tolerance_seconds: int = 60) -> DataFrame:
    """One row (time, ccu): ``time`` is ``now`` floored to the minute.

    ``as_reference`` keeps a server unless its last update lies more than
    ``tolerance_seconds`` *after* ``now`` -- the reference's test, which never
    drops a stale server; a missing stamp counts, as the model's default
    stamp would. ``strict`` keeps servers updated at most
    ``tolerance_seconds`` before ``now`` (future stamps included).
    """
    if staleness not in STALENESS_MODES:
        raise ValueError(f"staleness must be one of {STALENESS_MODES}")
    now_col = ts_lit(now)
    ahead_s = (F.unix_micros(F.col("dtmUpdated")) - F.unix_micros(now_col)) / F.lit(1_000_000)
    if staleness == "as_reference":
        live = F.coalesce(ahead_s <= F.lit(tolerance_seconds), F.lit(True))
    else:
        live = F.coalesce(-ahead_s <= F.lit(tolerance_seconds), F.lit(False))
    servers = server_status.where(F.col("hashkey").startswith(STATUS_PREFIX) & live)
    return servers.agg(F.coalesce(F.sum("numCCU"), F.lit(0)).cast("int").alias("ccu")).select(
        F.date_trunc("minute", now_col).alias("time"), "ccu")
