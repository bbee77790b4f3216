"""Event-log retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.rundates import ts_lit

# Fixed value: months of log kept by the purge.
RETENTION_MONTHS = 3


def purge_cutoff(now: dt.datetime, months: int = RETENTION_MONTHS):
    """``now`` minus ``months`` calendar months, time of day kept (a day past
    the target month's end clamps to its last day)."""
    return ts_lit(now) - F.make_ym_interval(F.lit(0), F.lit(months))


def retained_log(log: DataFrame, now: dt.datetime, months: int = RETENTION_MONTHS) -> DataFrame:
    """Rows the purge keeps: ``time`` not older than the cutoff. On a log
    partitioned by ``event_date`` the days before the cutoff's day are
    pruned from the scan."""
    cutoff = purge_cutoff(now, months)
    cond = F.col("time") >= cutoff
    if "event_date" in log.columns:
        cond = (F.col("event_date") >= F.to_date(cutoff)) & cond
    return log.where(cond)
