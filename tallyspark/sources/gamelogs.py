"""The event-log slice every daily roll-up starts from."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.dates import event_run_dates
from tallyspark.rundates import RunDates


def slice_log(log: DataFrame, dates: RunDates, commands: Iterable[str] | str,
              oid_positive: bool = False) -> DataFrame:
    """Events of ``commands`` in ``time between d and d+1`` for each run date
    ``d``, with the run date attached as column ``date``.

    The time ranges and the command list are plain predicates on the scan
    (pushed to Parquet); with an ``event_date`` partition column the scan is
    also pruned to the needed partitions. An event stamped exactly at
    midnight belongs to two run dates (the slice is closed on both ends) and
    comes out twice, once per date.
    """
    commands = [commands] if isinstance(commands, str) else list(commands)
    columns = log.columns
    cond = dates.time_filter("time") & F.col("command").isin(commands)
    if "event_date" in columns:
        cond = dates.partition_filter("event_date") & cond
    if oid_positive:
        cond = cond & (F.col("oidaccount") > 0)
    sliced = log.where(cond)
    return (sliced
            .select(F.explode(event_run_dates("time")).alias("date"), *[c for c in columns if c != "event_date"])
            .where(dates.date_filter("date")))
