"""Scheduled jobs: daily KPIs (R33), CCU (R29), replay picks
and the log purge (R32), each writing through the table store."""

from __future__ import annotations

import calendar
import dataclasses
import datetime as dt
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyspark import operators as ops
from tallyspark.operators.periodic import period_start
from tallyspark.operators.retention import OFFSETS
from tallyspark.operators.match_stats import ARENA_ROLLUPS
from tallyspark.plans.activity import ActivityState
from tallyspark.plans.daily import COMMANDS, DEPENDS_ON, DailyJob, output_tables
from tallyspark.plans.replay import DEFAULT_INTERVAL, previous_bucket, replay_backfill
from tallyspark.plans.schemas import RETENTION_TABLES, partition_columns
from tallyspark.rundates import RunDates
from tallyspark.sinks.store import TableStore, purge_folders_before, purge_partitions_before
from tallyspark.sources.inputs import Inputs


def minus_months(ts: dt.datetime, months: int) -> dt.datetime:
    """Calendar-month subtraction, clamping to the target month's last day
    (same as Spark's timestamp minus a year-month interval)."""
    years, month0 = divmod(ts.month - 1 - months, 12)
    year = ts.year + years
    last = calendar.monthrange(year, month0 + 1)[1]
    return ts.replace(year=year, month=month0 + 1, day=min(ts.day, last))


def replace_keys(table: str, dates: RunDates) -> list[tuple]:
    """Keys a run over ``dates`` replaces in ``table``."""
    if table in RETENTION_TABLES:
        return sorted({(d - dt.timedelta(days=k), k) for d in dates for k in OFFSETS})
    if "weekly" in table:
        return sorted({(period_start(d, "week"),) for d in dates})
    if "monthly" in table:
        return sorted({(period_start(d, "month"),) for d in dates})
    return [(d,) for d in dates]


def dependency_waves(tables: list[str]) -> list[list[str]]:
    """Group tables into waves that keep the sequential semantics of the
    given order: a table runs after every earlier table it reads (it must see
    the new rows) and after every earlier table that reads it (they must
    see the old rows, and never a table in the middle of its swap)."""
    level: dict[str, int] = {}
    for t in tables:
        before = [d for d in DEPENDS_ON.get(t, ()) if d in level]
        before += [r for r in level if t in DEPENDS_ON.get(r, ())]
        level[t] = 1 + max((level[d] for d in before), default=-1)
    waves: list[list[str]] = [[] for _ in range(max(level.values(), default=-1) + 1)]
    for t in tables:
        waves[level[t]].append(t)
    return waves


def daily_crm(inputs: Inputs, store: TableStore, dates: RunDates | None = None,
              commands: Iterable[str] | None = None, parallel: int = 1,
              run_id: str | None = None) -> dict[str, list[str]]:
    """Run the daily commands for all ``dates`` at once (default: yesterday,
    UTC) and replace their keys in the store.

    Tables are written in declared command order; a later command reads what
    earlier ones stored (so each output is its own Spark job with a short
    lineage, and a rerun of one command sees the stored inputs). The result
    equals running the dates one by one in ascending order. With
    ``parallel > 1`` the tables of a dependency wave (those whose inputs are
    already written) are written as concurrent Spark jobs.

    With ``run_id`` the run can be taken up again: its dates and commands are
    recorded before it starts, each table's version carries the id, and a run
    started again under the id skips the tables that carry it. As a table's
    rows and its mark become visible together, a run broken at any point ends
    with the tables of an unbroken one; a finished run does nothing."""
    dates = dates or RunDates.yesterday()
    tables = output_tables(commands)
    if run_id:
        store.begin_run(run_id, {"dates": [d.isoformat() for d in dates], "tables": tables})
    if inputs.ccu is None and store.exists("crm_ccu"):
        inputs = dataclasses.replace(inputs, ccu=store.read("crm_ccu").select("time", "ccu"))
    done = {t for t in tables if run_id and store.committed(t, run_id)}
    job = DailyJob(inputs, dates, upstream=store.read, persist_shared=True, bits=ActivityState(store).bits)
    if parallel > 1:  # the shared intermediate is created once, before threads use it
        if any(t in ARENA_ROLLUPS for t in tables if t not in done):
            job.arena_matches()

    def write(table: str) -> list[str]:
        if table in done:
            return []
        df = job.output(table)
        if table in RETENTION_TABLES:  # cells (cohort date, day) inside date partitions
            return store.replace_cells(table, df, "date", "day", replace_keys(table, dates), run_id)
        return store.replace(table, df, partition_columns(table), replace_keys(table, dates), run_id)

    written = {}
    try:
        if parallel <= 1:
            for table in tables:
                written[table] = write(table)
        else:
            with ThreadPoolExecutor(max_workers=parallel) as pool:
                for wave in dependency_waves(tables):
                    for table, parts in zip(wave, pool.map(write, wave)):
                        written[table] = parts
    finally:
        job.release()
    return {t: written[t] for t in tables}


def resume_run(inputs: Inputs, store: TableStore, run_id: str, parallel: int = 1) -> dict[str, list[str]]:
    """Take up a recorded run where it broke off."""
    what = store.run(run_id)
    by_table = {t: c for c, outs in COMMANDS.items() for t in outs}
    commands = list(dict.fromkeys(by_table[t] for t in what["tables"]))
    return daily_crm(inputs, store, RunDates(what["dates"]), commands, parallel, run_id)


def ccu_job(server_status, store: TableStore, now: dt.datetime | None = None,
            staleness: str = "as_reference") -> dt.datetime:
    """Sum live servers' CCU and upsert the row of the current minute."""
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = ops.ccu(server_status, now, staleness)
    store.upsert("crm_ccu", row, "time", "day", F.to_date("time"))
    return now.replace(second=0, microsecond=0)


def replay_pick_job(replay, store: TableStore, buckets: list[str] | None = None,
                    interval_minutes: int = DEFAULT_INTERVAL, now: dt.datetime | None = None,
                    purge_old: bool = False, table: str = "replay_pick") -> list[str]:
    """Pick the best replay per arena for each bucket (default: the previous
    whole bucket) and put the picked rows into the pick table by key. With
    ``purge_old`` (the reference does this in its dev setup), picks of days
    before the first bucket are deleted first. Returns the days written."""
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    buckets = sorted(buckets or [previous_bucket(now, interval_minutes)])
    return _put_picks(ops.fetch_best(replay, F.col("dateHour").isin(buckets)), replay, store, buckets[0], purge_old, table)


def replay_backfill_job(replay, store: TableStore, start_key: str | None = None, end_key: str | None = None,
                        interval_minutes: int | None = None, purge_old: bool = False, table: str = "replay_pick") -> list[str]:
    """The picks of every bucket of the series (see ``replay_backfill``:
    the same plan), put into the pick table by key."""
    picks = replay_backfill(replay, start_key, end_key, interval_minutes)
    first = start_key or (replay.agg(F.min("dateHour")).first()[0] or "") if purge_old else ""
    return _put_picks(picks, replay, store, first, purge_old, table)


def _put_picks(picks, replay, store: TableStore, first_bucket: str, purge_old: bool, table: str) -> list[str]:
    """Stored by day, not by bucket: a bucket holds a few rows."""
    if table not in store.schemas:
        store.schemas[table] = StructType([*replay.schema.fields]).add("day", "string")
    if purge_old:
        store.drop_partitions(table, [p for p in store.partitions(table) if p.split("=", 1)[1] < first_bucket[:8]])
    return store.upsert(table, picks, "uniqueKey", "day", F.substring("dateHour", 1, 8))


def purge_log_job(store: TableStore, now: dt.datetime | None = None, months: int = 3,
                  table: str = "gamelogs") -> list[str]:
    """Delete log rows older than ``months`` calendar months before ``now``:
    of a stored table, or of a log of plain day folders."""
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    purge = purge_partitions_before if store.versions(table) else purge_folders_before
    return purge(store, table, "event_date", "time", minus_months(now, months))
