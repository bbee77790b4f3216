"""Command line: run a scheduled job against stored tables.

    python -m tallyspark daily  --inputs ROOT --store ROOT [--start D --end D] [--commands A,B] [--vacuum] [--parallel N] [--run-id ID]
    python -m tallyspark ccu    --inputs ROOT --store ROOT [--now TS] [--staleness strict]
    python -m tallyspark replay --inputs ROOT --store ROOT [--interval 60] [--start KEY --end KEY] [--purge-old]
    python -m tallyspark ccu-stream --inputs HEARTBEAT_FOLDER --store ROOT --checkpoint SHARED_FOLDER

``--inputs`` holds the input tables (``gamelogs`` partitioned by
``event_date``, ``rds_footprint``, ``rds_staticaccount``, ``server_status``,
``replay``); ``--store`` holds the output tables. Without dates the daily
job runs yesterday (UTC); without buckets the replay job runs the previous
whole bucket. ``--vacuum`` runs only the log purge (3 months) on
``--inputs``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from tallyspark.plans import jobs
from tallyspark.rundates import RunDates, date_series
from tallyspark.session import build_session
from tallyspark.sinks.store import TableStore
from tallyspark.sources.inputs import read_table_inputs


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tallyspark")
    ap.add_argument("job", choices=["daily", "ccu", "replay", "ccu-stream"])
    ap.add_argument("--inputs", required=True)
    ap.add_argument("--store", required=True)
    ap.add_argument("--master", default=None, help="only for local runs; on a cluster use spark-submit")
    ap.add_argument("--start")
    ap.add_argument("--end")
    ap.add_argument("--commands", default="")
    ap.add_argument("--vacuum", action="store_true")
    ap.add_argument("--now")
    ap.add_argument("--staleness", default="as_reference")
    ap.add_argument("--interval", type=int, default=60)
    ap.add_argument("--purge-old", action="store_true")
    ap.add_argument("--checkpoint", help="ccu-stream: shared folder for the stream's progress and state")
    ap.add_argument("--lateness", default="2 minutes")
    ap.add_argument("--parallel", type=int, default=1, help="daily: concurrent table writes per dependency wave")
    ap.add_argument("--run-id", help="daily: record the run; the same id again takes a broken run up where it stopped")
    a = ap.parse_args(argv)

    spark = build_session(master=a.master) if a.master else _cluster_session()
    store = TableStore(spark, a.store)
    now = dt.datetime.fromisoformat(a.now) if a.now else None
    if a.job == "daily":
        if a.vacuum:
            dropped = jobs.purge_log_job(TableStore(spark, a.inputs), now)
            print(json.dumps({"purged_partitions": dropped}))
            return
        inputs = read_table_inputs(spark, a.inputs)
        dates = RunDates(date_series(a.start, a.end or a.start)) if a.start else None
        commands = [c for c in a.commands.split(",") if c] or None
        if a.run_id and a.run_id in store.runs():
            written = jobs.resume_run(inputs, store, a.run_id, a.parallel)
        else:
            written = jobs.daily_crm(inputs, store, dates, commands, a.parallel, a.run_id)
        print(json.dumps({t: len(p) for t, p in written.items()}))
    elif a.job == "ccu-stream":
        from tallyspark.streaming import start_ccu_stream
        if not a.checkpoint:
            ap.error("ccu-stream needs --checkpoint")
        heartbeats = (spark.readStream.schema("hashkey string, dtmUpdated timestamp, numCCU int")
                      .parquet(a.inputs))
        start_ccu_stream(heartbeats, store, a.checkpoint, a.lateness).awaitTermination()
    elif a.job == "ccu":
        inputs = read_table_inputs(spark, a.inputs)
        minute = jobs.ccu_job(inputs.server_status, store, now, a.staleness)
        print(json.dumps({"minute": minute.isoformat()}))
    else:
        inputs = read_table_inputs(spark, a.inputs)
        if a.start:
            parts = jobs.replay_backfill_job(inputs.replay, store, a.start, a.end or a.start, a.interval, a.purge_old)
        else:
            parts = jobs.replay_pick_job(inputs.replay, store, None, a.interval, now=now, purge_old=a.purge_old)
        print(json.dumps({"days": parts}))


def _cluster_session():
    from pyspark.sql import SparkSession

    from tallyspark.session import configure
    return configure(SparkSession.builder.getOrCreate())


if __name__ == "__main__":
    main()
