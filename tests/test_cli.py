import json
import tempfile

from helpers import SF_SMALL

from tallyspark.__main__ import main
from tallyspark.sinks.store import TableStore
from tallyspark.sources.inputs import fixture_inputs


def test_cli_daily_ccu_replay(spark, capsys):
    inputs = fixture_inputs(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="ts-in-")
    inputs.gamelogs.write.partitionBy("event_date").parquet(f"{root}/gamelogs")
    for name, df in (("rds_footprint", inputs.footprint), ("rds_staticaccount", inputs.staticaccount),
                     ("crm_ccu", inputs.ccu), ("server_status", inputs.server_status), ("replay", inputs.replay)):
        df.write.parquet(f"{root}/{name}")
    out = tempfile.mkdtemp(prefix="ts-out-")
    main(["daily", "--inputs", root, "--store", out, "--start", "2024-01-15", "--end", "2024-01-16",
          "--commands", "AccountDaily,Retention"])
    # a fresh store holds two days, so only the (01-15, day 1) retention cell has rows
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"account_daily": 2, "retention": 1}
    main(["ccu", "--inputs", root, "--store", out, "--now", "2024-01-16T12:00:30"])
    main(["replay", "--inputs", root, "--store", out, "--start", "202401160000", "--end", "202401160200"])
    store = TableStore(spark, out)
    assert store.read("crm_ccu").count() == 1
    store.schemas["replay_pick"] = inputs.replay.schema
    picks = store.read("replay_pick")
    assert picks.count() > 0 and {r.dateHour for r in picks.select("dateHour").distinct().collect()} <= {
        "202401160000", "202401160100", "202401160200"}


def test_cli_vacuum_purges_old_log_days(spark, capsys):
    from tallyspark.rundates import ts_lit  # noqa: F401
    inputs = fixture_inputs(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="ts-in-")
    inputs.gamelogs.write.partitionBy("event_date").parquet(f"{root}/gamelogs")
    main(["daily", "--inputs", root, "--store", tempfile.mkdtemp(prefix="ts-out-"), "--vacuum",
          "--now", "2024-04-16T06:30:00"])
    dropped = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["purged_partitions"]
    assert dropped == [f"event_date=2024-01-{d:02d}" for d in range(1, 16)]
    left = spark.read.parquet(f"{root}/gamelogs")
    assert left.agg({"time": "min"}).first()[0].isoformat(sep=" ") >= "2024-01-16 06:30:00"
    assert left.count() == inputs.gamelogs.where("time >= timestamp'2024-01-16 06:30:00'").count()
