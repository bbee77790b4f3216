"""Versions of stored tables (K1-K4): a write broken between any two steps,
snapshots, roll-back, deltas, other writers, and the run journal (R33)."""

import datetime as dt
import json
import tempfile
from pathlib import Path

import pytest
from helpers import SF_SMALL, rows, ts

from pyspark.sql import functions as F

from tallyspark import operators as ops
from tallyspark.plans.activity import ActivityState
from tallyspark.plans.daily import DailyJob, output_tables
from tallyspark.plans.jobs import daily_crm, purge_log_job, replay_backfill_job, resume_run
from tallyspark.rundates import RunDates
from tallyspark.sinks import store as stores
from tallyspark.sinks.store import Conflict, TableStore
from tallyspark.sources.inputs import fixture_inputs, read_table_inputs

D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))
REVENUE = "date date, country string, pu bigint, revenue bigint"


class Broken(RuntimeError):
    pass


class BreakingStore(TableStore):
    """Stops a write at its nth step."""
    steps_left = 10**9

    def _step(self, name):
        self.steps_left -= 1
        if self.steps_left < 0:
            raise Broken(name)


def _root():
    return tempfile.mkdtemp(prefix="ts-versions-")


def _revenue(spark, *triples):
    return spark.createDataFrame([(d, c, n, n) for d, c, n in triples], REVENUE)


def _stepwise(spark, prepare, write, read):
    """``write`` broken at every step: readers see the old rows or the new
    ones; the write made again gives the new ones and leaves no waste."""
    root = _root()
    done = TableStore(spark, root)
    prepare(done)
    old = read(done)
    write(done)
    new = read(done)
    assert old != new
    seen = set()
    for n in range(100):
        root = _root()
        prepare(TableStore(spark, root))
        breaking = BreakingStore(spark, root)
        breaking.steps_left = n
        try:
            write(breaking)
        except Broken as at:
            seen.add(str(at))
        else:
            break
        now = TableStore(spark, root)
        assert read(now) in (old, new)
        write(now)
        assert read(now) == new
    assert n >= 3 and "staged" in seen and "published" in seen


def test_replace_is_old_or_new_at_every_step(spark):
    _stepwise(spark,
              lambda s: s.replace("revenue_daily", _revenue(spark, (D1, "KR", 1), (D2, "KR", 2)), ["date"], [(D1,), (D2,)]),
              lambda s: s.replace("revenue_daily", _revenue(spark, (D2, "JP", 5), (D3, "JP", 6)), ["date"], [(D1,), (D2,), (D3,)]),
              lambda s: rows(s.read("revenue_daily")))


def test_upsert_and_purge_are_old_or_new_at_every_step(spark):
    def minute(*pairs):
        return spark.createDataFrame([(ts(f"2024-01-{d:02d} 00:00:00"), n) for d, n in pairs], "time timestamp, ccu int")
    day = F.to_date("time")
    _stepwise(spark,
              lambda s: s.upsert("crm_ccu", minute((1, 10), (2, 20)), "time", "day", day),
              lambda s: s.upsert("crm_ccu", minute((2, 21), (3, 30)), "time", "day", day),
              lambda s: rows(s.read("crm_ccu")))
    log = spark.createDataFrame([(1, ts(f"2024-01-{d:02d} {h:02d}:00:00"), "Login", "{}") for d in (1, 15, 16, 17) for h in (3, 9)],
                                "oidaccount bigint, time timestamp, command string, payload string").withColumn("event_date", day)

    def fill(s):
        s.schemas["gamelogs"] = log.schema
        s.overwrite("gamelogs", log, ["event_date"])

    def left(s):
        s.schemas["gamelogs"] = log.schema
        return rows(s.read("gamelogs"), "time")

    def purge(s):
        s.schemas["gamelogs"] = log.schema
        purge_log_job(s, dt.datetime(2024, 4, 16, 6))
    _stepwise(spark, fill, purge, left)


def test_plain_log_purge_is_finished_by_the_next_one(spark):
    log = spark.createDataFrame([(1, ts(f"2024-01-{d:02d} {h:02d}:00:00")) for d in (15, 16, 17) for h in (3, 9)],
                                "oidaccount bigint, time timestamp").withColumn("event_date", F.to_date("time"))
    want = [ts("2024-01-16 09:00:00"), ts("2024-01-17 03:00:00"), ts("2024-01-17 09:00:00")]
    for n in range(4):
        root = _root()
        log.write.partitionBy("event_date").parquet(f"{root}/gamelogs")
        breaking = BreakingStore(spark, root)
        breaking.steps_left = n
        try:
            purge_log_job(breaking, dt.datetime(2024, 4, 16, 6))
        except Broken:
            purge_log_job(TableStore(spark, root), dt.datetime(2024, 4, 16, 6))
        assert [r[0] for r in rows(spark.read.parquet(f"{root}/gamelogs"), "time")] == want


def test_snapshots_rollback_and_vacuum(spark):
    s = TableStore(spark, _root())
    s.replace("revenue_daily", _revenue(spark, (D1, "KR", 1)), ["date"], [(D1,)])
    snapshot = s.read("revenue_daily")
    s.replace("revenue_daily", _revenue(spark, (D1, "KR", 2), (D2, "KR", 3)), ["date"], [(D1,), (D2,)])
    assert rows(snapshot, "pu") == [(1,)]                         # a reader keeps its snapshot
    assert rows(s.read("revenue_daily", version=1), "pu") == [(1,)]
    assert rows(s.read("revenue_daily", keys=[f"date={D2}"]), "pu") == [(3,)]
    s.rollback("revenue_daily", 1)
    assert s.versions("revenue_daily") == [1, 2, 3] and rows(s.read("revenue_daily"), "pu") == [(1,)]
    left, _ = s._stage("revenue_daily", _revenue(spark, (D3, "KR", 9)), ["date"])   # of a writer that died
    gone = s.vacuum("revenue_daily", keep=1)
    assert len(gone) == 2 and any(left in g for g in gone)
    assert s.versions("revenue_daily") == [3] and rows(s.read("revenue_daily"), "pu") == [(1,)]


def test_two_writers(spark):
    root = _root()
    a, b = TableStore(spark, root), TableStore(spark, root)
    a.replace("revenue_daily", _revenue(spark, (D1, "KR", 1)), ["date"], [(D1,)])
    # b publishes between a's staging and a's switch: both changes hold
    stage = a._stage

    def late(*args):
        out = stage(*args)
        a._stage = stage
        b.replace("revenue_daily", _revenue(spark, (D2, "KR", 2)), ["date"], [(D2,)])
        return out
    a._stage = late
    a.replace("revenue_daily", _revenue(spark, (D3, "KR", 3)), ["date"], [(D3,)])
    assert rows(a.read("revenue_daily"), "pu") == [(1,), (2,), (3,)]
    # the number is taken: not overwritten
    assert not a._put_new("revenue_daily/_manifests/000000000001.json", {})
    # cells read from a partition that another writer changes meanwhile are computed again
    cell = "date date, day int, cnt_o bigint, cnt bigint, rate double"
    a.replace_cells("retention_nu", spark.createDataFrame([(D1, 1, 1, 1, 1.0)], cell), "date", "day", [(D1, 1)])
    replace = a.replace

    def meanwhile(*args):
        a.replace = replace
        b.replace_cells("retention_nu", spark.createDataFrame([(D1, 2, 2, 2, 1.0)], cell), "date", "day", [(D1, 2)])
        return replace(*args)
    a.replace = meanwhile
    a.replace_cells("retention_nu", spark.createDataFrame([(D1, 3, 3, 3, 1.0)], cell), "date", "day", [(D1, 3)])
    assert rows(a.read("retention_nu"), "day") == [(1,), (2,), (3,)]
    with pytest.raises(Conflict):
        a._commit("retention_nu", lambda parts, n: parts, expect={f"date={D1}": [["other", 1]]})


def test_minute_upserts_write_their_rows_only(spark, monkeypatch):
    """K3: bytes written follow the new rows, not the day; the rows are the
    same before and after compaction."""
    monkeypatch.setattr(stores, "MAX_DELTAS", 8)
    s = TableStore(spark, _root())
    day = F.to_date("time")
    full = spark.range(20000).select((F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") * 4)).alias("time"),
                                     F.col("id").cast("int").alias("ccu"))
    s.upsert("crm_ccu", full, "time", "day", day)

    def size():
        return sum(f.stat().st_size for f in Path(s.root, "crm_ccu", "data").rglob("*.parquet"))
    before, want = size(), {r[0]: r[1] for r in full.collect()}
    written = []
    for i in range(7):
        stamp = ts(f"2024-01-01 0{i}:00:00")
        s.upsert("crm_ccu", spark.createDataFrame([(stamp, -i)], "time timestamp, ccu int"), "time", "day", day)
        want[stamp] = -i
        written.append(size() - before - sum(written))
    assert max(written) < before / 10
    rel, = s.partitions("crm_ccu")
    assert len(s.manifest("crm_ccu")["parts"][rel]) == 8
    assert {r[0]: r[1] for r in s.read("crm_ccu").collect()} == want
    s.upsert("crm_ccu", spark.createDataFrame([(ts("2024-01-01 01:00:00"), 77)], "time timestamp, ccu int"), "time", "day", day)
    want[ts("2024-01-01 01:00:00")] = 77
    assert len(s.manifest("crm_ccu")["parts"][rel]) == 1             # compacted
    assert {r[0]: r[1] for r in s.read("crm_ccu").collect()} == want


COMMANDS = ["AccountDaily", "PaidAccountDaily", "RevenueDaily", "Dau", "BasicDaily", "BasicWeekly", "Retention"]


def test_run_broken_after_any_table_ends_with_the_same_tables(spark):
    inputs, dates = fixture_inputs(spark, SF_SMALL), RunDates.between("2024-01-14", "2024-01-16")
    tables = output_tables(COMMANDS)
    whole = TableStore(spark, _root())
    daily_crm(inputs, whole, dates, COMMANDS, run_id="r1")
    want = {t: rows(whole.read(t)) for t in tables}
    for n in (0, 1, 2, 4, 8, 13, 17):
        root = _root()
        breaking = BreakingStore(spark, root)
        breaking.steps_left = n
        with pytest.raises(Broken):
            daily_crm(inputs, breaking, dates, COMMANDS, run_id="r1")
        store = TableStore(spark, root)
        if "r1" not in store.runs():
            continue
        marked = [t for t in tables if store.committed(t, "r1")]
        versions = {t: store.versions(t) for t in marked}
        resume_run(inputs, store, "r1")
        assert {t: rows(store.read(t)) for t in tables} == want
        assert all(store.versions(t) == versions[t] for t in marked)  # not written again
    assert daily_crm(inputs, whole, dates, COMMANDS, run_id="r1") == {t: [] for t in tables}
    with pytest.raises(ValueError):
        daily_crm(inputs, whole, dates, ["AccountDaily"], run_id="r1")


def test_bits_follow_account_daily(spark):
    """Only days written again get new sets; numbers never change."""
    store = TableStore(spark, _root())
    state = ActivityState(store)
    kind = "date date, oidaccount bigint, arenalevel smallint, isnew boolean, country string"

    def write(day, *accounts):
        store.replace("account_daily", spark.createDataFrame([(day, a, 1, False, c) for a, c in accounts], kind), ["date"], [(day,)])

    def counts(*days):
        got = ops.activity.distinct_accounts(state.bits(RunDates(days)), "country")
        return sorted((tuple(r) for r in got.collect()), key=str), ops.activity.distinct_accounts(state.bits(RunDates(days))).first()["au"]
    write(D1, (1, "KR"), (2, "KR"), (3, None), (4, "JP"), (4, "KR"))   # an account of two countries
    write(D2, (2, "KR"), (5, "JP"), (70000, "JP"))
    assert counts(D1, D2) == ([("JP", 3), ("KR", 3), (None, 1)], 6)
    first = rows(store.read("account_numbers"))
    version = store.versions("account_bits_daily")
    assert counts(D1)[1] == 4 and store.versions("account_bits_daily") == version
    write(D2, (9, "KR"))
    assert [str(d) for d in state.stale(RunDates([D1, D2]))] == [str(D2)]
    assert counts(D1, D2) == ([("JP", 1), ("KR", 4), (None, 1)], 5)
    assert set(first) <= set(rows(store.read("account_numbers")))
    numbers = store.read("account_numbers")
    assert numbers.count() == numbers.select("home", "shard", "seq").distinct().count() == numbers.select("oidaccount").distinct().count()
    write(D2)
    assert counts(D2) == ([], None)


def test_weekly_job_reads_no_account_row(spark):
    inputs = fixture_inputs(spark, SF_SMALL)
    store, dates = TableStore(spark, _root()), RunDates.between("2024-01-14", "2024-01-16")
    daily_crm(inputs, store, dates, ["AccountDaily", "PaidAccountDaily", "RevenueDaily", "Dau", "BasicDaily", "BasicDaily_Country"])
    job = DailyJob(inputs, dates, upstream=store.read, bits=ActivityState(store).bits)
    plain = DailyJob(inputs, dates, upstream=store.read)
    for table in ("basic_weekly", "basic_monthly", "basic_weekly_country", "basic_monthly_country"):
        df = job.output(table)
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "account_bits_daily" in text or "bits" in text
        assert "oidaccount" not in text
        assert rows(df) == rows(plain.output(table))


def test_replay_backfill_of_any_interval(spark):
    """The job without bounds picks every bucket of a 30-minute table."""
    kind = "uniqueKey string, dateHour string, arena int, score int, document string"
    data = [(f"k{b}{m}{a}{s}", f"20240116{b:02d}{m}", a, s, "x" * 50) for b in range(6) for m in ("00", "30") for a in (1, 2, 3) for s in range(4)]
    replay = spark.createDataFrame(data, kind)
    store = TableStore(spark, _root())
    replay_backfill_job(replay, store)
    want = sorted(r for r in data if r[2] >= 2 and r[3] == 3)
    assert rows(store.read("replay_pick").drop("day")) == want
    stepped = TableStore(spark, _root())
    replay_backfill_job(replay, stepped, "202401160000", "202401160200", 60)
    assert rows(stepped.read("replay_pick").drop("day")) == [r for r in want if r[1] in ("202401160000", "202401160100", "202401160200")]


def test_unpicked_documents_are_not_exchanged(spark):
    """Below every exchange of documents the winners' filter has
    been applied, with broadcasts off."""
    kind = "uniqueKey string, dateHour string, arena int, score int, document string"
    root = _root()
    data = [(f"k{i}", f"2024011600{i % 2}0", 2 + i % 2, i, "x" * 200) for i in range(4000)] + [("z", None, 2, 5, "x"), ("y", "202401160000", 5, None, "x")]
    spark.createDataFrame(data, kind).write.parquet(f"{root}/replay")
    replay = spark.read.parquet(f"{root}/replay")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        picks = ops.fetch_best(replay, F.lit(True))
        got = rows(picks)
        kept = json.loads(picks._jdf.queryExecution().executedPlan().toJSON())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert kept and got == rows(ops.pick_best(replay))
    filtered = [n for n in _scans(picks) if "document" in n]
    assert filtered and all("xxhash64" in n for n in filtered)


def _scans(df):
    """Plan text of each exchange's input."""
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return text.split("Exchange ")[1:]
