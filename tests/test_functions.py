import datetime as dt

from helpers import ts

from pyspark.sql import functions as F

from tallyspark.functions.dates import (bucket_key_before, bucket_series, event_run_dates, first_day_of_month,
                                        first_day_of_week, last_day_of_month, last_day_of_week, minute_floor)
from tallyspark.functions.hashes import bind_hashes
from tallyspark.operators.periodic import period_days, period_end, period_start
from tallyspark.plans.replay import bucket_keys, previous_bucket
from tallyspark.rundates import RunDates, date_series


def test_week_and_month_helpers(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 16),), (dt.date(2024, 1, 14),), (dt.date(2024, 2, 29),)], "d date")
    got = df.select("d", first_day_of_week("d", "sunday").alias("ws"), last_day_of_week("d", "sunday").alias("we"),
                    first_day_of_week("d").alias("mon"), first_day_of_month("d").alias("ms"),
                    last_day_of_month("d").alias("me")).orderBy("d").collect()
    assert [(r.ws, r.we, r.mon, r.ms, r.me) for r in got] == [
        (dt.date(2024, 1, 14), dt.date(2024, 1, 20), dt.date(2024, 1, 8), dt.date(2024, 1, 1), dt.date(2024, 1, 31)),
        (dt.date(2024, 1, 14), dt.date(2024, 1, 20), dt.date(2024, 1, 15), dt.date(2024, 1, 1), dt.date(2024, 1, 31)),
        (dt.date(2024, 2, 25), dt.date(2024, 3, 2), dt.date(2024, 2, 26), dt.date(2024, 2, 1), dt.date(2024, 2, 29)),
    ]
    for d in (dt.date(2024, 1, 16), dt.date(2024, 1, 14), dt.date(2024, 2, 29)):
        assert period_start(d, "week") == [r.ws for r in got if r.d == d][0]
    assert period_end(dt.date(2024, 2, 10), "month") == dt.date(2024, 2, 29)


def test_event_run_dates_and_minute_floor(spark):
    df = spark.createDataFrame([(ts("2024-01-17 00:00:00"),), (ts("2024-01-17 00:00:00.000001"),)], "t timestamp")
    got = df.select(event_run_dates("t").alias("ds"), minute_floor("t").alias("m")).collect()
    assert got[0].ds == [dt.date(2024, 1, 17), dt.date(2024, 1, 16)]
    assert got[1].ds == [dt.date(2024, 1, 17)] and got[1].m == dt.datetime(2024, 1, 17)


def test_bucket_keys_python_and_spark_agree(spark):
    df = spark.createDataFrame([(ts("2024-01-16 13:47:30"),)], "now timestamp")
    assert df.select(bucket_key_before("now", 60)).first()[0] == previous_bucket(dt.datetime(2024, 1, 16, 13, 47, 30)) \
        == "202401161200"
    assert previous_bucket(dt.datetime(2024, 1, 16, 13, 47), 15) == "202401161330"
    row = spark.range(1).select(bucket_series(F.lit("202401161200"), F.lit("202401161400"), 60).alias("s"),
                                bucket_series(F.lit("202401161200"), F.lit("202401161000"), 60).alias("e")).first()
    assert row.s == bucket_keys("202401161200", "202401161400") == ["202401161200", "202401161300", "202401161400"]
    assert row.e == bucket_keys("202401161200", "202401161000") == ["202401161200"]


def test_date_series_and_run_dates(spark):
    assert date_series("2024-01-05", "2024-01-03") == [dt.date(2024, 1, 5)]
    rd = RunDates(["2024-01-03", "2024-01-01", "2024-01-02", "2024-01-07"])
    assert rd.ranges() == [(dt.date(2024, 1, 1), dt.date(2024, 1, 3)), (dt.date(2024, 1, 7), dt.date(2024, 1, 7))]
    assert [r.date for r in rd.frame(spark).collect()] == list(rd.values)
    assert len(period_days(RunDates(["2024-01-16"]), "week")) == 3          # Sun 14 .. Tue 16
    assert len(period_days(RunDates(["2024-01-16"]), "week", False)) == 7


def test_bind_hashes(spark):
    entries = spark.createDataFrame([
        ("ServerDesc:1", "numCCU", "12"), ("ServerDesc:1", "dtmUpdated", "2024-01-16 11:59:00"),
        ("ServerDesc:1", "IsActive", "False"), ("ServerDesc:1", "Unknown", "x"),
        ("ServerDesc:2", "numCCU", "not-a-number"),
    ], "hashkey string, field string, value string")
    got = {r.hashkey: r for r in bind_hashes(entries).collect()}
    assert (got["ServerDesc:1"].numCCU, got["ServerDesc:1"].IsActive) == (12, False)
    assert got["ServerDesc:1"].dtmUpdated == dt.datetime(2024, 1, 16, 11, 59)
    assert got["ServerDesc:2"].numCCU is None


def test_in_bucket_series_equals_listed_keys(spark):
    from tallyspark.functions.dates import in_bucket_series
    keys = ["202401161100", "202401161200", "202401161230", "202401161300", "202401161400", "20240116130",
            "2024011613000", "202401161500", "junk", None]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for start, end, step in (("202401161200", "202401161400", 60), ("202401161200", "202401161400", 30),
                             ("202401161300", "202401161200", 60)):
        listed = set(bucket_keys(start, end, step))
        got = {r.k for r in df.where(in_bucket_series("k", start, end, step)).collect()}
        assert got == listed & set(k for k in keys if k), (start, end, step)


def test_checkpoint_dir_is_read_from_the_session(spark):
    from tallyspark.session import ensure_checkpoint_dir
    before = spark.conf.get("spark.checkpoint.dir")
    assert before and ensure_checkpoint_dir(spark) == before   # an existing setting is kept as is


def test_run_date_guards_and_odd_intervals():
    import pytest

    with pytest.raises(ValueError):
        RunDates([])
    # buckets of 25 minutes restart at every hour, as the reference's arithmetic does
    assert previous_bucket(dt.datetime(2024, 1, 16, 13, 47), 25) == "202401161300"
    assert previous_bucket(dt.datetime(2024, 1, 16, 13, 10), 25) == "202401161235"   # 13:10 - (25 + 10)
    assert RunDates(["2024-01-02", "2024-01-01"]).values == (dt.date(2024, 1, 1), dt.date(2024, 1, 2))
