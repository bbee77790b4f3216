"""Date lists of any length: consecutive and scattered."""

import datetime as dt

import pytest

from helpers import make_inputs, rows

from tallyspark.plans.daily import DailyJob
from tallyspark.plans.jobs import replace_keys
from tallyspark.rundates import RunDates
from tallyspark.sinks.store import TableStore, purge_partitions_before


def day(n: int) -> dt.date:
    return dt.date(2015, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def inputs(spark):
    logs = [(1, f"{day(7 * i)}T10:00:00", "Jewel:Gain", {"reason": "r", "delta": i}) for i in range(600)]
    logs += [(1, f"{day(7 * i + 1)}T00:00:00", "Jewel:Gain", {"reason": "midnight", "delta": 1}) for i in range(600)]
    logs += [(1, f"{day(7 * i + 3)}T10:00:00", "Jewel:Gain", {"reason": "off", "delta": 1}) for i in range(600)]
    return make_inputs(spark, logs)


@pytest.mark.parametrize("dates", [RunDates(day(7 * i) for i in range(600)), RunDates(day(i) for i in range(3650))], ids=["weekly", "daily"])
def test_long_date_lists_plan_and_run(inputs, dates):
    out = DailyJob(inputs, dates).output("jewel_stats_daily").collect()
    seen = {r["date"] for r in out}
    assert {day(7 * i) for i in range(500)} <= seen <= set(dates)
    if len(dates) == 600:  # events off the run dates are left out, one at the midnight after a run date is in
        assert {r["reason"] for r in out} == {"r", "midnight"}


def test_a_year_of_cells_is_replaced_in_a_filled_table(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), {"cells": "date date, day int, v int"})
    dates = RunDates(day(i) for i in range(365))
    cells = replace_keys("retention", dates)
    old = spark.createDataFrame([(day(100), 1, 1), (day(100), 99, 2), (day(-30), 30, 3), (day(-30), 29, 4)], "date date, day int, v int")
    store.replace("cells", old, ["date"], [(day(100),), (day(-30),)])
    store.replace_cells("cells", spark.createDataFrame([(day(100), 2, 9)], "date date, day int, v int"), "date", "day", cells)
    assert rows(store.read("cells"), "date", "day", "v") == [(day(-30), 29, 4), (day(100), 2, 9), (day(100), 99, 2)]


def test_purge_keeps_rows_without_a_day(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), {"log": "time timestamp, event_date date"})
    df = spark.createDataFrame([(None, None), (dt.datetime(2024, 1, 1), dt.date(2024, 1, 1)), (dt.datetime(2024, 3, 1, 5), dt.date(2024, 3, 1)),
                                (dt.datetime(2024, 3, 1, 7), dt.date(2024, 3, 1))], "time timestamp, event_date date")
    store.overwrite("log", df, ["event_date"])
    assert purge_partitions_before(store, "log", "event_date", "time", dt.datetime(2024, 3, 1, 6)) == ["event_date=2024-01-01"]
    assert rows(store.read("log"), "time") == [(dt.datetime(2024, 3, 1, 7),), (None,)]
