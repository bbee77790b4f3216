"""Plan shape: the properties that matter at scale, pinned on the physical
plans (pruning, pushdown, partial aggregation before shuffles, no Python
evaluation, no nested-loop joins)."""

import re

import pytest

from helpers import SF_SMALL

import __spark_entry__ as entry
from tallyspark import operators as ops
from tallyspark.plans.daily import DailyJob
from tallyspark.rundates import RunDates
from tallyspark.sources.inputs import fixture_inputs

BAD = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def inputs(spark):
    return fixture_inputs(spark, SF_SMALL)


@pytest.mark.parametrize("name", sorted(k for k in entry.queries() if not re.match(r"op\d+_|pipeline$", k)))
def test_no_python_or_nested_loop(spark, name):
    p = plan(entry.queries()[name](spark, SF_SMALL))
    assert not [b for b in BAD if b in p]


def test_log_scan_is_pruned_and_pushed(spark, inputs):
    df = DailyJob(inputs, RunDates(["2024-01-16"])).output("account_daily")
    formatted = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    scan = re.search(r"\(\d+\) Scan parquet[^\n]*\n(.*?)\n\n", formatted, re.S).group(1)
    assert "event_date" in scan.split("PartitionFilters")[1].split("\n")[0]
    pushed = scan.split("PushedFilters")[1].split("\n")[0]
    assert "In(command, [Login,Transfer])" in pushed and "GreaterThanOrEqual(time" in pushed
    read = scan.split("ReadSchema")[1].split("\n")[0]
    assert "event_date" not in read and set(re.findall(r"(\w+):", read)) == {"oidaccount", "time", "command", "payload"}


def test_account_daily_reduces_before_first_shuffle(spark, inputs):
    p = plan(DailyJob(inputs, RunDates.between("2024-01-01", "2024-01-30")).output("account_daily"))
    first_exchange = p.rfind("Exchange hashpartitioning")
    assert first_exchange > 0
    below = p[first_exchange:]
    assert "partial_max((command" in below and "partial_max(CASE WHEN" in below   # bool_or runs as max


def test_retention_reads_the_log_once(spark, inputs):
    p = plan(DailyJob(inputs, RunDates.between("2024-01-01", "2024-01-30")).output("retention"))
    assert p.count("gamelogs") == 1
    assert "SortMergeJoin" not in p


def test_replay_pick_is_partial_min_not_a_window(spark, inputs):
    p = plan(ops.pick_best(inputs.replay))
    assert "partial_min" in p and "Window" not in p


def test_country_sales_reduce_per_account_before_join(spark, inputs):
    p = plan(ops.shop_product_daily_country(inputs.gamelogs, inputs.staticaccount,
                                            RunDates.between("2024-01-01", "2024-01-30")))
    join = p.find("Join")
    assert "partial_count" in p[join:] or "partial_sum" in p[join:]


def test_bucketed_dimensions_are_not_shuffled(spark, inputs):
    import tempfile

    from helpers import rows

    from tallyspark.sources.dimensions import with_bucketed_dimensions
    bucketed = with_bucketed_dimensions(inputs, 4, root=tempfile.mkdtemp(prefix="ts-dims-"))
    dates = RunDates.between("2024-01-01", "2024-01-30")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # as with large dimensions
    try:
        df = ops.account_daily(bucketed.gamelogs, bucketed.footprint, bucketed.staticaccount, dates)
        p = plan(df)
        assert p.count("Bucketed: true") == 2 and p.count("SortMergeJoin") == 2
        # only the log side is shuffled: by (date, account) for the map-side
        # reduction, then by account for the joins; plain dimensions add two more
        assert p.count("Exchange hashpartitioning") == 2
        plain = plan(ops.account_daily(inputs.gamelogs, inputs.footprint, inputs.staticaccount, dates))
        assert plain.count("Exchange hashpartitioning") == 4
        expect = ops.account_daily(inputs.gamelogs, inputs.footprint, inputs.staticaccount, dates)
        assert rows(df) == rows(expect)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_retention_shuffles_once_by_account(spark):
    """Stored account-daily rows: one exchange by account before the final group-by."""
    rows = spark.range(1000).selectExpr("id as oidaccount", "date'2024-01-10' + cast(id % 9 as int) as date",
                                        "cast(1 as smallint) as arenalevel", "true as isnew", "'x' as country")
    p = plan(ops.retention(rows, RunDates.between("2024-01-05", "2024-02-05")))
    assert p.count("Exchange hashpartitioning(oidaccount") == 1
    assert p.count("Exchange") == 2


def test_table_mode_plans(spark, tmp_path):
    """The production path: roll-ups that read what earlier ones stored."""
    from tallyspark.plans.jobs import daily_crm
    from tallyspark.sinks.store import TableStore

    inputs = fixture_inputs(spark, SF_SMALL)
    store, dates = TableStore(spark, str(tmp_path)), RunDates(["2024-01-16", "2024-01-17"])
    commands = ["AccountDaily", "PaidAccountDaily", "RevenueDaily", "Dau"]
    daily_crm(inputs, store, dates, commands)
    job = DailyJob(inputs, dates, upstream=store.read)
    for table in ("basic_daily", "basic_daily_country", "retention"):
        assert not [b for b in BAD if b in plan(job.output(table))]
