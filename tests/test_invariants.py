"""Invariants over the fixture tables."""

from helpers import SF_SMALL

from pyspark.sql import functions as F

from tallyspark.plans.daily import DailyJob
from tallyspark.rundates import RunDates
from tallyspark.sources.inputs import fixture_inputs


def _job(spark):
    inputs = fixture_inputs(spark, SF_SMALL)
    return DailyJob(inputs, RunDates.spanning(inputs.gamelogs))


def _sum(df, col):
    return df.agg(F.sum(col)).first()[0] or 0


def test_dau_sums_to_account_rows(spark):
    job = _job(spark)
    assert _sum(job.output("dau"), "dau") == job.output("account_daily").count()


def test_retention_bounds(spark):
    job = _job(spark)
    for t in ("retention", "retention_nu", "retention_nu_p", "retention_country", "retention_country_p"):
        df = job.output(t)
        assert _sum(df, "cnt") <= _sum(df, "cnt_o")
        assert df.where((F.col("rate") < 0) | (F.col("rate") > 1)).count() == 0


def test_cardweight_outputs_share_one_slice(spark):
    job = _job(spark)
    sums = {_sum(job.output(t), "cnt") for t in ("cardweight_winningrate_daily", "cardweight_distribution_daily",
                                                  "cardweight_stats_daily")}
    assert len(sums) == 1


def test_country_split_preserves_sales_with_unique_dimension(spark):
    job = _job(spark)
    assert _sum(job.output("shop_product_daily_country"), "cnt") == _sum(job.output("shop_product_daily"), "cnt")


def test_new_users_in_periods(spark):
    job = _job(spark)
    assert _sum(job.output("basic_monthly"), "nru") == _sum(job.output("basic_daily"), "nru")
