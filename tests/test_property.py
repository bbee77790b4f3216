"""Property: a set-based run over any set of dates equals the union of
single-date runs (every per-date output; periodic outputs are keyed by
period and covered by the backfill tests)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import SF_SMALL, rows

from tallyspark.plans.daily import DailyJob
from tallyspark.rundates import RunDates
from tallyspark.sources.inputs import fixture_inputs

TABLES = ("account_daily", "dau", "basic_daily", "basic_daily_country", "retention_country",
          "match_eloband_stats_daily", "shop_product_daily_country")
DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(30)]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.sampled_from(DAYS), min_size=2, max_size=3))
def test_set_based_equals_single_dates(spark, days):
    inputs = fixture_inputs(spark, SF_SMALL)
    together = DailyJob(inputs, RunDates(days))
    for t in TABLES:
        single = []
        for d in sorted(days):
            single += rows(DailyJob(inputs, RunDates([d])).output(t))
        assert rows(together.output(t)) == sorted(single, key=lambda r: tuple((x is None, str(x)) for x in r)), t


def test_midnight_neighbours(spark):
    # 2024-01-16 and 2024-01-17 share the 40 rows stamped 2024-01-17 00:00:00.
    inputs = fixture_inputs(spark, SF_SMALL)
    both = DailyJob(inputs, RunDates(["2024-01-16", "2024-01-17"])).output("account_daily")
    one = DailyJob(inputs, RunDates(["2024-01-16"])).output("account_daily")
    two = DailyJob(inputs, RunDates(["2024-01-17"])).output("account_daily")
    assert both.count() == one.count() + two.count()
