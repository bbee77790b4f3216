"""Weekly (Sunday-start) and monthly roll-ups of the daily tables.

A run date touches one week and one month. Each touched period is computed
once; its row is keyed by the period's first day. In "log" mode (the default)
the daily inputs are read for the period's days up to the latest run date in
it, i.e. what a daily schedule has written by then. In "table" mode (reading
stored daily tables) every stored day of the period counts, as in the
reference.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.activity import distinct_accounts
from tallyspark.rundates import ONE_DAY, RunDates

def _zero():
    return F.lit(0).cast("bigint")


def period_start(d: dt.date, period: str) -> dt.date:
    if period == "week":
        return d - dt.timedelta(days=d.isoweekday() % 7)  # back to Sunday
    if period == "month":
        return d.replace(day=1)
    raise ValueError(f"unknown period {period!r}")


def period_end(d: dt.date, period: str) -> dt.date:
    start = period_start(d, period)
    if period == "week":
        return start + dt.timedelta(days=6)
    nxt = (start.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return nxt - ONE_DAY


def period_days(dates: RunDates, period: str, through_last_run_date: bool = True) -> list[tuple[dt.date, dt.date]]:
    """(day, period start) pairs of the periods the run dates touch."""
    last_in: dict[dt.date, dt.date] = {}
    for d in dates:
        p = period_start(d, period)
        last_in[p] = max(last_in.get(p, d), d)
    pairs = []
    for p, last in sorted(last_in.items()):
        stop = last if through_last_run_date else period_end(p, period)
        day = p
        while day <= stop:
            pairs.append((day, p))
            day += ONE_DAY
    return pairs


def period_input_dates(dates: RunDates, period: str, through_last_run_date: bool = True) -> RunDates:
    """Days of daily tables a periodic run reads."""
    return RunDates(day for day, _ in period_days(dates, period, through_last_run_date))


def _tag_with(pdate):
    # one-argument lambda: transform() passes (element, index) to two-argument ones
    return lambda x: F.struct(x.alias("day"), F.lit(pdate).alias("pdate"))


def _day_map(spark, dates, period, through):
    """(day, pdate) rows: at most 31 per touched period, a calendar-sized
    broadcast generated inside the JVM."""
    spans = {}
    for day, p in period_days(dates, period, through):
        lo, hi = spans.get(p, (day, day))
        spans[p] = (min(lo, day), max(hi, day))
    rows = [F.transform(F.sequence(F.lit(lo), F.lit(hi)), _tag_with(p))
            for p, (lo, hi) in sorted(spans.items())]
    arr = rows[0] if len(rows) == 1 else F.flatten(F.array(*rows))
    return F.broadcast(spark.range(1).select(F.explode(arr).alias("m")).select("m.day", "m.pdate"))


def _bucketed(df: DataFrame, day_map: DataFrame) -> DataFrame:
    return df.join(day_map, df["date"] == day_map["day"]).drop("day")


def _accounts(account_daily_df: DataFrame | None, bits: DataFrame | None, day_map: DataFrame, *by: str) -> DataFrame:
    if bits is not None:
        return distinct_accounts(_bucketed(bits, day_map), *by)
    return _bucketed(account_daily_df, day_map).groupBy(*by).agg(F.countDistinct("oidaccount").alias("au"))


def basic_period(basic_daily_df: DataFrame, account_daily_df: DataFrame, revenue_df: DataFrame,
                 dates: RunDates, period: str, through_last_run_date: bool = True, bits: DataFrame | None = None) -> DataFrame:
    """One row per touched period: nru (sum of daily nru), au (distinct
    accounts), pu (sum of daily payer counts, not distinct payers), revenue.
    ``basic_daily_df`` needs only (date, nru). With ``bits`` (the days' bit
    sets of accounts, see ``activity``) no account row is read."""
    spark = basic_daily_df.sparkSession
    day_map = _day_map(spark, dates, period, through_last_run_date)
    nru = _bucketed(basic_daily_df, day_map).groupBy("pdate").agg(F.sum("nru").alias("nru"))
    au = _accounts(account_daily_df, bits, day_map, "pdate")
    money = (_bucketed(revenue_df, day_map).groupBy("pdate")
             .agg(F.sum("pu").alias("pu"), F.sum("revenue").alias("revenue")))
    # Always one row per touched period: stack the period list with the
    # per-period sides (each at most one row per period) and group once.
    stacked = day_map.select("pdate").distinct()
    for side in (nru, au, money):
        stacked = stacked.unionByName(side, allowMissingColumns=True)
    out = stacked.groupBy("pdate").agg(*[F.max(c).alias(c) for c in ("nru", "au", "pu", "revenue")])
    return out.select(F.col("pdate").alias("date"),
                      *[F.coalesce(c, _zero()).alias(c) for c in ("nru", "au", "pu", "revenue")])


def basic_period_country(basic_daily_country_df: DataFrame, account_daily_df: DataFrame,
                         revenue_df: DataFrame, dates: RunDates, period: str,
                         through_last_run_date: bool = True, bits: DataFrame | None = None) -> DataFrame:
    """Per (period, country), anchored on the countries of the daily-country
    table. Distinct accounts and revenue attach by the account-daily row's
    own country and plain equality, so the NULL country gets au = pu =
    revenue = 0 and a country with payers only is absent."""
    spark = basic_daily_country_df.sparkSession
    day_map = _day_map(spark, dates, period, through_last_run_date)
    a = (_bucketed(basic_daily_country_df, day_map).groupBy("pdate", "country")
         .agg(F.sum("nru").alias("nru"))).alias("a")
    b = _accounts(account_daily_df, bits, day_map, "pdate", "country").alias("b")
    c = (_bucketed(revenue_df, day_map).groupBy("pdate", "country")
         .agg(F.sum("pu").alias("pu"), F.sum("revenue").alias("revenue"))).alias("c")
    on_b = (F.col("a.pdate") == F.col("b.pdate")) & (F.col("a.country") == F.col("b.country"))
    on_c = (F.col("a.pdate") == F.col("c.pdate")) & (F.col("a.country") == F.col("c.country"))
    out = a.join(b, on_b, "left").join(c, on_c, "left")
    return out.select(F.col("a.pdate").alias("date"), F.col("a.country").alias("country"),
                      F.coalesce("a.nru", _zero()).alias("nru"), F.coalesce("b.au", _zero()).alias("au"),
                      F.coalesce("c.pu", _zero()).alias("pu"), F.coalesce("c.revenue", _zero()).alias("revenue"))
