"""Daily headline numbers (R8) and the same by country."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.dates import event_run_dates
from tallyspark.rundates import RunDates


def _zero():
    return F.lit(0).cast("bigint")


def basic_daily(footprint: DataFrame, dau_df: DataFrame, revenue_df: DataFrame,
                ccu_df: DataFrame, dates: RunDates) -> DataFrame:
    """Always one row per run date.

    ru: accounts created before the next midnight (running total over all
    history); nru: accounts created within the day, half-open; dau / dau_p:
    sums of the DAU table (all levels / level > 0); dpu, revenue: sums of the
    revenue table; mcu: highest CCU in the closed day slice, NULL if none.

    Every side is first reduced to at most one row per day; the sides and
    the run-date list are then stacked and grouped by day (one shuffle of
    calendar-sized data, instead of one join per side).
    """
    spark = footprint.sparkSession
    days = dates.frame(spark)
    # ru counts every row (count(*)), nru the account id (count(oidaccount)).
    accounts = (footprint.where(F.col("created").isNotNull())
                .groupBy(F.to_date("created").alias("date"))
                .agg(F.count(F.lit(1)).alias("n"), F.count("oidaccount").alias("nru"))
                .where(F.col("date") <= F.lit(dates.last)))
    levels = (dau_df.where(dates.date_filter("date")).groupBy("date")
              .agg(F.sum("dau").alias("dau"),
                   F.sum(F.when(F.col("arenalevel") > 0, F.col("dau"))).alias("dau_p")))
    money = (revenue_df.where(dates.date_filter("date")).groupBy("date")
             .agg(F.sum("pu").alias("dpu"), F.sum("revenue").alias("revenue")))
    peak = (ccu_df.where(dates.time_filter("time"))
            .select(F.explode(event_run_dates("time")).alias("date"), "ccu")
            .where(dates.date_filter("date"))
            .groupBy("date").agg(F.max("ccu").alias("mcu")))
    stacked = days.withColumn("run", F.lit(True))
    for side in (accounts, levels, money, peak):
        stacked = stacked.unionByName(side, allowMissingColumns=True)
    per_day = stacked.groupBy("date").agg(
        F.bool_or("run").alias("run"), F.sum("n").alias("n"), F.max("nru").alias("nru"),
        F.max("dau").alias("dau"), F.max("dau_p").alias("dau_p"), F.max("dpu").alias("dpu"),
        F.max("revenue").alias("revenue"), F.max("mcu").alias("mcu"))
    # Running total over one row per calendar day (no partition key needed).
    running = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = per_day.withColumn("ru", F.sum(F.coalesce("n", _zero())).over(running)).where(F.col("run"))
    return out.select(
        "date", F.col("ru").cast("bigint").alias("ru"),
        *[F.coalesce(c, _zero()).alias(c) for c in ("nru", "dau", "dau_p", "dpu", "revenue")],
        "mcu")


def new_accounts_per_day(footprint: DataFrame, dates: RunDates) -> DataFrame:
    """(date, nru) for the run dates: accounts created within the day,
    half-open, as basic-daily counts them."""
    return (footprint.where(dates.time_filter("created") & (F.to_date("created") <= F.lit(dates.last)))
            .groupBy(F.to_date("created").alias("date"))
            .agg(F.count("oidaccount").alias("nru"))
            .where(dates.date_filter("date")))


def basic_daily_country(account_daily_df: DataFrame, footprint: DataFrame, staticaccount: DataFrame,
                        revenue_df: DataFrame, dates: RunDates) -> DataFrame:
    """Per (date, country): nru, dau, dau_p, dpu, revenue.

    Active accounts are re-joined to the country dimension (not the country
    stored in the account-daily row). New accounts use a closed day slice on
    ``created``. The two sides meet in a full outer join on plain equality,
    so NULL countries never match and can give two rows. Revenue joins on the
    active side's country only: a country without logins gets revenue 0.
    """
    sa = staticaccount.select("oidaccount", "country")
    active = (account_daily_df.where(dates.date_filter("date"))
              .select("date", "oidaccount", "arenalevel")
              .join(sa, "oidaccount", "left")
              .groupBy("date", "country")
              .agg(F.count(F.lit(1)).alias("dau"),
                   F.count(F.when(F.col("arenalevel") > 0, F.lit(1))).alias("dau_p")))
    new = (footprint.where(dates.time_filter("created"))
           .select("oidaccount", F.explode(event_run_dates("created")).alias("date"))
           .where(dates.date_filter("date"))
           .join(sa, "oidaccount", "left")
           .groupBy("date", "country")
           .agg(F.count(F.lit(1)).alias("nru")))
    rev = revenue_df.where(dates.date_filter("date")).select("date", "country", "pu", "revenue")

    active, new, paid = active.alias("active"), new.alias("new"), rev.alias("paid")
    same = lambda a, b: (F.col(f"{a}.date") == F.col(f"{b}.date")) & (F.col(f"{a}.country") == F.col(f"{b}.country"))
    full = active.join(new, same("active", "new"), "full").join(paid, same("active", "paid"), "left")
    return full.select(
        F.coalesce("active.date", "new.date").alias("date"),
        F.coalesce("active.country", "new.country").alias("country"),
        F.coalesce("new.nru", _zero()).alias("nru"),
        F.coalesce("active.dau", _zero()).alias("dau"),
        F.coalesce("active.dau_p", _zero()).alias("dau_p"),
        F.coalesce("paid.pu", _zero()).alias("dpu"),
        F.coalesce("paid.revenue", _zero()).alias("revenue"))
