"""Daily active accounts (R1, R2) and DAU by level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.payload import int2, json_fields
from tallyspark.rundates import RunDates
from tallyspark.sources.gamelogs import slice_log


def account_daily(log: DataFrame, footprint: DataFrame, staticaccount: DataFrame,
                  dates: RunDates) -> DataFrame:
    """One row per (date, account, creation day, country) with a Login.

    ``arenalevel`` is the highest ``mysticorblevel`` of the day, ``isnew``
    whether the account was created that day (NULL when ``created`` is NULL).
    Both dimensions are inner-joined, so an account missing from either is
    dropped and an account with two dimension rows yields two rows. New
    accounts with a ``Transfer`` event that day are removed; returning
    accounts with a transfer, and rows whose ``isnew`` is NULL, are kept.

    Logins and transfers come from one scan and are reduced to one row per
    (date, account) before anything else (partial aggregation in every
    task), so a single very active account never lands whole in one join
    task, and the transfer test needs no second shuffle.
    """
    is_login = F.col("command") == "Login"
    level = int2(json_fields("payload", "mysticorblevel")["mysticorblevel"])
    per_account = (slice_log(log, dates, ["Login", "Transfer"])
                   .groupBy("date", "oidaccount")
                   .agg(F.max(F.when(is_login, level)).alias("lvl"),
                        F.bool_or(is_login).alias("has_login"),
                        F.bool_or(F.col("command") == "Transfer").alias("has_transfer"))
                   .where(F.col("has_login")))
    fp = footprint.select("oidaccount", F.to_date("created").alias("cday"))
    sa = staticaccount.select("oidaccount", "country")
    joined = per_account.join(fp, "oidaccount").join(sa, "oidaccount")
    daily = (joined.groupBy("date", "oidaccount", "cday", "country")
             .agg(F.max("lvl").alias("arenalevel"), F.bool_or("has_transfer").alias("has_transfer"))
             .withColumn("isnew", F.col("cday") == F.col("date")))
    # The reference deletes rows where ``isnew and <transfer>`` is true; a
    # NULL ``isnew`` is not true, so those rows stay.
    removed = F.coalesce(F.col("isnew") & F.col("has_transfer"), F.lit(False))
    return daily.where(~removed).select("date", "oidaccount", "arenalevel", "isnew", "country")


def dau(account_daily_df: DataFrame, dates: RunDates) -> DataFrame:
    """Accounts per (date, arenalevel) of the account-daily table."""
    return (account_daily_df.where(dates.date_filter("date"))
            .groupBy("date", "arenalevel")
            .agg(F.count(F.lit(1)).alias("dau")))
