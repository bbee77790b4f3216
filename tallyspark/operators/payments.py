"""Purchases: payers (R3), product sales (R4, R5) and revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.payload import int4, json_fields
from tallyspark.rundates import RunDates
from tallyspark.sources.gamelogs import slice_log


def _purchases(log: DataFrame, dates: RunDates) -> DataFrame:
    p = json_fields("payload", "paytype", "productid", "price")
    return (slice_log(log, dates, "Shop:Buy")
            .select("date", "oidaccount", p.alias("p"))
            .select("date", "oidaccount", F.col("p.paytype").alias("paytype"),
                    int4(F.col("p.productid")).alias("productid"),
                    int4(F.col("p.price")).alias("price")))


def paid_account_daily(log: DataFrame, dates: RunDates) -> DataFrame:
    """Cash purchases per (date, account): count and amount."""
    return (_purchases(log, dates).where(F.col("paytype") == "Cash")
            .groupBy("date", "oidaccount")
            .agg(F.count(F.lit(1)).alias("cnt"), F.sum("price").alias("amount")))


def shop_product_daily(log: DataFrame, dates: RunDates) -> DataFrame:
    """All purchases per (date, paytype, productid)."""
    return (_purchases(log, dates)
            .groupBy("date", "paytype", "productid")
            .agg(F.count(F.lit(1)).alias("cnt"), F.sum("price").alias("amount")))


def shop_product_daily_country(log: DataFrame, staticaccount: DataFrame, dates: RunDates) -> DataFrame:
    """Purchases per (date, country, paytype, productid); a buyer missing from
    the country dimension counts under a NULL country.

    Purchases are first summed per account (map-side), so the dimension join
    sees one row per account and product, whatever one account buys."""
    per_account = (_purchases(log, dates)
                   .groupBy("date", "oidaccount", "paytype", "productid")
                   .agg(F.count(F.lit(1)).alias("cnt"), F.sum("price").alias("amount")))
    sa = staticaccount.select("oidaccount", "country")
    return (per_account.join(sa, "oidaccount", "left")
            .groupBy("date", "country", "paytype", "productid")
            .agg(F.sum("cnt").alias("cnt"), F.sum("amount").alias("amount")))


def revenue_daily(paid_account_df: DataFrame, staticaccount: DataFrame, dates: RunDates) -> DataFrame:
    """Payers and revenue per (date, country) from the paid-account table.
    No row on a day without payers."""
    sa = staticaccount.select("oidaccount", "country")
    return (paid_account_df.where(dates.date_filter("date"))
            .join(sa, "oidaccount", "left")
            .groupBy("date", "country")
            .agg(F.count(F.lit(1)).alias("pu"),
                 F.coalesce(F.sum("amount"), F.lit(0).cast("bigint")).alias("revenue")))
