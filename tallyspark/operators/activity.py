"""Bit sets of the accounts active on a day (distinct counts of R10-R13 from
mergeable state).

Every account gets a number once: ``seq``, counted up from 0 within its
``home`` (the least country it was first seen with) and one of ``SHARDS``
shards of it, so the accounts of a country lie close together and new accounts
are numbered by many tasks. A day's active accounts of a country are then bit
sets of 4 KB for each 32,768 numbers. Sets of several days are or'ed and their
bits counted: the exact number of different accounts, from a few sets a day
instead of all account rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 64
#: Bits of one set (the size that Spark's bitmap functions work on).
SET_BITS = 32768

NUMBERS = "oidaccount bigint, home string, seq bigint, shard int"
BITS = "country string, home string, shard int, slot bigint, bits binary, date date"


def new_numbers(account_daily_df: DataFrame, known: DataFrame) -> DataFrame:
    """(oidaccount, home, seq, shard) of the accounts that ``known`` lacks."""
    seen = account_daily_df.groupBy("oidaccount").agg(F.coalesce(F.min("country"), F.lit("")).alias("home"))
    new = (seen.join(known.select("oidaccount"), "oidaccount", "left_anti")
           .withColumn("shard", F.pmod(F.xxhash64("oidaccount"), F.lit(SHARDS)).cast("int")))
    used = known.groupBy("home", "shard").agg((F.max("seq") + 1).alias("used"))
    place = F.row_number().over(Window.partitionBy("home", "shard").orderBy("oidaccount")) - 1
    # The join comes before the window: both are dealt by (home, shard).
    return (new.join(used, ["home", "shard"], "left")
            .select("oidaccount", "home", (F.coalesce("used", F.lit(0)) + place).cast("bigint").alias("seq"), "shard"))


def day_bits(account_daily_df: DataFrame, numbers: DataFrame) -> DataFrame:
    """Bit sets of the active accounts per (date, country, home, shard, slot)."""
    return (account_daily_df.select("date", "oidaccount", "country").join(numbers, "oidaccount")
            .groupBy("country", "home", "shard", F.expr(f"seq div {SET_BITS}").alias("slot"), "date")
            .agg(F.bitmap_construct_agg(F.col("seq") % SET_BITS).alias("bits"))
            .select("country", "home", "shard", "slot", "bits", "date"))


def distinct_accounts(bits: DataFrame, *by: str) -> DataFrame:
    """(by..., au): different accounts of the sets of each group."""
    merged = bits.groupBy(*by, "home", "shard", "slot").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.sum(_count("bits")).alias("au"))


def _count(bits: str) -> Column:
    return F.bitmap_count(F.col(bits))
