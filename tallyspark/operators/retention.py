"""Retention cohorts.

For a run date ``D`` the cohorts are the account-daily rows of days
``D-1 .. D-7``, ``D-15`` and ``D-30``; an account is retained when it also has
a row on ``D``. ``cnt_o`` counts rows after the left join (so duplicate rows on
``D`` count twice, as in the reference), ``cnt`` the matched ones.

Set-based: each cohort row is expanded to the run dates it serves
(``day`` = offset); every (cohort date, day) cell comes from exactly one
run date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.rundates import RunDates

# Cohort offsets in days (D-1 .. D-7, D-15, D-30).
OFFSETS = (1, 2, 3, 4, 5, 6, 7, 15, 30)

COHORTS = ("all", "new", "new_paying")


def _cohort_filter(cohort: str):
    """Filter on the cohort rows: every account, new accounts, or new
    accounts past level 0."""
    if cohort == "all":
        return None
    if cohort == "new":
        return F.col("isnew")
    if cohort == "new_paying":
        return F.col("isnew") & (F.col("arenalevel") > 0)
    raise ValueError(f"unknown cohort {cohort!r}")


def cohort_dates(dates: RunDates) -> RunDates:
    """Days whose account-daily rows a retention run reads."""
    return dates.shifted([-k for k in OFFSETS]).union(dates)


def retention(account_daily_df: DataFrame, dates: RunDates, cohort: str = "all",
              by: str | None = "arenalevel") -> DataFrame:
    """Retention table: (date, day[, by], cnt_o, cnt, rate).

    One pass over the account-daily rows: each row emits one entry per run
    date it is a cohort row for (``target = date + day``) and, when its own
    date is a run date, one "returning" entry. A window over (account,
    target) counts the returning rows ``r``; a cohort row then stands for
    ``max(r, 1)`` rows of the reference's left join (``cnt_o``) of which
    ``r`` matched (``cnt``). The account-daily rows are read once; no join.
    """
    keys = [by] if by else []
    cohort_days = dates.shifted([-k for k in OFFSETS])
    src = account_daily_df.where(cohort_dates(dates).date_filter("date"))
    flt = _cohort_filter(cohort)
    as_cohort = cohort_days.date_filter("date") if flt is None else (cohort_days.date_filter("date") & flt)
    cohort_entries = F.filter(
        F.array(*[F.struct(F.date_add("date", k).alias("target"), F.lit(k).alias("day"))
                  for k in OFFSETS]),
        lambda e: dates.date_filter(e["target"]))
    returning_entry = F.array(F.struct(F.col("date").alias("target"), F.lit(0).alias("day")))
    entries = F.concat(
        F.when(F.coalesce(as_cohort, F.lit(False)), cohort_entries).otherwise(F.array().cast(cohort_entries_type())),
        F.when(dates.date_filter("date") & F.col("oidaccount").isNotNull(), returning_entry).otherwise(F.array().cast(cohort_entries_type())))
    # Rows are dealt by account before each is expanded to its run dates: that
    # one shuffle of the unexpanded rows serves both the count and the window.
    # Identical entries (duplicate account-daily rows) collapse to a count
    # ``m`` first, so the window sees a few rows per key.
    src = src.select("oidaccount", "date", *(["isnew"] if cohort != "all" else []),
                     *(["arenalevel"] if cohort == "new_paying" and by != "arenalevel" else []), *keys)
    counted = (src.repartition("oidaccount").select("oidaccount", "date", *keys, F.explode(entries).alias("e"))
               .groupBy("oidaccount", F.col("e.target").alias("target"), "date", F.col("e.day").alias("day"), *keys)
               .agg(F.count(F.lit(1)).alias("m")))
    per_key = Window.partitionBy("oidaccount", "target")
    marked = counted.withColumn("r", F.sum(F.when(F.col("day") == 0, F.col("m")).otherwise(0)).over(per_key))
    return (marked.where(F.col("day") > 0)
            .groupBy("date", "day", *keys)
            .agg(F.sum(F.col("m") * F.greatest(F.col("r"), F.lit(1))).alias("cnt_o"),
                 F.sum(F.col("m") * F.col("r")).alias("cnt"))
            .select("date", "day", *keys, "cnt_o", "cnt",
                    (F.col("cnt").cast("double") / F.col("cnt_o")).alias("rate")))


def cohort_entries_type() -> str:
    return "array<struct<target:date,day:int>>"
