"""The daily job (R33): commands, their dependencies, set-based plans.

``DailyJob`` builds every output for a set of run dates as one DataFrame per
output table. In log mode (no ``upstream``) the daily tables a later command
needs (account-daily rows of retention cohorts, the days of a touched week or
month) are computed from the log for exactly the days needed, as if a daily
schedule had filled them. In table mode (``upstream`` reads stored tables)
later commands read the stored tables, as the reference does, which also
cuts the lineage between commands.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.storagelevel import StorageLevel

from tallyspark import operators as ops
from tallyspark.operators.match_stats import ARENA_ROLLUPS
from tallyspark.operators.periodic import period_input_dates
from tallyspark.operators.retention import cohort_dates
from tallyspark.plans.schemas import column_names
from tallyspark.rundates import RunDates
from tallyspark.sources.inputs import Inputs

# The reference's command names, in its declared order (a
# valid dependency order), and the output tables each one writes.
COMMANDS: dict[str, tuple[str, ...]] = {
    "AccountDaily": ("account_daily",),
    "PaidAccountDaily": ("paid_account_daily",),
    "ShopProductDaily": ("shop_product_daily",),
    "ShopProductDaily_Country": ("shop_product_daily_country",),
    "RevenueDaily": ("revenue_daily",),
    "Dau": ("dau",),
    "BasicDaily": ("basic_daily",),
    "BasicDaily_Country": ("basic_daily_country",),
    "BasicWeekly": ("basic_weekly",),
    "BasicMonthly": ("basic_monthly",),
    "BasicWeekly_Country": ("basic_weekly_country",),
    "BasicMonthly_Country": ("basic_monthly_country",),
    "Retention": ("retention",),
    "Retention_NU": ("retention_nu",),
    "Retention_NU_P": ("retention_nu_p",),
    "Retention_Country": ("retention_country",),
    "Retention_Country_P": ("retention_country_p",),
    "MatchEloStatsDaily": ("match_elo_stats_daily",),
    "MonsterStatsDaily": ("monster_stats_daily",),
    "PlayTurnStatsDaily": ("playturn_stats_daily",),
    "CubeMakeStatsDaily": ("cube_make_stats_daily",),
    "JewelStatsDaily": ("jewel_stats_daily",),
    "CardWeightStatsDaily": ("cardweight_winningrate_daily", "cardweight_distribution_daily",
                             "cardweight_stats_daily"),
    "HardMatchStatsDaily": ("hardmatch_stats_daily",),
    "MatchEloBandStatsDaily": ("match_eloband_stats_daily",),
}

# Output -> stored tables it reads (besides the raw inputs).
DEPENDS_ON: dict[str, tuple[str, ...]] = {
    "revenue_daily": ("paid_account_daily",),
    "dau": ("account_daily",),
    "basic_daily": ("dau", "revenue_daily"),
    "basic_daily_country": ("account_daily", "revenue_daily"),
    "basic_weekly": ("basic_daily", "account_daily", "revenue_daily"),
    "basic_monthly": ("basic_daily", "account_daily", "revenue_daily"),
    "basic_weekly_country": ("basic_daily_country", "account_daily", "revenue_daily"),
    "basic_monthly_country": ("basic_daily_country", "account_daily", "revenue_daily"),
    **{t: ("account_daily",) for t in ("retention", "retention_nu", "retention_nu_p",
                                         "retention_country", "retention_country_p")},
}

# Retention variants: table -> (cohort, extra key)
RETENTION_VARIANTS = {
    "retention": ("all", "arenalevel"),
    "retention_nu": ("new", None),
    "retention_nu_p": ("new_paying", None),
    "retention_country": ("new", "country"),
    "retention_country_p": ("new_paying", "country"),
}

LOG_ROLLUPS = {
    "shop_product_daily": ops.shop_product_daily,
    "match_elo_stats_daily": ops.match_elo_stats_daily,
    "monster_stats_daily": ops.monster_stats_daily,
    "playturn_stats_daily": ops.playturn_stats_daily,
    "cube_make_stats_daily": ops.cube_make_stats_daily,
    "jewel_stats_daily": ops.jewel_stats_daily,
    "cardweight_winningrate_daily": ops.cardweight_winningrate_daily,
    "cardweight_distribution_daily": ops.cardweight_distribution_daily,
    "cardweight_stats_daily": ops.cardweight_stats_daily,
    "hardmatch_stats_daily": ops.hardmatch_stats_daily,
    "match_eloband_stats_daily": ops.match_eloband_stats_daily,
}


def resolve_commands(commands: Iterable[str] | None = None) -> list[str]:
    """Named commands in the given order, or all in declared order."""
    if not commands:
        return list(COMMANDS)
    unknown = [c for c in commands if c not in COMMANDS]
    if unknown:
        raise ValueError(f"unknown commands: {unknown}")
    return list(commands)


def output_tables(commands: Iterable[str] | None = None) -> list[str]:
    return [t for c in resolve_commands(commands) for t in COMMANDS[c]]


class DailyJob:
    """Lazily built outputs of one daily run over ``dates``."""

    def __init__(self, inputs: Inputs, dates: RunDates,
                 upstream: Callable[[str], DataFrame] | None = None, persist_shared: bool = False,
                 bits: Callable[[RunDates], DataFrame] | None = None):
        self.inputs = inputs
        self.dates = dates
        self.upstream = upstream
        self.persist_shared = persist_shared
        self.bits = bits
        self._memo: dict[tuple[str, tuple], DataFrame] = {}
        self._shared: dict[str, DataFrame] = {}

    # -- daily tables, for any set of days ---------------------------------
    def _daily(self, name: str, days: RunDates, build: Callable[[], DataFrame]) -> DataFrame:
        if self.upstream is not None:
            # Read at use: the stored table may have been rewritten since.
            return self.upstream(name).where(days.date_filter("date"))
        key = (name, days.values)
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def account_daily(self, days: RunDates) -> DataFrame:
        i = self.inputs
        return self._daily("account_daily", days,
                           lambda: ops.account_daily(i.gamelogs, i.footprint, i.staticaccount, days))

    def paid_account_daily(self, days: RunDates) -> DataFrame:
        return self._daily("paid_account_daily", days, lambda: ops.paid_account_daily(self.inputs.gamelogs, days))

    def revenue_daily(self, days: RunDates) -> DataFrame:
        return self._daily("revenue_daily", days, lambda: ops.revenue_daily(
            self.paid_account_daily(days), self.inputs.staticaccount, days))

    def dau(self, days: RunDates) -> DataFrame:
        return self._daily("dau", days, lambda: ops.dau(self.account_daily(days), days))

    def ccu(self) -> DataFrame:
        """The per-minute CCU table; without one, ``mcu`` is NULL."""
        if self.inputs.ccu is not None:
            return self.inputs.ccu
        return self.inputs.footprint.sparkSession.createDataFrame([], "time timestamp, ccu int")

    def basic_daily(self, days: RunDates) -> DataFrame:
        # From the log, the DAU table's per-level counts summed per day are
        # just the account-daily rows of the day: count those directly.
        i = self.inputs
        return self._daily("basic_daily", days, lambda: ops.basic_daily(
            i.footprint, self.account_daily(days).select("date", "arenalevel", F.lit(1).alias("dau")),
            self.revenue_daily(days), self.ccu(), days))

    def new_accounts_daily(self, days: RunDates) -> DataFrame:
        """(date, nru) of the basic-daily table. From the log it is one
        count per creation day over the footprint (the half-open day slice
        of basic-daily's nru), without the rest of basic-daily."""
        if self.upstream is not None:
            return self.upstream("basic_daily").where(days.date_filter("date")).select("date", "nru")
        return ops.new_accounts_per_day(self.inputs.footprint, days)

    def basic_daily_country(self, days: RunDates) -> DataFrame:
        i = self.inputs
        return self._daily("basic_daily_country", days, lambda: ops.basic_daily_country(
            self.account_daily(days), i.footprint, i.staticaccount, self.revenue_daily(days), days))

    def account_bits(self, days: RunDates) -> DataFrame | None:
        """The days' bit sets of accounts, where a store keeps them (``bits``:
        brings them up to date for the days and reads them)."""
        return self.bits(days).where(days.date_filter("date")) if self.bits else None

    def arena_matches(self) -> DataFrame:
        """Typed ArenaEnd rows of the run dates, parsed once for the six
        roll-ups that read them; kept in memory/disk while a scheduled run
        writes those tables (``persist_shared``)."""
        if "arena" not in self._shared:
            df = ops.arena_matches(self.inputs.gamelogs, self.dates)
            if self.persist_shared:
                df = df.persist(StorageLevel.MEMORY_AND_DISK)
            self._shared["arena"] = df
        return self._shared["arena"]

    def release(self) -> None:
        """Drop persisted shared intermediates."""
        for df in self._shared.values():
            if self.persist_shared:
                df.unpersist()
        self._shared.clear()

    # -- outputs -------------------------------------------------------------
    def output(self, table: str) -> DataFrame:
        d, i = self.dates, self.inputs
        through = self.upstream is None
        if table in ("account_daily", "paid_account_daily", "revenue_daily", "dau",
                     "basic_daily", "basic_daily_country"):
            df = getattr(self, table)(d)
            if self.upstream is not None:  # table mode: this run computes it now
                df = self._compute_now(table)
        elif table == "shop_product_daily_country":
            df = ops.shop_product_daily_country(i.gamelogs, i.staticaccount, d)
        elif table in ARENA_ROLLUPS:
            df = LOG_ROLLUPS[table](i.gamelogs, d, self.arena_matches())
        elif table in LOG_ROLLUPS:
            df = LOG_ROLLUPS[table](i.gamelogs, d)
        elif table in ("basic_weekly", "basic_monthly", "basic_weekly_country", "basic_monthly_country"):
            period = "week" if "weekly" in table else "month"
            days = period_input_dates(d, period, through)
            if table.endswith("_country"):
                df = ops.basic_period_country(self.basic_daily_country(days), self.account_daily(days),
                                              self.revenue_daily(days), d, period, through, self.account_bits(days))
            else:
                df = ops.basic_period(self.new_accounts_daily(days), self.account_daily(days),
                                      self.revenue_daily(days), d, period, through, self.account_bits(days))
        elif table in RETENTION_VARIANTS:
            cohort, by = RETENTION_VARIANTS[table]
            df = ops.retention(self.account_daily(cohort_dates(d)), d, cohort, by)
        else:
            raise KeyError(table)
        return df.select(*column_names(table))

    def _compute_now(self, table: str) -> DataFrame:
        """In table mode, the table itself is computed from its inputs for the
        run dates, while what it reads comes from the store."""
        d, i = self.dates, self.inputs
        if table == "account_daily":
            return ops.account_daily(i.gamelogs, i.footprint, i.staticaccount, d)
        if table == "paid_account_daily":
            return ops.paid_account_daily(i.gamelogs, d)
        if table == "revenue_daily":
            return ops.revenue_daily(self.paid_account_daily(d), i.staticaccount, d)
        if table == "dau":
            return ops.dau(self.account_daily(d), d)
        if table == "basic_daily":
            return ops.basic_daily(i.footprint, self.dau(d), self.revenue_daily(d), self.ccu(), d)
        if table == "basic_daily_country":
            return ops.basic_daily_country(self.account_daily(d), i.footprint, i.staticaccount,
                                           self.revenue_daily(d), d)
        raise KeyError(table)

