"""Run dates: the set of report dates one job computes.

The reference runs one date at a time. Here a job receives every date at once
and adds ``date`` to each grouping key, so a 30-day backfill is one plan, not
30. The dates live on the driver as a short sorted tuple (one entry per day,
bounded by the calendar, not by the data); that lets each roll-up turn them
into literal range predicates the Parquet scan can prune on.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ONE_DAY = dt.timedelta(days=1)


def _as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def date_series(start, end) -> list[dt.date]:
    """Day series from ``start`` to ``end``; always holds ``start``, even when
    ``end`` is before it (the backfill launcher's do-while)."""
    start, end = _as_date(start), _as_date(end)
    out = [start]
    cur = start + ONE_DAY
    while cur <= end:
        out.append(cur)
        cur += ONE_DAY
    return out


class RunDates:
    """Sorted, distinct report dates."""

    def __init__(self, dates: Iterable):
        values = tuple(sorted({_as_date(d) for d in dates}))
        if not values:
            raise ValueError("at least one run date is required")
        self.values = values
        self._preds: dict[tuple[str, str], Column] = {}

    # -- construction -----------------------------------------------------
    @classmethod
    def between(cls, start, end) -> "RunDates":
        return cls(date_series(start, end))

    @classmethod
    def yesterday(cls, now: dt.datetime | None = None) -> "RunDates":
        now = now or dt.datetime.now(dt.timezone.utc)
        return cls([now.date() - ONE_DAY])

    @classmethod
    def spanning(cls, df: DataFrame, ts_col: str = "time", partition_col: str = "event_date") -> "RunDates":
        """Every calendar day from the first to the last timestamp of ``df``.

        Runs one global min/max aggregate (two scalars reach the driver). On a
        log partitioned by ``event_date`` (the day of ``time``) it reads only
        the partition column: partition values and file footers, no column
        data."""
        day = F.col(partition_col) if partition_col in df.columns else F.to_date(ts_col)
        row = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()
        if row is None or row["lo"] is None:
            raise ValueError("cannot derive run dates from an empty table")
        return cls.between(row["lo"], row["hi"])

    # -- derived sets -----------------------------------------------------
    def shifted(self, offsets: Iterable[int]) -> "RunDates":
        """Dates ``d + k`` for every run date ``d`` and offset ``k``."""
        return _interned(RunDates(d + dt.timedelta(days=k) for d in self.values for k in offsets))

    def union(self, other: "RunDates") -> "RunDates":
        return _interned(RunDates(self.values + other.values))

    @property
    def first(self) -> dt.date:
        return self.values[0]

    @property
    def last(self) -> dt.date:
        return self.values[-1]

    def ranges(self) -> list[tuple[dt.date, dt.date]]:
        """Maximal runs of consecutive days, as closed ``(first, last)`` pairs."""
        out: list[tuple[dt.date, dt.date]] = []
        lo = hi = self.values[0]
        for d in self.values[1:]:
            if d == hi + ONE_DAY:
                hi = d
            else:
                out.append((lo, hi))
                lo = hi = d
        out.append((lo, hi))
        return out

    # -- Spark side -------------------------------------------------------
    def array(self) -> Column:
        """The dates as one array literal, built from day sequences."""
        seqs = [F.sequence(F.lit(lo), F.lit(hi)) for lo, hi in self.ranges()]
        return seqs[0] if len(seqs) == 1 else F.flatten(F.array(*seqs))

    def frame(self, spark: SparkSession, name: str = "date") -> DataFrame:
        """One-column DataFrame of the dates, generated inside the JVM."""
        return spark.range(1).select(F.explode(self.array()).alias(name))

    def date_filter(self, col: Column | str) -> Column:
        """Predicate ``col`` is one of the run dates."""
        if isinstance(col, str):  # built once per column name (plans reuse them a lot)
            key = ("date", col)
            if key not in self._preds:
                self._preds[key] = self.date_filter(F.col(col))
            return self._preds[key]
        span = col.between(F.lit(self.first), F.lit(self.last))
        return span if len(self.ranges()) == 1 else span & self._member(col)

    def _member(self, day: Column) -> Column:
        """``day`` is one of the dates: one flat hash-set test, however many
        dates there are."""
        return day.isin(*map(F.lit, self.values))

    def time_filter(self, col: Column | str) -> Column:
        """Closed ``time between d and d+1`` for every run date. The range from
        the first to the last is pushed to the Parquet scan; dates with gaps add
        a set test of the day (at exactly midnight also of the day before)."""
        if isinstance(col, str):
            key = ("time", col)
            if key not in self._preds:
                self._preds[key] = self.time_filter(F.col(col))
            return self._preds[key]
        span = col.between(ts_lit(self.first), ts_lit(self.last + ONE_DAY))
        if len(self.ranges()) == 1:
            return span
        day = F.to_date(col)
        at_midnight = col == day.cast("timestamp")
        return span & (self._member(day) | (at_midnight & self._member(F.date_sub(day, 1))))

    def partition_filter(self, col: Column | str) -> Column:
        """Predicate on an ``event_date`` partition column: the run dates and
        the following days (an event at exactly midnight of ``d+1`` also
        belongs to ``d``)."""
        return RunDates(self.values + self.shifted([1]).values).date_filter(col)

    def __len__(self) -> int:
        return len(self.values)

    def __iter__(self):
        return iter(self.values)

    def __repr__(self) -> str:
        if len(self.values) == 1:
            return f"RunDates({self.first})"
        return f"RunDates({self.first}..{self.last}, n={len(self.values)})"


_INTERNED: dict[tuple, "RunDates"] = {}


def _interned(rd: "RunDates") -> "RunDates":
    """Share one object (and its cached predicates) per distinct date set."""
    if len(_INTERNED) > 4096:
        _INTERNED.clear()
    return _INTERNED.setdefault(rd.values, rd)


def ts_lit(value) -> Column:
    """Timestamp literal read in the session time zone (UTC), never in the
    Python process's local zone."""
    if isinstance(value, dt.datetime):
        text = value.replace(tzinfo=None).isoformat(sep=" ")
    else:
        text = f"{_as_date(value).isoformat()} 00:00:00"
    return F.lit(text).cast("timestamp")
