"""Stored account numbers and bit sets, kept in step with ``account_daily``."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame

from tallyspark.operators.activity import day_bits, new_numbers
from tallyspark.rundates import RunDates
from tallyspark.sinks.store import TableStore

DAILY, NUMBERS, BITS = "account_daily", "account_numbers", "account_bits_daily"


class ActivityState:
    """Bit sets of the days asked for, from the store. A day's sets carry a
    note of the ``account_daily`` version they were made from: a day that was
    written again since (late rows, a repair, a roll-back) is made again, no
    other."""

    def __init__(self, store: TableStore):
        self.store = store
        self._one = threading.Lock()  # weekly and monthly tables may ask at the same time

    def stale(self, days: RunDates) -> list:
        source, made = self.store.manifest(DAILY)["parts"], self.store.manifest(BITS)["notes"]
        return [d for d in days if source.get(f"date={d}") != made.get(f"date={d}")]

    def bits(self, days: RunDates) -> DataFrame:
        with self._one:
            todo = self.stale(days)
            if todo:
                self._make(todo)
        return self.store.read(BITS, keys=[f"date={d}" for d in days])

    def _make(self, days: list) -> None:
        now = self.store.manifest(DAILY)
        rels = [f"date={d}" for d in days]
        daily = self.store.read(DAILY, now["version"] or None, rels)

        def number() -> None:
            known = self.store.manifest(NUMBERS)
            shards = self.store.read(NUMBERS, known["version"] or None)
            # Numbers follow from those already given: every partition must still be as it was read.
            self.store.append(NUMBERS, new_numbers(daily, shards), ["shard"], expect=_all(known))
        self.store.retried(number)
        sets = day_bits(daily, self.store.read(NUMBERS))
        self.store.replace(BITS, sets, ["date"], [(d,) for d in days], notes={r: now["parts"].get(r) for r in rels})


def _all(manifest: dict) -> dict:
    from tallyspark.operators.activity import SHARDS
    return {f"shard={s}": manifest["parts"].get(f"shard={s}") for s in range(SHARDS)}
