"""Counts of payload values the roll-ups could not cast.

The roll-ups read numbers with ``try_cast``: a value that is present but not
a number becomes NULL instead of failing the job. This report shows how
many such values each (date, command, key) had, in one pass with partial
aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.payload import json_fields, nested_fields
from tallyspark.rundates import RunDates
from tallyspark.sources.gamelogs import slice_log

# Payload keys each command is read for, with the type the
# roll-ups cast them to ("a.b" is key b of the nested object a).
TYPED_KEYS: dict[str, dict[str, str]] = {
    "Login": {"mysticorblevel": "smallint"},
    "Shop:Buy": {"productid": "int", "price": "int"},
    "ArenaEnd": {"matchedtier": "smallint", "turncount": "smallint", "totalplaytime": "int",
                 "myinfo.arenalevel": "smallint", "myinfo.cardweight": "smallint", "myinfo.arenapoint": "smallint",
                 "opinfo.cardweight": "smallint", "opinfo.arenapoint": "smallint"},
    "MonsterRating": {"monsterid": "int", "arenalevel": "smallint"},
    "SkillRating": {"skillid": "int", "arenalevel": "smallint"},
    "Jewel:Gain": {"delta": "int"},
    "Jewel:Spend": {"delta": "int"},
    "Arena:HardMatch": {"arenalevel": "smallint", "hitbonuscount": "smallint"},
}


def rejected_values(log: DataFrame, dates: RunDates) -> DataFrame:
    """(date, command, key, present, rejected): values present in the
    payload, and those among them that are not a valid number of the type
    the roll-ups cast them to."""
    top = sorted({k.split(".")[0] for keys in TYPED_KEYS.values() for k in keys})
    ev = slice_log(log, dates, list(TYPED_KEYS)).select("date", "command", json_fields("payload", *top).alias("p"))
    nested = {"myinfo": ["arenalevel", "cardweight", "arenapoint"], "opinfo": ["cardweight", "arenapoint"]}
    ev = ev.select("date", "command", "p",
                   *[nested_fields(F.col(f"p.{o}"), *ks).alias(o) for o, ks in nested.items()])

    def entries(command: str):
        out = []
        for key, typ in TYPED_KEYS[command].items():
            text = F.col(key) if "." in key else F.col(f"p.{key}")
            out.append(F.struct(F.lit(key).alias("key"), text.isNotNull().alias("present"),
                                (text.isNotNull() & text.try_cast(typ).isNull()).alias("rejected")))
        return F.array(*out)

    per_command = None
    for command in TYPED_KEYS:
        branch = F.when(F.col("command") == command, entries(command))
        per_command = branch if per_command is None else per_command.when(F.col("command") == command,
                                                                           entries(command))
    return (ev.select("date", "command", F.explode(per_command).alias("e"))
            .groupBy("date", "command", F.col("e.key").alias("key"))
            .agg(F.count_if(F.col("e.present")).alias("present"), F.count_if(F.col("e.rejected")).alias("rejected")))
