"""Typed binding of server status hashes (field -> text maps) to columns.

The status store keeps one hash per game server. Read as a long table
``(hashkey, field, value)``, the hashes become one typed row per server in a
single grouped pass. Unknown fields are ignored. A missing field gives NULL; a
value that is present but does not parse gives NULL and counts in the column
``bad_fields``, so callers can tell the two apart (and drop such a row).

Stamps are read as ISO text or in the form ``1/16/2024 11:59:58 AM``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields of a game-server status hash and their Spark types.
# They must equal the status model's property names.
GAME_SERVER_FIELDS = {
    "UUID": "string", "HostName": "string", "IP": "string",
    "dtmStarted": "timestamp", "dtmUpdated": "timestamp",
    "Version": "string", "Revision": "string", "ResourceRev": "string",
    "MatchmakerVersion": "string", "MatchmakerRevision": "string",
    "MatchmakerResourceRevision": "string", "MatchmakerIP": "string", "MatchmakerPort": "int",
    "PublicIP": "string", "numPort": "int", "PublicUrl": "string",
    "numMaxUser": "int", "numCCU": "int", "IsActive": "boolean",
}


def _typed(value: Column, spark_type: str) -> Column:
    if spark_type == "boolean":
        v = F.lower(F.trim(value))
        return F.when(v == "true", F.lit(True)).when(v == "false", F.lit(False))
    if spark_type == "timestamp":
        return F.coalesce(F.try_to_timestamp(value), F.try_to_timestamp(value, F.lit("M/d/yyyy h:mm:ss a")))
    return value.try_cast(spark_type)


def bind_hashes(entries: DataFrame, fields: dict[str, str] | None = None) -> DataFrame:
    """``entries(hashkey, field, value)`` -> one row per hashkey with a
    typed column per known field. Partial aggregation keeps one value per
    (hashkey, field) per task, so the grouped shuffle is as small as the
    servers times fields."""
    fields = fields or GAME_SERVER_FIELDS
    known = entries.where(F.col("field").isin(list(fields)))
    raw = known.groupBy("hashkey").agg(
        *[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields])
    typed = {f: _typed(F.col(f), t) for f, t in fields.items()}
    bad = [(F.col(f).isNotNull() & c.isNull()).cast("int") for f, c in typed.items()]
    return raw.select("hashkey", *[c.alias(f) for f, c in typed.items()], sum(bad[1:], bad[0]).alias("bad_fields"))


def rejected_entries(entries: DataFrame, fields: dict[str, str] | None = None) -> DataFrame:
    """(hashkey, field, value, wanted): the entries of known fields whose text
    does not read as the field's type, as they were, in one pass without a
    shuffle; what ``bind_hashes`` counts in ``bad_fields``."""
    fields = fields or GAME_SERVER_FIELDS
    kinds = sorted({t for t in fields.values() if t != "string"})
    of_kind = {t: [f for f, kind in fields.items() if kind == t] for t in kinds}
    wanted, fails = F.lit(None).cast("string"), F.lit(False)
    for t in kinds:
        here = F.col("field").isin(of_kind[t])
        wanted = F.when(here, t).otherwise(wanted)
        fails = F.when(here, _typed(F.col("value"), t).isNull()).otherwise(fails)
    return entries.where(F.col("value").isNotNull() & fails).select("hashkey", "field", "value", wanted.alias("wanted"))


def hash_entries(status: DataFrame) -> DataFrame:
    """Inverse view: a typed status table as ``(hashkey, field, value)``
    text entries, the layout of the status store."""
    cols = [c for c in status.columns if c != "hashkey"]
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), _as_text(F.col(c)).alias("value")) for c in cols]))
    return status.select("hashkey", stacked.alias("e")).select("hashkey", "e.field", "e.value")


def _as_text(c: Column) -> Column:
    return c.cast("string")
