"""Game-play statistics over single event types.

Each function slices the log for its command(s), parses the payload once into
the keys it needs and runs one grouped aggregate with ``date`` as extra key
(partial aggregation happens before the shuffle, so a dominant command,
level or account costs no more than any other).

Three readings of a missing ``isaiarena`` are kept apart on purpose:
``= 'true'`` (missing -> NULL), ``case ... when 'false' then false else
true`` (missing -> true), and the filter ``= 'false'`` (missing -> dropped).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.numeric import elo_band
from tallyspark.functions.payload import int2, int4, json_fields, nested_fields
from tallyspark.rundates import RunDates
from tallyspark.sources.gamelogs import slice_log


def _events(log: DataFrame, dates: RunDates, commands, keys, oid_positive: bool) -> DataFrame:
    return (slice_log(log, dates, commands, oid_positive=oid_positive)
            .select("date", "command", json_fields("payload", *keys).alias("p")))


def _is_true(c: Column) -> Column:
    return c == F.lit("true")


def _wins(p: Column) -> Column:
    return F.count(F.when(_is_true(p["iswin"]), F.lit(1))).alias("cnt_win")


def _cnt() -> Column:
    return F.count(F.lit(1)).alias("cnt")


def arena_matches(log: DataFrame, dates: RunDates) -> DataFrame:
    """Typed ``ArenaEnd`` rows, parsed once: the shared input of six
    roll-ups (R19, R21, R24-R26, R28). Flags stay as text (their three
    readings differ per roll-up); numbers are cast, bad values NULL."""
    keys = ["isaiarena", "iswin", "matchtype", "matchedtier", "turncount", "totalplaytime", "myinfo", "opinfo"]
    ev = slice_log(log, dates, "ArenaEnd").select("date", "oidaccount", json_fields("payload", *keys).alias("p"))
    my = nested_fields(F.col("p.myinfo"), "arenalevel", "cardweight", "arenapoint")
    op = nested_fields(F.col("p.opinfo"), "cardweight", "arenapoint")
    return (ev.select("date", "oidaccount", "p", my.alias("my"), op.alias("op"))
            .select("date", "oidaccount",
                    F.col("p.isaiarena").alias("isaiarena"), F.col("p.iswin").alias("iswin"),
                    F.col("p.matchtype").alias("matchtype"),
                    int2(F.col("p.matchedtier")).alias("matchedtier"),
                    int2(F.col("p.turncount")).alias("turncount"),
                    int4(F.col("p.totalplaytime")).alias("totalplaytime"),
                    int2(F.col("my.arenalevel")).alias("my_arenalevel"),
                    int2(F.col("my.cardweight")).alias("my_cardweight"),
                    int2(F.col("my.arenapoint")).alias("my_arenapoint"),
                    int2(F.col("op.cardweight")).alias("op_cardweight"),
                    int2(F.col("op.arenapoint")).alias("op_arenapoint")))


def _arena(log: DataFrame, dates: RunDates, matches: DataFrame | None) -> DataFrame:
    return matches if matches is not None else arena_matches(log, dates)


def match_elo_stats_daily(log: DataFrame, dates: RunDates, matches: DataFrame | None = None) -> DataFrame:
    """Ranked (ELO) match results by (AI arena, my arena level)."""
    m = _arena(log, dates, matches).where((F.col("oidaccount") > 0) & (F.col("matchtype") == "ELO"))
    return (m.groupBy("date", _is_true(F.col("isaiarena")).alias("isai"),
                      F.col("my_arenalevel").alias("arenalevel"))
            .agg(_cnt(), F.count(F.when(_is_true(F.col("iswin")), F.lit(1))).alias("cnt_win")))


def monster_stats_daily(log: DataFrame, dates: RunDates) -> DataFrame:
    """Monster and skill ratings in one scan; the two kinds are told apart
    by ``type``, so the reference's UNION equals a plain union."""
    ev = _events(log, dates, ["MonsterRating", "SkillRating"],
                 ["monsterid", "skillid", "arenalevel", "isaiarena", "iswin"], True)
    is_monster = F.col("command") == "MonsterRating"
    return (ev.groupBy(
                "date",
                int4(F.when(is_monster, F.col("p.monsterid")).otherwise(F.col("p.skillid"))).alias("monsterid"),
                int2(F.col("p.arenalevel")).alias("arenalevel"),
                F.when(F.col("p.isaiarena") == "false", F.lit(False)).otherwise(F.lit(True)).alias("isai"),
                F.when(is_monster, F.lit("monster")).otherwise(F.lit("skill")).alias("type"))
            .agg(_cnt(), _wins(F.col("p"))))


def playturn_stats_daily(log: DataFrame, dates: RunDates, matches: DataFrame | None = None) -> DataFrame:
    """Turn count and play time of matches longer than 60 s."""
    m = _arena(log, dates, matches).where((F.col("oidaccount") > 0) & (F.col("totalplaytime") > 60))
    return (m.groupBy("date", F.col("my_arenalevel").alias("arenalevel"),
                      _is_true(F.col("isaiarena")).alias("isai"), "matchtype")
            .agg(_cnt(),
                 F.sum("turncount").alias("sum_turn"), F.sum("totalplaytime").alias("sum_playtime"),
                 F.max("turncount").alias("max_turn"), F.max("totalplaytime").alias("max_playtime"),
                 F.min("turncount").alias("min_turn"), F.min("totalplaytime").alias("min_playtime")))


def cube_make_stats_daily(log: DataFrame, dates: RunDates) -> DataFrame:
    """Cube crafting by grade; how many used jewels."""
    ev = _events(log, dates, "Cube:Make", ["cubegrade", "useJewel"], False)
    return (ev.groupBy("date", F.col("p.cubegrade").alias("grade"))
            .agg(_cnt(), F.count(F.when(_is_true(F.col("p.useJewel")), F.lit(1))).alias("cnt_jewel")))


def jewel_stats_daily(log: DataFrame, dates: RunDates) -> DataFrame:
    """Jewel gains and spends by reason."""
    ev = _events(log, dates, ["Jewel:Gain", "Jewel:Spend"], ["reason", "delta"], False)
    return (ev.groupBy("date", "command", F.col("p.reason").alias("reason"))
            .agg(_cnt(), F.sum(int4(F.col("p.delta"))).alias("amount")))


def _cardweight_matches(log: DataFrame, dates: RunDates, matches: DataFrame | None) -> DataFrame:
    """Ranked matches against people (``isaiarena`` exactly 'false'), all
    accounts including id 0."""
    return _arena(log, dates, matches).where((F.col("matchtype") == "ELO") & (F.col("isaiarena") == "false"))


def cardweight_winningrate_daily(log: DataFrame, dates: RunDates, matches: DataFrame | None = None) -> DataFrame:
    """Wins by card-weight difference (mine minus opponent's)."""
    m = _cardweight_matches(log, dates, matches)
    return (m.groupBy("date", (F.col("my_cardweight").cast("int") - F.col("op_cardweight").cast("int")).alias("diff"))
            .agg(_cnt(), F.count(F.when(_is_true(F.col("iswin")), F.lit(1))).alias("cnt_win")))


def cardweight_distribution_daily(log: DataFrame, dates: RunDates, matches: DataFrame | None = None) -> DataFrame:
    """Matches per (matched tier, my card weight)."""
    m = _cardweight_matches(log, dates, matches)
    return (m.groupBy("date", F.col("matchedtier").alias("arenalevel"), F.col("my_cardweight").alias("cardweight"))
            .agg(_cnt()))


def cardweight_stats_daily(log: DataFrame, dates: RunDates, matches: DataFrame | None = None) -> DataFrame:
    """Card-weight moments per matched tier. The median is exact and
    interpolating; its buffer holds one counter per distinct weight (a
    smallint), so a huge tier does not grow it."""
    m = _cardweight_matches(log, dates, matches)
    w = F.col("my_cardweight").cast("double")
    return (m.groupBy("date", F.col("matchedtier").alias("arenalevel"))
            .agg(_cnt(), F.avg(w).alias("avg"), F.median(w).alias("median"), F.stddev_pop(w).alias("stddev"),
                 F.min("my_cardweight").alias("min"), F.max("my_cardweight").alias("max")))


def hardmatch_stats_daily(log: DataFrame, dates: RunDates) -> DataFrame:
    """Hard matches by (arena level, difficulty): count and bonus hits."""
    ev = _events(log, dates, "Arena:HardMatch", ["arenalevel", "difficulttype", "hitbonuscount"], True)
    return (ev.groupBy("date", int2(F.col("p.arenalevel")).alias("arenalevel"),
                       F.col("p.difficulttype").alias("difficulttype"))
            .agg(F.count(F.lit(1)).alias("cnt_match"),
                 F.sum(int2(F.col("p.hitbonuscount"))).alias("total_bonus")))


def match_eloband_stats_daily(log: DataFrame, dates: RunDates, matches: DataFrame | None = None) -> DataFrame:
    """Matches (any type) by rating band of both sides."""
    m = _arena(log, dates, matches).where(F.col("oidaccount") > 0)
    return (m.groupBy("date", _is_true(F.col("isaiarena")).alias("isai"),
                      elo_band(F.col("my_arenapoint")).alias("eloband_my"),
                      elo_band(F.col("op_arenapoint")).alias("eloband_op"))
            .agg(_cnt()))


# Roll-ups that read the shared ArenaEnd intermediate.
ARENA_ROLLUPS = ("match_elo_stats_daily", "playturn_stats_daily", "cardweight_winningrate_daily",
                 "cardweight_distribution_daily", "cardweight_stats_daily", "match_eloband_stats_daily")
