"""Literal-row tests of the reference's semantics that are easy to 'fix' by
accident (SURVEY §2.7, T1-T17)."""

import datetime as dt

from helpers import make_inputs, rows, ts

from tallyspark import operators as ops
from tallyspark.plans.daily import DailyJob
from tallyspark.rundates import RunDates

D = dt.date(2024, 1, 16)
ONE = RunDates([D])


def login(oid, t, lvl):
    return (oid, t, "Login", {"mysticorblevel": lvl})


def test_t1_midnight_event_counts_on_two_days(spark):
    inp = make_inputs(spark, logs=[login(1, "2024-01-17 00:00:00", 3)],
                      footprint=[(1, "2024-01-01 05:00:00")], static=[(1, "KR")])
    out = ops.account_daily(inp.gamelogs, inp.footprint, inp.staticaccount, RunDates.between(D, D + dt.timedelta(1)))
    assert rows(out, "date", "oidaccount") == [(D, 1), (D + dt.timedelta(1), 1)]


def test_t1_basic_daily_nru_half_open_but_country_nru_closed(spark):
    # created exactly at the next midnight: R8 nru excludes it, R9 nru includes it.
    inp = make_inputs(spark, logs=[login(1, "2024-01-16 10:00:00", 1)],
                      footprint=[(1, "2024-01-16 10:00:00"), (2, "2024-01-17 00:00:00")],
                      static=[(1, "KR"), (2, "KR")], ccu=[("2024-01-17 00:00:00", 7)])
    job = DailyJob(inp, ONE)
    bd = job.output("basic_daily").collect()[0]
    assert (bd["ru"], bd["nru"], bd["mcu"]) == (1, 1, 7)
    bdc = rows(job.output("basic_daily_country"), "country", "nru", "dau")
    assert bdc == [("KR", 2, 1)]


def test_t2_isaiarena_three_defaults(spark):
    base = dict(iswin=True, matchtype="ELO", matchedtier=1, myinfo={"arenalevel": 2, "cardweight": 70,
                                                                     "arenapoint": 1900},
                opinfo={"cardweight": 60, "arenapoint": 2100})
    missing = dict(base)  # no isaiarena
    inp = make_inputs(spark, logs=[
        (1, "2024-01-16 10:00:00", "ArenaEnd", missing),
        (1, "2024-01-16 10:00:00", "MonsterRating", {"monsterid": 4, "arenalevel": 1, "iswin": False}),
        (1, "2024-01-16 11:00:00", "ArenaEnd", dict(base, isaiarena=False)),
    ])
    elo = rows(ops.match_elo_stats_daily(inp.gamelogs, ONE), "isai", "cnt")
    assert elo == [(False, 1), (None, 1)]                   # = 'true': missing -> NULL
    mon = rows(ops.monster_stats_daily(inp.gamelogs, ONE), "isai", "type")
    assert mon == [(True, "monster")]                       # case ... else true
    cw = ops.cardweight_winningrate_daily(inp.gamelogs, ONE).collect()
    assert [(r["diff"], r["cnt"]) for r in cw] == [(10, 1)]  # = 'false' filter drops missing


def test_t2_bad_number_becomes_null_not_error(spark):
    inp = make_inputs(spark, logs=[(1, "2024-01-16 10:00:00", "Shop:Buy",
                                    {"paytype": "Cash", "productid": "x1", "price": "abc"})])
    out = ops.shop_product_daily(inp.gamelogs, ONE).collect()[0]
    assert (out["productid"], out["cnt"], out["amount"]) == (None, 1, None)


def test_t3_nested_object_or_encoded_string(spark):
    enc = '{"matchtype":"ELO","isaiarena":true,"iswin":true,"myinfo":"{\\"arenalevel\\":5}"}'
    obj = {"matchtype": "ELO", "isaiarena": True, "iswin": True, "myinfo": {"arenalevel": 5}}
    inp = make_inputs(spark, logs=[(1, "2024-01-16 10:00:00", "ArenaEnd", enc),
                                   (2, "2024-01-16 10:00:00", "ArenaEnd", obj)])
    out = rows(ops.match_elo_stats_daily(inp.gamelogs, ONE), "arenalevel", "cnt", "cnt_win")
    assert out == [(5, 2, 2)]


def test_t4_null_country_rows_do_not_join(spark):
    # account 1 active with NULL country; account 2 new with NULL country, no login.
    inp = make_inputs(spark, logs=[login(1, "2024-01-16 10:00:00", 1),
                                   (1, "2024-01-16 11:00:00", "Shop:Buy", {"paytype": "Cash", "price": 5})],
                      footprint=[(1, "2024-01-02 00:00:01"), (2, "2024-01-16 03:00:00")],
                      static=[(1, None), (2, None)])
    job = DailyJob(inp, ONE)
    bdc = rows(job.output("basic_daily_country"), "country", "nru", "dau", "dpu", "revenue")
    assert bdc == [(None, 0, 1, 0, 0), (None, 1, 0, 0, 0)]   # two NULL rows, revenue never attaches
    wk = rows(job.output("basic_weekly_country"), "country", "nru", "au", "pu", "revenue")
    assert wk == [(None, 1, 0, 0, 0)]


def test_t5_empty_day_one_row_for_basic_zero_rows_for_grouped(spark):
    inp = make_inputs(spark, footprint=[(1, "2024-01-01 00:00:00")], static=[(1, "KR")])
    job = DailyJob(inp, ONE)
    bd = job.output("basic_daily").collect()
    assert [(r["ru"], r["nru"], r["dau"], r["dpu"], r["revenue"], r["mcu"]) for r in bd] == [(1, 0, 0, 0, 0, None)]
    assert job.output("dau").count() == 0 and job.output("revenue_daily").count() == 0
    assert rows(job.output("basic_weekly"), "date", "nru", "au") == [(dt.date(2024, 1, 14), 0, 0)]


def test_t6_weeks_start_on_sunday(spark):
    inp = make_inputs(spark, logs=[login(1, "2024-01-14 10:00:00", 1), login(1, "2024-01-20 10:00:00", 1),
                                   login(2, "2024-01-21 10:00:00", 1)],
                      footprint=[(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00")],
                      static=[(1, "KR"), (2, "KR")])
    job = DailyJob(inp, RunDates.between("2024-01-14", "2024-01-21"))
    assert rows(job.output("basic_weekly"), "date", "au") == [(dt.date(2024, 1, 14), 1), (dt.date(2024, 1, 21), 1)]


def test_t7_weekly_pu_is_sum_of_daily_payers(spark):
    buy = {"paytype": "Cash", "price": 10}
    inp = make_inputs(spark, logs=[(1, "2024-01-15 10:00:00", "Shop:Buy", buy),
                                   (1, "2024-01-16 10:00:00", "Shop:Buy", buy),
                                   login(1, "2024-01-15 10:00:00", 1), login(1, "2024-01-16 10:00:00", 1)],
                      footprint=[(1, "2024-01-01 00:00:00")], static=[(1, "KR")])
    job = DailyJob(inp, RunDates.between("2024-01-15", "2024-01-16"))
    assert rows(job.output("basic_weekly"), "au", "pu", "revenue") == [(1, 2, 20)]


def test_t8_smallint_arithmetic_widens(spark):
    p = {"matchtype": "ELO", "isaiarena": False, "iswin": True,
         "myinfo": {"cardweight": 32000, "arenapoint": 32700}, "opinfo": {"cardweight": -32000, "arenapoint": 1}}
    inp = make_inputs(spark, logs=[(1, "2024-01-16 10:00:00", "ArenaEnd", p)])
    assert ops.cardweight_winningrate_daily(inp.gamelogs, ONE).collect()[0]["diff"] == 64000
    band = ops.match_eloband_stats_daily(inp.gamelogs, ONE).collect()[0]
    assert (band["eloband_my"], band["eloband_op"]) == (32700, 2000)


def test_t9_rate_is_double_and_cnt_o_counts_after_join(spark):
    # account 1 has two dimension rows -> two account-daily rows on D (T15), so
    # its cohort row on D-1 counts twice in cnt_o.
    inp = make_inputs(spark, logs=[login(1, "2024-01-15 10:00:00", 1), login(1, "2024-01-16 10:00:00", 1),
                                   login(2, "2024-01-15 10:00:00", 1)],
                      footprint=[(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00")],
                      static=[(1, "KR"), (2, "KR")])
    job = DailyJob(inp, ONE)
    r = job.output("retention").collect()
    assert [(x["date"], x["day"], x["cnt_o"], x["cnt"], x["rate"]) for x in r] == [(dt.date(2024, 1, 15), 1, 2, 1, 0.5)]


def test_t10_ccu_liveness(spark):
    st = spark.createDataFrame([("ServerDesc:1", ts("2024-01-16 11:00:00"), 10),
                                ("ServerDesc:2", ts("2024-01-16 11:59:50"), 20),
                                ("ServerDesc:3", ts("2024-01-16 12:05:00"), 40),
                                ("Other:4", ts("2024-01-16 11:59:59"), 80),
                                ("ServerDesc:5", None, 160)],
                               "hashkey string, dtmUpdated timestamp, numCCU int")
    now = dt.datetime(2024, 1, 16, 12, 0, 42)
    as_ref = ops.ccu(st, now).collect()[0]
    assert (as_ref["time"], as_ref["ccu"]) == (dt.datetime(2024, 1, 16, 12, 0), 10 + 20 + 160)
    assert ops.ccu(st, now, "strict").collect()[0]["ccu"] == 20 + 40
    empty = st.where("false")
    assert ops.ccu(empty, now).collect()[0]["ccu"] == 0


def test_t11_monster_and_skill_same_ids_stay_apart(spark):
    inp = make_inputs(spark, logs=[(1, "2024-01-16 10:00:00", "MonsterRating", {"monsterid": 3, "arenalevel": 1}),
                                   (1, "2024-01-16 10:00:00", "SkillRating", {"skillid": 3, "arenalevel": 1}),
                                   (0, "2024-01-16 10:00:00", "SkillRating", {"skillid": 3, "arenalevel": 1})])
    out = rows(ops.monster_stats_daily(inp.gamelogs, ONE), "monsterid", "type", "cnt")
    assert out == [(3, "monster", 1), (3, "skill", 1)]       # account 0 dropped


def test_t13_replay_ties_and_threshold(spark):
    rp = spark.createDataFrame([("b", "202401161300", 2, 900), ("a", "202401161300", 2, 900),
                                ("c", "202401161300", 2, 800), ("d", "202401161300", 1, 999),
                                ("e", "202401161300", 3, None), ("f", "202401161400", 2, 10)],
                               "uniqueKey string, dateHour string, arena int, score int")
    got = rows(ops.pick_best(rp, ["202401161300"]), "uniqueKey")
    assert got == [("a",), ("e",)]


def test_t14_country_country_dimension_vs_stored(spark):
    # account-daily stored KR; the dimension now says JP -> R9 uses JP.
    inp = make_inputs(spark, logs=[login(1, "2024-01-16 10:00:00", 1)],
                      footprint=[(1, "2024-01-01 00:00:00")], static=[(1, "KR")])
    ad = ops.account_daily(inp.gamelogs, inp.footprint, inp.staticaccount, ONE)
    jp = spark.createDataFrame([(1, "JP")], "oidaccount bigint, country string")
    rev = spark.createDataFrame([], "date date, country string, pu bigint, revenue bigint")
    out = rows(ops.basic_daily_country(ad, inp.footprint, jp, rev, ONE), "country", "dau")
    assert out == [("JP", 1)]


def test_t15_duplicate_dimension_rows_are_not_deduplicated(spark):
    inp = make_inputs(spark, logs=[login(1, "2024-01-16 10:00:00", 1)],
                      footprint=[(1, "2024-01-01 00:00:00")], static=[(1, "KR"), (1, "US")])
    out = ops.account_daily(inp.gamelogs, inp.footprint, inp.staticaccount, ONE)
    assert rows(out, "country") == [("KR",), ("US",)]


def test_t2_r2_transfer_removes_only_new_accounts_t17_null_isnew_kept(spark):
    inp = make_inputs(spark, logs=[login(1, "2024-01-16 10:00:00", 1), login(2, "2024-01-16 10:00:00", 1),
                                   login(3, "2024-01-16 10:00:00", 1),
                                   (1, "2024-01-16 12:00:00", "Transfer", {}),
                                   (2, "2024-01-16 12:00:00", "Transfer", {}),
                                   (3, "2024-01-16 12:00:00", "Transfer", {})],
                      footprint=[(1, "2024-01-16 01:00:00"), (2, "2024-01-01 00:00:00"), (3, None)],
                      static=[(1, "KR"), (2, "KR"), (3, "KR")])
    out = rows(ops.account_daily(inp.gamelogs, inp.footprint, inp.staticaccount, ONE), "oidaccount", "isnew")
    assert out == [(2, False), (3, None)]


def test_t16_arenalevel_sources(spark):
    p = {"mysticorblevel": 1, "arenalevel": 2, "matchedtier": 3, "myinfo": {"arenalevel": 4, "cardweight": 50},
         "matchtype": "ELO", "isaiarena": False, "totalplaytime": 100, "turncount": 5, "difficulttype": "d",
         "hitbonuscount": 1}
    inp = make_inputs(spark, logs=[(1, "2024-01-16 10:00:00", c, p) for c in
                                   ("Login", "ArenaEnd", "Arena:HardMatch", "MonsterRating")],
                      footprint=[(1, "2024-01-01 00:00:00")], static=[(1, "KR")])
    g = inp.gamelogs
    assert ops.account_daily(g, inp.footprint, inp.staticaccount, ONE).collect()[0]["arenalevel"] == 1
    assert ops.match_elo_stats_daily(g, ONE).collect()[0]["arenalevel"] == 4
    assert ops.playturn_stats_daily(g, ONE).collect()[0]["arenalevel"] == 4
    assert ops.hardmatch_stats_daily(g, ONE).collect()[0]["arenalevel"] == 2
    assert ops.monster_stats_daily(g, ONE).collect()[0]["arenalevel"] == 2
    assert ops.cardweight_stats_daily(g, ONE).collect()[0]["arenalevel"] == 3


def test_retention_d30_cohort(spark):
    inp = make_inputs(spark, logs=[login(1, "2023-12-17 10:00:00", 0), login(1, "2024-01-16 10:00:00", 0),
                                   login(2, "2023-12-17 10:00:00", 2)],
                      footprint=[(1, "2023-12-17 00:00:00"), (2, "2023-12-17 08:00:00")],
                      static=[(1, "KR"), (2, "JP")])
    job = DailyJob(inp, ONE)
    assert rows(job.output("retention"), "date", "day", "arenalevel", "cnt_o", "cnt") == [
        (dt.date(2023, 12, 17), 30, 0, 1, 1), (dt.date(2023, 12, 17), 30, 2, 1, 0)]
    assert rows(job.output("retention_nu_p"), "day", "cnt_o", "cnt") == [(30, 1, 0)]
    assert rows(job.output("retention_country"), "country", "cnt_o", "cnt") == [("JP", 1, 0), ("KR", 1, 1)]


def test_cardweight_stats_median_interpolates(spark):
    logs = [(1, "2024-01-16 10:00:00", "ArenaEnd",
             {"matchtype": "ELO", "isaiarena": False, "matchedtier": 1, "myinfo": {"cardweight": w}})
            for w in (10, 20, 30, 70)]
    inp = make_inputs(spark, logs=logs)
    r = ops.cardweight_stats_daily(inp.gamelogs, ONE).collect()[0]
    assert (r["cnt"], r["avg"], r["median"], r["min"], r["max"]) == (4, 32.5, 25.0, 10, 70)
    assert abs(r["stddev"] - 22.776083947860748) < 1e-9


def test_t15_retention_counts_duplicate_copies_like_the_join(spark):
    # 3 dimension rows -> 3 account-daily rows on both days; each cohort row
    # matches 3 returning rows in the reference's left join.
    inp = make_inputs(spark, logs=[login(1, "2024-01-15 10:00:00", 2), login(1, "2024-01-16 10:00:00", 2)],
                      footprint=[(1, "2024-01-15 00:00:00")], static=[(1, "KR"), (1, "US"), (1, "JP")])
    job = DailyJob(inp, ONE)
    assert rows(job.output("retention"), "day", "arenalevel", "cnt_o", "cnt") == [(1, 2, 9, 9)]
    assert rows(job.output("retention_country"), "country", "cnt_o", "cnt") == [("JP", 3, 3), ("KR", 3, 3),
                                                                                ("US", 3, 3)]


def test_t2_rejected_values_are_counted(spark):
    inp = make_inputs(spark, logs=[
        (1, "2024-01-16 10:00:00", "Shop:Buy", {"paytype": "Cash", "productid": "x1", "price": 5}),
        (1, "2024-01-16 11:00:00", "Shop:Buy", {"paytype": "Cash", "productid": 7}),
        (1, "2024-01-16 12:00:00", "ArenaEnd", {"myinfo": {"cardweight": "heavy", "arenapoint": 99999}}),
    ])
    got = {(r.command, r.key): (r.present, r.rejected) for r in ops.rejected_values(inp.gamelogs, ONE).collect()}
    assert got[("Shop:Buy", "productid")] == (2, 1)
    assert got[("Shop:Buy", "price")] == (1, 0)
    assert got[("ArenaEnd", "myinfo.cardweight")] == (1, 1)
    assert got[("ArenaEnd", "myinfo.arenapoint")] == (1, 1)      # 99999 overflows smallint
    assert got[("ArenaEnd", "turncount")] == (0, 0)


def test_basic_daily_without_ccu_table(spark):
    inp = make_inputs(spark, logs=[login(1, "2024-01-16 10:00:00", 1)],
                      footprint=[(1, "2024-01-01 00:00:00")], static=[(1, "KR")])
    inp.ccu = None
    r = DailyJob(inp, ONE).output("basic_daily").collect()[0]
    assert (r["dau"], r["mcu"]) == (1, None)
