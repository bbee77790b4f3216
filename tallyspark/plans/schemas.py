"""Output tables: columns, types and replace keys (column order = insert order)."""

from __future__ import annotations

from tallyspark.operators.activity import BITS, NUMBERS

OUTPUT_SCHEMAS: dict[str, str] = {
    "account_daily": "date date, oidaccount bigint, arenalevel smallint, isnew boolean, country string",
    "paid_account_daily": "date date, oidaccount bigint, cnt bigint, amount bigint",
    "shop_product_daily": "date date, paytype string, productid int, cnt bigint, amount bigint",
    "shop_product_daily_country":
        "date date, country string, paytype string, productid int, cnt bigint, amount bigint",
    "revenue_daily": "date date, country string, pu bigint, revenue bigint",
    "dau": "date date, arenalevel smallint, dau bigint",
    "basic_daily": "date date, ru bigint, nru bigint, dau bigint, dau_p bigint, dpu bigint, revenue bigint, mcu int",
    "basic_daily_country":
        "date date, country string, nru bigint, dau bigint, dau_p bigint, dpu bigint, revenue bigint",
    "basic_weekly": "date date, nru bigint, au bigint, pu bigint, revenue bigint",
    "basic_monthly": "date date, nru bigint, au bigint, pu bigint, revenue bigint",
    "basic_weekly_country": "date date, country string, nru bigint, au bigint, pu bigint, revenue bigint",
    "basic_monthly_country": "date date, country string, nru bigint, au bigint, pu bigint, revenue bigint",
    "retention": "date date, day int, arenalevel smallint, cnt_o bigint, cnt bigint, rate double",
    "retention_nu": "date date, day int, cnt_o bigint, cnt bigint, rate double",
    "retention_nu_p": "date date, day int, cnt_o bigint, cnt bigint, rate double",
    "retention_country": "date date, day int, country string, cnt_o bigint, cnt bigint, rate double",
    "retention_country_p": "date date, day int, country string, cnt_o bigint, cnt bigint, rate double",
    "match_elo_stats_daily": "date date, isai boolean, arenalevel smallint, cnt bigint, cnt_win bigint",
    "monster_stats_daily":
        "date date, monsterid int, arenalevel smallint, isai boolean, type string, cnt bigint, cnt_win bigint",
    "playturn_stats_daily":
        "date date, arenalevel smallint, isai boolean, matchtype string, cnt bigint, sum_turn bigint, "
        "sum_playtime bigint, max_turn smallint, max_playtime int, min_turn smallint, min_playtime int",
    "cube_make_stats_daily": "date date, grade string, cnt bigint, cnt_jewel bigint",
    "jewel_stats_daily": "date date, command string, reason string, cnt bigint, amount bigint",
    "cardweight_winningrate_daily": "date date, diff int, cnt bigint, cnt_win bigint",
    "cardweight_distribution_daily": "date date, arenalevel smallint, cardweight smallint, cnt bigint",
    "cardweight_stats_daily":
        "date date, arenalevel smallint, cnt bigint, avg double, median double, stddev double, "
        "min smallint, max smallint",
    "hardmatch_stats_daily":
        "date date, arenalevel smallint, difficulttype string, cnt_match bigint, total_bonus bigint",
    "match_eloband_stats_daily": "date date, isai boolean, eloband_my int, eloband_op int, cnt bigint",
    "ccu": "time timestamp, ccu int",
}

RETENTION_TABLES = ("retention", "retention_nu", "retention_nu_p", "retention_country", "retention_country_p")
WEEKLY_TABLES = ("basic_weekly", "basic_weekly_country")
MONTHLY_TABLES = ("basic_monthly", "basic_monthly_country")


def column_names(table: str) -> list[str]:
    return [part.strip().split(" ")[0] for part in OUTPUT_SCHEMAS[table].split(",")]

# Stored tables beyond the daily outputs.
OUTPUT_SCHEMAS.update({
    "account_numbers": NUMBERS,
    "account_bits_daily": BITS,
    "crm_ccu": "time timestamp, ccu int, day date",
})


def partition_columns(table: str) -> tuple[str, ...]:
    """Replace key of each output table (the partition layout)."""
    if table == "crm_ccu":
        return ("day",)
    return ("date",)
