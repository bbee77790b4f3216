"""Roll-ups: pure functions of input DataFrames and run dates."""

from tallyspark.operators.accounts import account_daily, dau  # noqa: F401
from tallyspark.operators.activity import day_bits, new_numbers  # noqa: F401
from tallyspark.operators.basic import basic_daily, basic_daily_country, new_accounts_per_day  # noqa: F401
from tallyspark.operators.ccu import ccu  # noqa: F401
from tallyspark.operators.logs import retained_log  # noqa: F401
from tallyspark.operators.match_stats import (  # noqa: F401
    arena_matches, cardweight_distribution_daily, cardweight_stats_daily, cardweight_winningrate_daily,
    cube_make_stats_daily, hardmatch_stats_daily, jewel_stats_daily, match_elo_stats_daily,
    match_eloband_stats_daily, monster_stats_daily, playturn_stats_daily,
)
from tallyspark.operators.payments import (  # noqa: F401
    paid_account_daily, revenue_daily, shop_product_daily, shop_product_daily_country,
)
from tallyspark.operators.quality import rejected_values  # noqa: F401
from tallyspark.operators.periodic import basic_period, basic_period_country  # noqa: F401
from tallyspark.operators.replay import fetch_best, pick_best, purge_picks  # noqa: F401
from tallyspark.operators.retention import retention  # noqa: F401
