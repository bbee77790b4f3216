"""Column helpers: payload extraction, casts, calendar arithmetic, bands."""

from tallyspark.functions.dates import (  # noqa: F401
    bucket_key_before, bucket_series, event_run_dates, first_day_of_month,
    first_day_of_week, last_day_of_month, last_day_of_week, minute_floor,
)
from tallyspark.functions.payload import int2, int4, json_fields, json_text, nested_fields  # noqa: F401
from tallyspark.functions.numeric import elo_band, int_diff  # noqa: F401
