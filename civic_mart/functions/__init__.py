from civic_mart.functions.calendar import (  # noqa: F401
    date_id, day_name, hour_diff, is_weekend, month_name, parse_day_month_year, sunday_week,
)
from civic_mart.functions.casts import (  # noqa: F401
    safe_decimal, safe_double, safe_long, strict_double, ts_iso, ts_us_ampm, try_ts_iso,
)
from civic_mart.functions.keys import surrogate_key  # noqa: F401
from civic_mart.functions.text import borough_key, url_quote  # noqa: F401
