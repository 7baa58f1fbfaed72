from deliverylens.functions.exprs import (  # noqa: F401
    avg_days, bucket, clip, clip_lower, daypart, days_between, iso_weekday, month_start,
    pct, pct_div_first, rnd, seconds_of, weekday_name, yyyymm,
)
