from .expressions import (
    as_time,
    bucketize,
    count_where,
    days_elapsed,
    email_ok,
    exact_avg,
    flag,
    hours_elapsed,
    hours_fraction,
    month_start,
    only_if,
    pct,
    rounded_avg,
    stable_round,
    sum_where,
    threshold_status,
    week_start,
)

__all__ = [
    "as_time",
    "bucketize",
    "count_where",
    "days_elapsed",
    "email_ok",
    "exact_avg",
    "flag",
    "hours_elapsed",
    "hours_fraction",
    "month_start",
    "only_if",
    "pct",
    "rounded_avg",
    "stable_round",
    "sum_where",
    "threshold_status",
    "week_start",
]
