from .dedup import dedup_any, dedup_latest, dedup_report
from .grouping import (
    change_from_previous,
    first_times,
    group_with_share,
    group_with_totals,
    last_event,
    pct_of_total,
    pct_within,
    top_k,
    top_k_with_other,
    trend,
)
from .joins import (
    join_dim,
    join_first,
    join_many,
    join_one,
    star_join,
    with_match,
    without_match,
)
from .metric_view import MetricView
from .quarantine import Quarantine, quarantine, with_broken_rules
from .shaping import (
    cast_columns,
    fill_defaults,
    long_form,
    preview,
    reject_counts,
    row_filter,
    slice_rows,
    standardise_labels,
    union_reports,
)
from .skew import hot_keys, skew_join
from .states import distinct_from_state, distinct_state, histogram_state, quantile_from_state

__all__ = [
    "MetricView",
    "Quarantine",
    "cast_columns",
    "change_from_previous",
    "dedup_any",
    "dedup_latest",
    "dedup_report",
    "distinct_from_state",
    "distinct_state",
    "fill_defaults",
    "first_times",
    "group_with_share",
    "group_with_totals",
    "histogram_state",
    "hot_keys",
    "join_dim",
    "join_first",
    "join_many",
    "join_one",
    "last_event",
    "long_form",
    "pct_of_total",
    "pct_within",
    "preview",
    "quantile_from_state",
    "quarantine",
    "reject_counts",
    "row_filter",
    "skew_join",
    "slice_rows",
    "standardise_labels",
    "star_join",
    "top_k",
    "top_k_with_other",
    "trend",
    "union_reports",
    "with_broken_rules",
    "with_match",
    "without_match",
]
