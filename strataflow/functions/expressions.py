"""Column expressions.  All are built-in Spark functions, so they stay inside codegen."""

from __future__ import annotations

import operator
from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}

# Fixed value: the accepted e-mail shape (the dot before the top-level domain is literal).
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bucketize(
    value: Column | str,
    comparison: str,
    steps: Iterable[tuple[object, str]],
    otherwise: str,
    null_label: str | None = None,
) -> Column:
    """Label ``value`` by the first step it satisfies.

    ``bucketize(days, "<=", [(7, "Fast"), (14, "Standard")], "Slow")``.  A NULL satisfies no
    step and so receives ``otherwise``, unless ``null_label`` is given.
    """
    value = _col(value)
    test = _COMPARE[comparison]
    chain = F
    if null_label is not None:
        chain = chain.when(value.isNull(), F.lit(null_label))
    for bound, label in steps:
        chain = chain.when(test(value, F.lit(bound)), F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def flag(condition: Column) -> Column:
    """A boolean that is FALSE where the condition is unknown."""
    return F.coalesce(condition, F.lit(False))


def only_if(condition: Column, value: Column | str) -> Column:
    """``value`` where the condition holds, otherwise NULL."""
    return F.when(condition, _col(value))


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true; 0 on empty input."""
    return F.count_if(condition)


def sum_where(condition: Column, value: Column | str) -> Column:
    """Sum of ``value`` where the condition holds, 0 where nothing does."""
    value = _col(value)
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a rounded percentage of ``whole`` (double); NULL when ``whole`` is zero."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def stable_round(value: Column, digits: int = 2) -> Column:
    """Round a double half up, first to ten places.

    A distributed sum of doubles differs in its last bits with the order of addition.  The first
    step removes that noise, so a tie such as 46.725 is not decided by it."""
    return F.round(F.round(value, 10), digits)


def rounded_avg(value: Column | str, digits: int = 2) -> Column:
    """Rounded mean of an integer or double column."""
    return stable_round(F.avg(_col(value)), digits)


def exact_avg(total: Column, rows: Column, digits: int = 2) -> Column:
    """Mean of a decimal total over a count, divided and rounded half up in decimal arithmetic.

    Taking total and count (not the values) lets a partial sum be finished after a shuffle, and
    decimals make the result independent of the order of addition.
    """
    divided = F.try_divide(total.cast("decimal(24,2)"), rows.cast("decimal(13,0)"))
    return F.round(divided, digits).cast("double")


def email_ok(value: Column | str) -> Column:
    return _col(value).rlike(EMAIL_PATTERN)


def as_time(as_of: Column | datetime | date | str | None) -> Column:
    """The reference moment of a plan.  ``None`` means now."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp_ntz")


def days_elapsed(start: Column | str, end: Column | str) -> Column:
    """Whole 24-hour units between two moments (23:00 to 01:00 the next day is 0)."""
    return F.timestamp_diff("DAY", _col(start), _col(end))


def hours_elapsed(start: Column | str, end: Column | str) -> Column:
    """Whole hours between two moments."""
    return F.timestamp_diff("HOUR", _col(start), _col(end))


def hours_fraction(start: Column | str, end: Column | str) -> Column:
    """Hours between two moments as a double, from whole seconds."""
    return (F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))) / F.lit(3600)


def week_start(moment: Column | str) -> Column:
    """Monday of the week as a date."""
    return F.date_trunc("WEEK", _col(moment)).cast("date")


def month_start(year: Column | str, month: Column | str) -> Column:
    return F.make_date(_col(year), _col(month), F.lit(1))


def threshold_status(
    value: Column | str,
    comparison: str,
    rules: Iterable[tuple[object, str]],
    otherwise: str,
) -> Column:
    """Traffic-light label of a measure; an unknown measure gets ``"unknown"``."""
    return bucketize(value, comparison, rules, otherwise, null_label="unknown")
