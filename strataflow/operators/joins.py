"""Join operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import dedup_latest
from .skew import skew_join

def without_match(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` with no partner.  The right side is reduced to its distinct keys first,
    so a key that fills the right table is collapsed before the shuffle."""
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def with_match(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` that have a partner."""
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(right.select(*keys).distinct(), keys, "left_semi")


def join_dim(
    fact: DataFrame, dim: DataFrame, key: str, columns: Iterable[str | Column] = (), how: str = "inner"
) -> DataFrame:
    """Look up dimension columns by key.

    Without a hint: Spark broadcasts the dimension if its measured size allows it, and otherwise joins by
    shuffle, where adaptive execution splits skewed partitions."""
    wanted = list(columns)
    if wanted:
        dim = dim.select(key, *wanted)
    return fact.join(dim, key, how)


def star_join(fact: DataFrame, dims: Iterable[tuple[DataFrame, str, Iterable[str | Column]]]) -> DataFrame:
    """Join a fact to several dimensions."""
    for dim, key, columns in dims:
        fact = join_dim(fact, dim, key, columns)
    return fact


def join_one(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "left", spread_on: str | None = None, **skew
) -> DataFrame:
    """Join to a table that has at most one row per key.

    Where a key of ``left`` is hot, adaptive execution splits its partition.  ``skew`` (``hot_rows``) salts hot keys
    instead, over a hash of ``spread_on``, a unique column of ``left``."""
    if skew:
        return skew_join(left, right, on, how, "left", spread_on, **skew)
    return left.join(right, on, how)


def join_many(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    spread_on: str,
    how: str = "left",
    **skew,
) -> DataFrame:
    """Join to a table with any number of rows per key, one of which may be huge.

    ``spread_on`` is unique on the right side; ``skew`` goes to :func:`skew_join`."""
    return skew_join(left, right, on, how, hot="right", spread_on=spread_on, **skew)


def join_first(
    left: DataFrame, right: DataFrame, on: str, order_by: Sequence[str | Column], how: str = "left"
) -> DataFrame:
    """Join to the first row per key only, so the row count of ``left`` never grows."""
    return left.join(dedup_latest(right, on, order_by), on, how)
