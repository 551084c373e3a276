"""Mergeable states: small stored results from which figures at any coarser grain follow exactly.

Distinct counts cannot be summed and medians cannot be averaged.  Their states can be: a distinct count is held as bitmaps,
a distribution as a count per value.  Both are built in one pass, stored with a fine grain, and merged for each question.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_state(df: DataFrame, dims: Sequence[str | Column], id_col: str) -> DataFrame:
    """Dims, ``bucket``, ``bitmap``: which values of an integer column occur, 32,768 to a bitmap of 4 KB.

    Exact for any 64-bit id; small where ids are dense, as keys of a table are.  Nulls are no value.  Rows that repeat an id in a
    cell are one bit, set where the rows are read."""
    names = df.select(*dims).columns
    bits = df.where(F.col(id_col).isNotNull()).select(
        *dims, F.bitmap_bucket_number(id_col).alias("bucket"), F.bitmap_bit_position(id_col).alias("_bit")
    )
    return bits.groupBy(*names, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bitmap"))


def distinct_from_state(state: DataFrame, by: Sequence[str | Column], name: str) -> DataFrame:
    """The number of distinct ids by any grouping of the dims of a stored state."""
    names = state.select(*by).columns
    merged = state.select(*by, "bucket", "bitmap").groupBy(*names, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("bitmap")).alias(name))


def histogram_state(df: DataFrame, dims: Sequence[str | Column], value: str) -> DataFrame:
    """Dims, ``value``, ``n``: how often each value occurs.  Meant for values of few kinds, such as whole hours; nulls are left out."""
    names = df.select(*dims).columns
    rows = df.where(F.col(value).isNotNull()).select(*dims, F.col(value).alias("value"))
    return rows.groupBy(*names, "value").agg(F.count(F.lit(1)).alias("n"))


def quantile_from_state(state: DataFrame, by: Sequence[str], quantile: float, name: str) -> DataFrame:
    """By, ``rows``, and the least value that at least this part of the rows does not exceed: read off the running sum."""
    merged = state.groupBy(*by, "value").agg(F.sum("n").alias("n"))
    own = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    running = F.sum("n").over(own.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    reached = merged.withColumns({"_running": running, "rows": F.sum("n").over(own)}).where(
        F.col("_running") >= F.ceil(F.col("rows") * F.lit(quantile))
    )
    return reached.groupBy(*by).agg(F.max("rows").alias("rows"), F.min("value").alias(name))
