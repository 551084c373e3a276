"""Uniqueness on a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_any(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row per key, whichever comes first."""
    return df.dropDuplicates([key] if isinstance(key, str) else list(key))


def dedup_latest(
    df: DataFrame, key: str | Sequence[str], order_by: Sequence[str | Column] = ()
) -> DataFrame:
    """One row per key: the greatest by ``order_by`` (strings mean descending).

    A hash of the whole row ends the order, so equal candidates are chosen alike on every run.
    Spark plans ``row_number() = 1`` with a per-partition limit before the shuffle: however many
    copies a key has, one row per input partition travels.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.desc(c) if isinstance(c, str) else c for c in order_by]
    order.append(F.desc("_row_hash"))
    ranked = df.withColumn("_row_hash", F.xxhash64(*df.columns)).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where(F.col("_rank") == 1).drop("_rank", "_row_hash")


def dedup_report(df: DataFrame, key: str, table_name: str = "table") -> DataFrame:
    """One row: rows before, distinct keys after, duplicates removed."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return (
        per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("initial_rows"),
            F.count(F.lit(1)).alias("final_rows"),
        )
        .select(
            F.lit(table_name).alias("table_name"),
            "initial_rows",
            "final_rows",
            (F.col("initial_rows") - F.col("final_rows")).alias("duplicates_removed"),
        )
    )
