"""Joins that stay balanced when a few keys hold a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more rows than this: about what one join task should handle.
HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every key with more than ``hot_rows`` rows, and how many: a lazy plan with map-side counts.

    There are at most (rows / ``hot_rows``) of them.  Rows without a key match nothing and are left out."""
    keys = df.select(*on).dropna()
    return keys.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str,
    hot: str,
    spread_on: str,
    probe: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner or left join where the ``hot`` side ("left" or "right") may be dominated by few keys.

    Rows of a hot key on the hot side are spread over as many join partitions as ``hot_rows`` goes into
    their number, by a hash of ``spread_on`` (a column unique on that side); the matching rows of
    the other side are repeated once per part.  Rows of the hot side without a key are spread one by one
    if the join keeps them, and dropped before the shuffle otherwise.  The result equals the plain
    join, row for row.  Nothing runs before the result is asked for.

    ``probe`` is a cheaper table with the same keys as a hot left side, to count keys in.  The hot list
    has at most (rows / ``hot_rows``) keys; it carries no hint, its measured size decides how it is joined.
    """
    if how not in ("inner", "left") or hot not in ("left", "right"):
        raise ValueError("how must be inner or left, hot must be left or right")
    if probe is not None and hot == "right":
        raise ValueError("a hot right side is counted itself: each of its hot keys must have a match")
    on = [on] if isinstance(on, str) else list(on)
    wide, narrow = (left, right) if hot == "left" else (right, left)
    counted = hot_keys(wide if probe is None else probe, on, hot_rows)
    hot_list = counted.select(*on, F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("bigint").alias("_parts"))

    missing = F.lit(False)
    for name in on:
        missing = missing | F.col(name).isNull()
    spread, parts = F.xxhash64(F.col(spread_on)), F.coalesce(F.col("_parts"), F.lit(1).cast("bigint"))
    if hot == "right" or how == "inner":
        wide = wide.where(~missing)
    part = F.when(missing, spread).otherwise(F.pmod(spread, parts))
    wide = wide.join(hot_list, on, "left").withColumn("_part", part).drop("_parts")
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))
    narrow = narrow.join(hot_list, on, "left").withColumn("_part", copies)
    keys = [*on, "_part"]
    if hot == "left":
        return wide.join(narrow.drop("_parts"), keys, how).drop("_part")

    # The repeated side is the preserved one: a hot key has matches, but not every copy does.
    joined = narrow.join(wide.withColumn("_hit", F.lit(True)), keys, how)
    if how == "left":
        joined = joined.where(F.col("_parts").isNull() | F.col("_hit"))
    return joined.drop("_part", "_parts", "_hit")
