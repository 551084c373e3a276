"""Aggregation, share, ranking and window operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pct
from ..functions.moments import moment, time_of


def first_times(
    events: DataFrame, key: str, kind: str, time: str, names: Mapping[str, str]
) -> DataFrame:
    """First time of each event kind per key, one column per kind (``names``: kind -> column)."""
    return events.groupBy(key).agg(
        *[
            F.min(F.when(F.col(kind) == value, F.col(time))).alias(column)
            for value, column in names.items()
        ]
    )


def last_event(
    events: DataFrame, key: str, time: str, tiebreak: str, columns: Sequence[str]
) -> DataFrame:
    """Last event per key with a fixed tiebreak (an integer column).

    Events are first reduced to the newest of each key and value of ``columns`` (event types, say), a hash aggregate of
    fixed width that is combined map-side: the history of a key is never sorted, however long.
    """
    latest = newest_by(events, key, time, tiebreak, columns).where(F.col("_place") == 1)
    return latest.select(key, time_of(F.col("_moment"), events.schema[time].dataType).alias(time), *columns)


def newest_by(events: DataFrame, key: str, time: str, tiebreak: str, columns: Sequence[str]) -> DataFrame:
    """One row per key and value of ``columns``: ``_rows``, the newest ``_moment``, and ``_place`` by it within the key."""
    kinds = events.groupBy(key, *columns).agg(
        F.count(F.lit(1)).alias("_rows"), F.max(moment(time, tiebreak)).alias("_moment")
    )
    order = Window.partitionBy(key).orderBy(F.desc("_moment"), *[F.desc(c) for c in columns])
    return kinds.withColumn("_place", F.row_number().over(order))


#: Parts that a total is handed to: enough for any result that is shown in groups.
TOTAL_PARTS = 32


def group_with_totals(
    df: DataFrame, dims: Sequence[str | Column], measures: Mapping[str, Column], totals: Sequence[str]
) -> DataFrame:
    """Measures by ``dims``, and for each of ``totals`` its value over all rows as ``_total_<name>``: one pass over ``df``.

    Grouping sets compute the groups and the total row together.  The total row is then copied to a fixed number of parts, over
    which the groups are spread by a hash, so that it meets them without a join and without gathering them in one task.
    """
    names = df.select(*dims).columns
    rows = df.withColumns({n: d for n, d in zip(names, dims) if isinstance(d, Column)})
    grouped = rows.groupingSets([names, []], *names).agg(
        F.grouping_id().alias("_set"), *[column.alias(name) for name, column in measures.items()]
    )
    whole = F.col("_set") != 0
    own = F.array(F.pmod(F.xxhash64(*names), F.lit(TOTAL_PARTS)).cast("int"))
    part = F.explode(F.when(whole, F.sequence(F.lit(0), F.lit(TOTAL_PARTS - 1))).otherwise(own))
    everywhere = Window.partitionBy("_part")
    spread = grouped.withColumn("_part", part).withColumns(
        {f"_total_{name}": F.max(F.when(whole, F.col(name))).over(everywhere) for name in totals}
    )
    return spread.where(~whole).drop("_set", "_part")


def group_with_share(
    df: DataFrame, dims: Sequence[str | Column], measures: Mapping[str, Column], of: str, name: str, digits: int = 2
) -> DataFrame:
    """Measures by ``dims`` and the share of each group in the total of the measure ``of``: one pass over ``df``."""
    grouped = group_with_totals(df, dims, measures, [of])
    return grouped.withColumn(name, pct(F.col(of), F.col(f"_total_{of}"), digits)).drop(f"_total_{of}")


def pct_of_total(grouped: DataFrame, measure: str, name: str, digits: int = 2) -> DataFrame:
    """Add the share of each row in the total of ``measure``.

    ``grouped`` is read twice, so give it a stored result; :func:`group_with_share` groups and shares in one pass."""
    total = grouped.agg(F.sum(measure)).scalar()
    return grouped.withColumn(name, pct(F.col(measure), total, digits))


def pct_within(
    grouped: DataFrame, measure: str, within: str | Sequence[str], total_name: str, pct_name: str
) -> DataFrame:
    """Add the total of the enclosing group and the share in it.  Input is already aggregated."""
    keys = [within] if isinstance(within, str) else list(within)
    return grouped.withColumn(
        total_name, F.sum(measure).over(Window.partitionBy(*keys))
    ).withColumn(pct_name, pct(F.col(measure), F.col(total_name)))


def top_k(df: DataFrame, by: str, k: int, tiebreak: str) -> DataFrame:
    """The k rows with the greatest measure; equal measures are ordered by ``tiebreak``."""
    return df.orderBy(F.desc(by), F.asc(tiebreak)).limit(k)


def top_k_with_other(
    df: DataFrame, dim: str, measure: str, k: int = 5, other: str = "Other", share: str | None = None
) -> DataFrame:
    """Sum of ``measure`` for the k greatest members of ``dim`` and one row for the rest, in one pass over ``df``.

    With ``share`` a column of that name holds the share of the whole.  The rest is the total less the leaders, of which at
    most k + 1 are gathered in a row."""
    members = group_with_totals(df, [dim], {measure: F.sum(measure)}, [measure])
    total = f"_total_{measure}"
    member = F.struct(F.col(measure), F.col(dim))
    first = top_k(members, measure, k + 1, dim).agg(F.collect_list(member).alias("_all"), F.max(total).alias(total))

    def before(a: Column, b: Column) -> Column:
        greater = F.when(a[measure] > b[measure], -1).when(a[measure] < b[measure], 1)
        missing = greater.when(a[measure].isNull() & b[measure].isNotNull(), 1).when(a[measure].isNotNull() & b[measure].isNull(), -1)
        return missing.when(a[dim].isNull(), -1).when(b[dim].isNull(), 1).when(a[dim] < b[dim], -1).when(a[dim] > b[dim], 1).otherwise(0)

    ordered = F.array_sort("_all", before)
    leaders = F.slice(ordered, 1, k)
    kind = df.select(F.sum(measure)).schema[0].dataType
    held = F.aggregate(leaders, F.lit(0).cast(kind), lambda sum_, m: (sum_ + F.coalesce(m[measure], F.lit(0))).cast(kind))
    rest = F.array(F.struct((F.coalesce(F.col(total), F.lit(0)) - held).cast(kind).alias(measure), F.lit(other).alias(dim)))
    rows = F.concat(leaders, F.when(F.size("_all") > k, rest).otherwise(F.slice(leaders, 1, 0)))
    result = first.select(total, F.explode(rows).alias("_m")).select(f"_m.{dim}", f"_m.{measure}", total)
    return result.withColumn(share, pct(F.col(measure), F.col(total))).drop(total) if share else result.drop(total)


def trend(
    df: DataFrame, dims: Sequence[str | Column], measures: Mapping[str, Column]
) -> DataFrame:
    """Measures by any dimensions or periods."""
    return df.groupBy(*dims).agg(*[column.alias(name) for name, column in measures.items()])


def change_from_previous(
    log: DataFrame, series: str, period: str, value: str, alert_above_pct: float = 20.0
) -> DataFrame:
    """Previous value, change in percent and an alert flag per series (day over day)."""
    previous = F.lag(value).over(Window.partitionBy(series).orderBy(period))
    change = pct(F.col(value) - F.col("previous_value"), F.col("previous_value"))
    return (
        log.withColumn("previous_value", previous)
        .withColumn("change_pct", change)
        .withColumn(
            "is_alert", F.coalesce(F.abs(F.col("change_pct")) > F.lit(alert_above_pct), F.lit(False))
        )
    )
