"""Row and column shaping: previews, slices, defaults, labels, casts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import with_match


def preview(df: DataFrame, columns: Sequence[str], n: int = 10, order_by: str | None = None) -> DataFrame:
    """The first n rows of a projection; ordered by ``order_by`` (default: the first column)."""
    return df.select(*columns).orderBy(order_by or columns[0]).limit(n)


def slice_rows(
    df: DataFrame,
    where: Column | str,
    columns: Sequence[str],
    order: Sequence[str | Column],
    n: int | None = None,
) -> DataFrame:
    """Filtered projection in a given order, optionally only the first n rows."""
    rows = df.where(where).select(*columns).orderBy(*order)
    return rows if n is None else rows.limit(n)


def row_filter(df: DataFrame, key: str, allowed: DataFrame | None) -> DataFrame:
    """Only the rows a role may see.  ``None`` means no restriction."""
    if allowed is None:
        return df
    return with_match(df, allowed, key)


def fill_defaults(df: DataFrame, mapping: Mapping[str, object]) -> DataFrame:
    """Replace NULLs by a default per column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in mapping.items()})


def standardise_labels(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Map raw labels (compared trimmed and in lower case) to standard ones; others stay as they are."""
    raw = F.lower(F.trim(F.col(column)))
    standard = F.lit(None).cast("string")
    for source, target in mapping.items():
        standard = F.when(raw == source.strip().lower(), F.lit(target)).otherwise(standard)
    return df.withColumn(column, F.coalesce(standard, F.col(column)))


def cast_columns(
    df: DataFrame, types: Mapping[str, str], rejects: str = "rejected_columns"
) -> DataFrame:
    """Cast columns; a value that does not convert becomes NULL and its column is listed in
    ``rejects`` (an array, empty for a clean row)."""
    failed = F.array_compact(
        F.array(
            *[
                F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c))
                for c, t in types.items()
            ]
        )
    )
    return df.select(
        *[
            F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c)
            for c in df.columns
        ],
        failed.alias(rejects),
    )


def reject_counts(cast: DataFrame, columns: Sequence[str], rejects: str = "rejected_columns") -> DataFrame:
    """One row per column with the number of rejected values."""
    counted = cast.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.array_contains(rejects, c)).alias(c) for c in columns],
    )
    return long_form(counted, columns, "column_name", "rejected_rows", keep=["_rows"]).withColumnRenamed(
        "_rows", "total_rows"
    )


def long_form(
    row: DataFrame, columns: Sequence[str], name: str, value: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Turn the given columns of a (small) result into rows."""
    return row.unpivot(list(keep), list(columns), name, value)


def union_reports(*reports: DataFrame) -> DataFrame:
    """Stack report rows by column name."""
    stacked = reports[0]
    for report in reports[1:]:
        stacked = stacked.unionByName(report)
    return stacked
