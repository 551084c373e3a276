"""Reusable metric definitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MetricView:
    """Named dimensions and measures over a table, evaluated at any grain.

    ``dims`` and ``measures`` map names to column expressions; measures are aggregates, so a
    ratio declared as ``sum(a) / sum(b)`` is right at every grain.
    """

    source: DataFrame
    dims: Mapping[str, Column]
    measures: Mapping[str, Column]

    def query(
        self,
        by: Sequence[str] = (),
        measures: Sequence[str] | None = None,
        where: Column | str | None = None,
    ) -> DataFrame:
        names = list(self.measures) if measures is None else list(measures)
        unknown = [n for n in [*by] if n not in self.dims] + [n for n in names if n not in self.measures]
        if unknown:
            raise KeyError(f"not defined in this view: {unknown}")
        rows = self.source if where is None else self.source.where(where)
        return rows.groupBy(*[self.dims[d].alias(d) for d in by]).agg(
            *[self.measures[m].alias(m) for m in names]
        )


def plain_dims(*names: str) -> dict[str, Column]:
    """Dimensions that are columns of the same name."""
    return {name: F.col(name) for name in names}
