"""Rows that break a rule are set apart, not dropped: one pass writes good and rejected rows and counts both."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

BROKEN, REJECTED = "broken_rules", "rejected"


@dataclass(frozen=True)
class Quarantine:
    """Good rows as they were; rejected rows with the names of all rules they break; rows per rule, counted while writing."""

    good: DataFrame
    rejected: DataFrame
    counts: Mapping[str, int]

    def report(self) -> DataFrame:
        """One row a rule, and the rows read, good and rejected: check_name, rows."""
        rows = list(self.counts.items())
        return self.good.sparkSession.createDataFrame(rows, "check_name string, rows long")


def with_broken_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``broken_rules``: names of the rules that a row breaks, in their order.  A rule that is unknown (null) is not broken."""
    broken = [F.when(~rule, F.lit(name)) for name, rule in rules.items()]
    return df.withColumn(BROKEN, F.array_compact(F.array(*broken)))


def quarantine(df: DataFrame, rules: Mapping[str, Column], path: str) -> Quarantine:
    """Split ``df`` by its rules and write both parts below ``path``.

    The input is read once: rules are columns of the row, the two parts are partitions of one write, and the counts are
    observed as the rows pass."""
    marked = with_broken_rules(df, rules)
    bad = F.size(BROKEN) > 0
    seen = Observation()
    counted = {
        "rows read": F.count(F.lit(1)),
        "good rows": F.count_if(~bad),
        "rejected rows": F.count_if(bad),
        **{name: F.count_if(F.array_contains(BROKEN, name)) for name in rules},
    }
    observed = marked.observe(seen, *[column.alias(name) for name, column in counted.items()])
    observed.withColumn(REJECTED, bad).write.mode("overwrite").partitionBy(REJECTED).parquet(path)
    stored = df.sparkSession.read.schema(marked.withColumn(REJECTED, bad).schema).parquet(path)
    rejected = stored.where(F.col(REJECTED)).drop(REJECTED).select(*marked.columns)
    return Quarantine(
        stored.where(~F.col(REJECTED)).select(*df.columns), rejected, {name: int(seen.get[name] or 0) for name in counted}
    )
