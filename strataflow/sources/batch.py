"""Writing several tables in one go."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

RESULT_SCHEMA = "table string, success boolean, rows bigint, error string"


def write_each(
    spark: SparkSession, tables: Iterable[str], write: Callable[[str], int], at_once: int = 4
) -> DataFrame:
    """Run ``write`` (which returns a row count) for each table; one result row per table.

    A failing table does not stop the others, but its error is reported.  Several writes run at
    the same time, so small tables fill the gaps that the tail of a large one leaves.
    """

    def run(table: str) -> tuple[str, bool, int, str | None]:
        try:
            return table, True, write(table), None
        except Exception as error:  # reported per table
            return table, False, 0, f"{type(error).__name__}: {(str(error).splitlines() or [''])[0]}"

    with ThreadPoolExecutor(at_once) as pool:
        results = list(pool.map(run, tables))
    return spark.createDataFrame(results, RESULT_SCHEMA)
