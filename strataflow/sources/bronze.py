"""Bronze ingestion: a copy of each raw table with audit columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..schemas import TABLES
from .batch import write_each
from .catalog import add_audit, ensure_schema, table_name, write_table


def copy_raw_to_bronze(
    spark: SparkSession,
    table: str,
    mode: str = "overwrite",
    ingested_at: datetime | None = None,
    source: DataFrame | None = None,
    catalog: str | None = None,
    folder: str | None = None,
    schema: str | None = None,
) -> int:
    """Copy one raw table and return the rows written.  ``source`` replaces the catalog table,
    ``schema`` the bronze schema that the copy goes to."""
    raw_name = table_name("raw", table, catalog)
    rows = spark.table(raw_name) if source is None else source
    path = f"{folder}/bronze_{table}" if folder else None
    target = f"{schema}.bronze_{table}" if schema else table_name("bronze", table, catalog)
    return write_table(add_audit(rows, "bronze", raw_name, ingested_at), target, mode, path=path)


def ingest_all(
    spark: SparkSession,
    tables: Iterable[str] = TABLES,
    mode: str = "overwrite",
    sources: Mapping[str, DataFrame] | None = None,
    catalog: str | None = None,
    folder: str | None = None,
    at_once: int = 4,
    schema: str | None = None,
) -> DataFrame:
    """Copy a list of tables; one result row per table with rows or the error.

    A ``schema`` given must exist; without one the bronze schema is made where it is missing."""
    if schema is None:
        ensure_schema(spark, "bronze", catalog)
    now = datetime.now()

    def copy(table: str) -> int:
        source = None if sources is None else sources[table]
        return copy_raw_to_bronze(spark, table, mode, now, source, catalog, folder, schema)

    return write_each(spark, tables, copy, at_once)
