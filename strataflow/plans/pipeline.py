"""The whole pipeline over catalog tables: raw, bronze, silver, gold."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import KEYS, TABLES
from ..session import shared_folder, store, tune
from ..sources.batch import write_each
from ..sources.bronze import ingest_all
from ..sources.catalog import (
    build_gold,
    build_silver,
    ensure_schema,
    read_table,
    table_name,
    tag_schema,
)
from .lakehouse import GOLD_TABLES, PARTITIONS, gold_plan
from .silver import clean_table

#: Large tables whose unique key facts are joined on: bucketed by it, they are joined where they lie.  A unique key has no hot
#: bucket; facts are reduced to one row a key before they meet them.
BUCKETED = ("applications", "users")

SILVER_PROPERTIES = {"description": "Cleaned and transformed data", "layer": "silver"}


def build_bronze_layer(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    """raw.raw_* to bronze.bronze_*; returns one result row per table."""
    return ingest_all(tune(spark), catalog=catalog)


def build_silver_layer(
    spark: SparkSession,
    tables: Iterable[str] = TABLES,
    as_of=None,
    payment_order: Sequence[str] = ("payment_time",),
    catalog: str | None = None,
) -> DataFrame:
    """bronze.bronze_* to silver.silver_*; returns one result row per table."""
    tune(spark)
    ensure_schema(spark, "silver", catalog)
    tag_schema(spark, "silver", SILVER_PROPERTIES, catalog)
    bronze = {t: read_table(spark, table_name("bronze", t, catalog)) for t in tables}

    def build(table: str) -> int:
        buckets = (int(spark.conf.get("spark.sql.shuffle.partitions")), KEYS[table]) if table in BUCKETED else None
        return build_silver(table, clean_table(table, bronze[table], as_of, payment_order), catalog, bucket_by=buckets)

    return write_each(spark, bronze, build)


def build_gold_layer(
    spark: SparkSession,
    tables: Iterable[str] = GOLD_TABLES,
    as_of=None,
    catalog: str | None = None,
    silver_result: DataFrame | None = None,
) -> DataFrame:
    """silver.silver_* to gold.gold_*; returns one result row per table.

    ``silver_result`` is what ``build_silver_layer`` returned: where it reports a failed table nothing is built, since gold would
    show that table as it was before."""
    failed = [r["table"] for r in silver_result.where(~F.col("success")).collect()] if silver_result is not None else []
    if failed:
        raise RuntimeError(f"silver tables failed, gold is left as it is: {', '.join(sorted(failed))}")
    tune(spark)
    ensure_schema(spark, "gold", catalog)

    def silver(table: str) -> DataFrame:
        return read_table(spark, table_name("silver", table, catalog))

    @cache
    def unpaid() -> DataFrame:
        return store(gold_plan("unpaid_applications", silver), shared_folder(spark, "unpaid"))

    @cache
    def counts() -> DataFrame:
        return store(gold_plan("gap_counts", silver, unpaid=unpaid), shared_folder(spark, "gap-counts"))

    def build(table: str) -> int:
        return build_gold(
            table, gold_plan(table, silver, as_of, unpaid, counts), catalog, partition_by=PARTITIONS.get(f"gold_{table}", ())
        )

    return write_each(spark, tables, build)
