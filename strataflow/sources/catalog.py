"""Named tables, layer namespaces, sinks, comments and manifests.

Names follow ``<layer>.<layer>_<table>``, for example ``silver.silver_users``; a catalog name may
be put in front.  Tables are Parquet: open-source Spark has no built-in format that replaces a
table and its schema in one commit.  So each full write makes a version, a table ``<name>__v_<id>`` of its own, and
the name itself is a view of the newest one, replaced by a single change in the catalog.  A reader finds the old
version or the new one, never none.  The view also carries the row count, so a manifest reads no data.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_folder

LAYERS = ("raw", "bronze", "silver", "gold")


def layer_schema(layer: str, catalog: str | None = None) -> str:
    return f"{catalog}.{layer}" if catalog else layer


def table_name(layer: str, table: str, catalog: str | None = None) -> str:
    return f"{layer_schema(layer, catalog)}.{layer}_{table}"


def _text(value: object) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def _ident_part(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def read_table(
    spark: SparkSession, name: str, schema: T.StructType | None = None, path: str | None = None
) -> DataFrame:
    """A catalog table by name, or Parquet files with a declared schema."""
    if path is None:
        return spark.table(name)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def ensure_schema(spark: SparkSession, layer: str, catalog: str | None = None, location: str | None = None) -> None:
    where = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_ident(layer_schema(layer, catalog))}{where}")


def tag_schema(
    spark: SparkSession, layer: str, props: Mapping[str, str], catalog: str | None = None
) -> None:
    pairs = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in props.items())
    spark.sql(f"ALTER SCHEMA {_ident(layer_schema(layer, catalog))} SET DBPROPERTIES ({pairs})")


def schema_properties(spark: SparkSession, layer: str, catalog: str | None = None) -> dict[str, str]:
    """What ``tag_schema`` has set."""
    described = spark.sql(f"DESCRIBE SCHEMA EXTENDED {_ident(layer_schema(layer, catalog))}").collect()
    listed = next((r["info_value"] for r in described if r["info_name"] == "Properties"), "")
    return dict(pair.split(",", 1) for pair in listed.strip("()").split("), (") if "," in pair)


def list_schemas(spark: SparkSession) -> list[str]:
    return sorted(d.name for d in spark.catalog.listDatabases())


def list_tables(spark: SparkSession, layer: str, catalog: str | None = None) -> list[str]:
    """Names of the tables, not of their versions."""
    return sorted(
        t.name for t in spark.catalog.listTables(layer_schema(layer, catalog)) if not t.isTemporary and VERSION not in t.name
    )


def add_audit(
    df: DataFrame, layer: str, source: str | None = None, ts: Column | datetime | None = None
) -> DataFrame:
    """Audit columns of a layer: processing time and, below gold, the source table."""
    moment = F.current_timestamp() if ts is None else ts if isinstance(ts, Column) else F.lit(ts)
    if layer == "gold":
        return df.withColumn("gold_created_timestamp", moment)
    time_column = {"bronze": "bronze_ingestion_timestamp", "silver": "silver_processed_timestamp"}[layer]
    return df.withColumns({time_column: moment, f"{layer}_source_table": F.lit(source)})


def add_source_file(df: DataFrame, column: str = "source_file") -> DataFrame:
    """Path of the file each row was read from.  ``df`` is a file scan."""
    return df.withColumn(column, F.col("_metadata.file_path"))


VERSION = "__v_"


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_ident(name)}").collect()}


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def _publish(
    spark: SparkSession,
    name: str,
    version: str,
    rows: int,
    previous: str | None,
    comment: str | None,
    comments: Mapping[str, str],
    columns: Sequence[str],
) -> None:
    """Let ``name`` show ``columns`` of ``version``: one change in the catalog."""
    shown = ", ".join(_ident_part(c) + (f" COMMENT {_text(comments[c])}" if comments.get(c) else "") for c in columns)
    picked = ", ".join(map(_ident_part, columns))
    props = {"version": version, "row_count": rows, **({"previous": previous} if previous else {})}
    pairs = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in props.items())
    about = f" COMMENT {_text(comment)}" if comment else ""
    spark.sql(f"CREATE OR REPLACE VIEW {_ident(name)} ({shown}){about} TBLPROPERTIES ({pairs}) AS SELECT {picked} FROM {_ident(version)}")


def _drop_version(spark: SparkSession, version: str) -> None:
    """Drop a version and, where it has a path of its own, its files."""
    if not spark.catalog.tableExists(version):
        return
    where = [r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {_ident(version)}").collect() if r["col_name"] == "Location"]
    spark.sql(f"DROP TABLE {_ident(version)}")
    for location in where:
        remove_folder(spark, location)


def _write_rows(
    df: DataFrame, name: str, mode: str, partition_by: Sequence[str], bucket_by: tuple[int, str] | None, path: str | None
) -> int:
    """Rows are counted while they are written, so there is no second pass over the input."""
    seen = Observation()
    if bucket_by:
        df = df.repartition(*bucket_by)  # one file a bucket
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return int(seen.get["rows"])


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    path: str | None = None,
    bucket_by: tuple[int, str] | None = None,
) -> int:
    """Write a table and return the number of rows written.

    ``partition_by`` is meant for columns with few values (year, month) that readers filter on; ``bucket_by`` (number, column)
    for a unique key that large tables are joined on, so that they meet without a shuffle.

    An overwrite writes a new version and then points the name at it, so a write that fails leaves the table as it
    was, a reader always finds one, and ``df`` may read the table it replaces.  The version before stays for those who
    still read it; the one before that is dropped.  Comments are kept.  An append goes into the current version.
    Writers do not disturb each other: the one that ends last is the one shown.
    """
    spark = df.sparkSession
    known = spark.catalog.tableExists(name)
    managed = known and _is_view(spark, name)
    if mode == "append" and known:
        if not managed:
            return _write_rows(df, name, mode, partition_by, bucket_by, path)
        now = _properties(spark, name)
        rows = _write_rows(df, now["version"], mode, partition_by, bucket_by, None)
        spark.sql(f"ALTER VIEW {_ident(name)} SET TBLPROPERTIES ('row_count' = {_text(int(now['row_count']) + rows)})")
        return rows
    version = f"{name}{VERSION}{uuid.uuid4().hex}"
    rows = _write_rows(df, version, "errorifexists", partition_by, bucket_by, f"{path.rstrip('/')}/{uuid.uuid4().hex}" if path else None)
    now, comment, columns = {}, None, {}
    if managed:
        now = _properties(spark, name)
        comment = spark.catalog.getTable(name).description
        columns = {c.name: c.description for c in spark.catalog.listColumns(name) if c.description}
    elif known:  # a table of another origin: it gives way once
        spark.sql(f"DROP TABLE {_ident(name)}")
    _publish(spark, name, version, rows, now.get("version"), comment, columns, df.columns)
    if now.get("previous"):
        _drop_version(spark, now["previous"])
    return rows


def build_gold(
    name: str,
    df: DataFrame,
    catalog: str | None = None,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, str] | None = None,
    schema: str | None = None,
) -> int:
    """Create or replace a gold table from a query.  ``schema`` takes the place of the gold schema."""
    target = f"{schema}.gold_{name}" if schema else table_name("gold", name, catalog)
    return write_table(add_audit(df, "gold"), target, partition_by=partition_by, path=path, bucket_by=bucket_by)


def build_silver(
    name: str,
    df: DataFrame,
    catalog: str | None = None,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, str] | None = None,
    schema: str | None = None,
) -> int:
    """Create or replace a silver table, stamped with its bronze source.  ``schema`` takes the place of the silver schema."""
    source = table_name("bronze", name, catalog)
    target = f"{schema}.silver_{name}" if schema else table_name("silver", name, catalog)
    return write_table(add_audit(df, "silver", source), target, partition_by=partition_by, path=path, bucket_by=bucket_by)


def manifest(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, by name."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    stacked = counts[0]
    for one in counts[1:]:
        stacked = stacked.unionByName(one)
    return stacked.orderBy("table_name")


def layer_manifest(spark: SparkSession, layer: str, catalog: str | None = None, schema: str | None = None) -> DataFrame:
    """Tables of a layer with row count, storage format and location.

    Counts were taken while the tables were written and are read from the catalog: no data file is opened.  Only tables that
    were not written by ``write_table`` are counted.  ``schema`` takes the place of the layer's schema."""
    where = schema or layer_schema(layer, catalog)
    stored = {}
    for t in spark.catalog.listTables(where):
        if not t.isTemporary and VERSION not in t.name:
            counted = _properties(spark, f"{where}.{t.name}").get("row_count")
            stored[t.name] = int(counted) if counted else spark.table(f"{where}.{t.name}").count()
    return spark.createDataFrame(sorted(stored.items()), "table_name string, row_count long").select(
        "table_name",
        "row_count",
        F.lit("parquet").alias("storage_format"),
        F.lit("catalog table").alias("storage_type"),
        F.lit("Persisted").alias("status"),
        F.lit(where).alias("schema_location"),
    )


def layer_summary(counts: DataFrame, location: str, storage_format: str = "parquet") -> DataFrame:
    """A layer in (metric, value) rows, computed from its manifest."""
    totals = counts.agg(F.count(F.lit(1)).alias("tables"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("n"))
    values = {
        "Total Tables": F.concat(F.col("tables").cast("string"), F.lit(" tables")),
        "Total Rows": F.concat(F.format_number("n", 0), F.lit(" rows")),
        "Storage Format": F.lit(storage_format),
        "Storage Location": F.lit(location),
        "Status": F.when(F.col("tables") > 0, "All tables persisted and queryable").otherwise("Empty"),
    }
    entries = [F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in values.items()]
    return totals.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def comment_table(
    spark: SparkSession, name: str, comment: str | None = None, columns: Mapping[str, str] | None = None
) -> None:
    """Table and column comments; later versions of the table keep them."""
    if _is_view(spark, name):
        now = _properties(spark, name)
        comment = comment if comment is not None else spark.catalog.getTable(name).description
        known = {c.name: c.description for c in spark.catalog.listColumns(name) if c.description}
        _publish(
            spark, name, now["version"], int(now["row_count"]), now.get("previous"), comment, known | dict(columns or {}),
            spark.table(name).columns,
        )
        return
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {_ident(name)} IS {_text(comment)}")
    for column, text in (columns or {}).items():
        spark.sql(f"ALTER TABLE {_ident(name)} ALTER COLUMN {_ident(column)} COMMENT {_text(text)}")


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE EXTENDED {_ident(name)}")


def bounded_read(spark: SparkSession, name: str, n: int = 100) -> DataFrame:
    """A look at a table: any n rows."""
    return spark.table(name).limit(n)
