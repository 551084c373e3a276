from .bronze import copy_raw_to_bronze, ingest_all
from .catalog import (
    add_audit,
    add_source_file,
    bounded_read,
    build_gold,
    build_silver,
    comment_table,
    describe,
    ensure_schema,
    layer_manifest,
    layer_summary,
    list_schemas,
    list_tables,
    manifest,
    read_table,
    schema_properties,
    table_name,
    tag_schema,
    write_table,
)

__all__ = [
    "add_audit",
    "add_source_file",
    "bounded_read",
    "build_gold",
    "build_silver",
    "comment_table",
    "copy_raw_to_bronze",
    "describe",
    "ensure_schema",
    "ingest_all",
    "layer_manifest",
    "layer_summary",
    "list_schemas",
    "list_tables",
    "manifest",
    "read_table",
    "schema_properties",
    "table_name",
    "tag_schema",
    "write_table",
]
