"""Helpers shared by the operators: tables, stored intermediates, safe column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.session import shared_folder, store


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result that later steps read more than once to the shared folder; read it back.

    The stored rows fix generated ids and survive lost executors."""
    return store(df, shared_folder(df.sparkSession, purpose))


def fresh(df: DataFrame, wanted: str) -> str:
    """A column name that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    name = f"_{wanted}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def col(name: str):
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")
