"""Session settings the library relies on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Runtime SQL settings.  AQE splits skewed join partitions and re-plans on measured sizes; the
# forced variant lets it do so even when that costs one more shuffle downstream.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cores: str | int = "*",
    app_name: str = "strataflow",
    partitions: int = 8,
    memory: str = "16g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A single-machine session for tests and benchmarks.  On a cluster use the given session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in {**RUNTIME_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name, on whatever file system it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is; a missing one is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="strataflow-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


_MADE: list[str] = []


def drop_shared(spark: SparkSession) -> None:
    """Delete all folders that this process made by ``shared_folder``: results built on them must have been written by then."""
    while _MADE:
        remove_folder(spark, _MADE.pop())


@atexit.register
def _drop_local() -> None:
    """What is left at the end of the process, where it lies on a file system that Python sees; elsewhere call ``drop_shared``."""
    for path in _MADE:
        plain = path.removeprefix("file://").removeprefix("file:")
        if plain.startswith("/"):
            shutil.rmtree(plain, ignore_errors=True)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for ``purpose`` below the folder named by ``spark.checkpoint.dir``.

    Data written there outlives the executors, so a lost executor never loses it.  Where the
    setting is missing, only a local-mode session (a test) may fall back to a temporary folder.  The folder goes with the
    process that made it, or earlier by ``drop_shared``.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_folder()
    _MADE.append(f"{base.rstrip('/')}/strataflow/{purpose}-{uuid.uuid4().hex}")
    return _MADE[-1]


def store(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a result that several plans share, and return the stored form.

    This cuts the lineage: whatever is built on the result scans files that survive a lost
    executor, reads only the columns it needs and knows the true size.  ``partition_by`` is meant for columns of few values that
    readers filter on: they then open only the partitions they want."""
    return store_counted(df, path, partition_by)[0]


def store_counted(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """``store``, and the number of rows, counted while they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").partitionBy(*partition_by).parquet(path, compression="zstd")
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return (stored.select(*[f"`{c.replace('`', '``')}`" for c in df.columns]) if partition_by else stored), int(seen.get["rows"])
