"""Silver and gold from new bronze rows alone.

``CurrentRows`` holds the current version of each key, in ranges of the key.  A micro-batch of new bronze rows is
merged into it by key: only the ranges it touches are read and rewritten.  What changed is kept as a feed of rows before and after,
and ``refresh_partitions`` recomputes just the partitions of a gold table that the feed reaches.

A merge can be lost at any point and repeated.  Its result is first written beside the table, with the rows that it replaces; the
feed is derived from that; then the touched ranges are replaced, from the written result, as often as need be.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.silver import enrich_rows, valid_rows, version_order
from ..schemas import KEYS, RAW_SCHEMAS
from ..session import folder_exists, remove_folder, store

RANGE = "_range"
#: Keys of a range: about what one task should rewrite.
RANGE_KEYS = 1_000_000
#: Of a staged row: whether the batch brought it, and whether it is the newest of its key; the others go.
MARKS = (T.StructField("is_new", T.BooleanType()), T.StructField("is_current", T.BooleanType()))


class CurrentRows:
    """The newest valid version of each key of a table, below ``folder``.

    ``order_by`` names the columns that order the versions of a key, after their arrival; those outside the schema of the
    table are kept with the rows.  Rows with an integer key only; rows without one are versions of one row, as in a full build."""

    def __init__(self, spark: SparkSession, table: str, folder: str, order_by: Sequence[str], range_keys: int = RANGE_KEYS):
        self.spark, self.table, self.key = spark, table, KEYS[table]
        self.folder, self.order_by, self.range_keys = folder.rstrip("/"), list(order_by), range_keys
        self.schema: T.StructType | None = None

    @property
    def path(self) -> str:
        return f"{self.folder}/current"

    def _valid(self, bronze: DataFrame) -> DataFrame:
        extra = [c for c in self.order_by if c not in RAW_SCHEMAS[self.table].names]
        return valid_rows(self.table, bronze, extra)

    def _stored(self, path: str, *more: T.StructField) -> DataFrame:
        schema = T.StructType([*self.schema.fields, *more, T.StructField(RANGE, T.LongType())])
        return self.spark.read.schema(schema).parquet(path)

    def rows(self) -> DataFrame:
        """Current rows with the columns that order them."""
        if not folder_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self._stored(self.path).drop(RANGE)

    def silver(self, as_of=None) -> DataFrame:
        """The silver table: columns that depend on the moment are computed when it is read."""
        return enrich_rows(self.table, self.rows().select(*RAW_SCHEMAS[self.table].names), as_of)

    def changes(self, batch: int) -> DataFrame:
        """The rows that a batch replaced and those that it brought: ``is_new`` tells them apart."""
        return self._stored(f"{self.folder}/changes/{batch}", T.StructField("is_new", T.BooleanType())).drop(RANGE)

    def merge(self, bronze: DataFrame, batch: int) -> None:
        """Merge the rows of a batch.  Repeating a batch changes nothing."""
        new = self._valid(bronze)
        self.schema = new.schema
        staged, feed = f"{self.folder}/staged/{batch}", f"{self.folder}/changes/{batch}"
        if not folder_exists(self.spark, f"{staged}/_SUCCESS"):
            self._stage(new, batch, staged)
        merged = self._stored(staged, *MARKS)
        if not folder_exists(self.spark, f"{feed}/_SUCCESS"):
            merged.where("is_new or not is_current").drop("is_current").write.mode("overwrite").parquet(feed)
        (
            merged.where("is_current").drop("is_new", "is_current")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RANGE).parquet(self.path)
        )
        if batch:
            remove_folder(self.spark, f"{self.folder}/staged/{batch - 1}")

    def _ranged(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(RANGE, F.coalesce(F.floor(F.col(self.key) / self.range_keys), F.lit(-1)).cast("bigint"))

    def _order(self, rows: DataFrame) -> list[Column]:
        """The newest version first, chosen as a full build does; of a repeated version the one that was there before."""
        return [*[F.desc(c) for c in version_order(rows, self.order_by)], F.desc("_hash"), F.asc("is_new")]

    def _hashed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_hash", F.xxhash64(*[f.name for f in self.schema]))

    def _stage(self, new: DataFrame, batch: int, staged: str) -> None:
        """Write the touched ranges as they will be, and beside them the rows that go.

        New versions are reduced to one a key first, before they travel.  What is held has one a key as well, so that a range has
        at most two rows a key: rows then travel once, by range, are compared there and written where they belong."""
        arrived = f"{self.folder}/arrived/{batch}"
        first = Window.partitionBy(self.key).orderBy(*self._order(new))
        fresh = self._hashed(new.withColumn("is_new", F.lit(True))).withColumn("_place", F.row_number().over(first))
        self._ranged(fresh.where("_place = 1").drop("_hash", "_place")).write.mode("overwrite").parquet(arrived)
        rows = self._stored(arrived, MARKS[0])
        if folder_exists(self.spark, self.path):
            held = self._stored(self.path).where(F.col(RANGE).isin(_values(rows, RANGE)))
            rows = rows.unionByName(held.withColumn("is_new", F.lit(False)))
        rows = self._hashed(rows.repartition(RANGE))
        versions = Window.partitionBy(RANGE, self.key).orderBy(*self._order(rows))
        placed = rows.withColumn("is_current", F.row_number().over(versions) == 1)
        placed.where("is_current or not is_new").drop("_hash").write.mode("overwrite").partitionBy(RANGE).parquet(staged)
        remove_folder(self.spark, arrived)

    def follow(
        self, bronze: str, schema: T.StructType, checkpoint: str, after: Callable[[int], None] | None = None, max_files: int = 1000
    ) -> None:
        """Merge the files that arrived in the bronze folder since the last call; ``after`` is told each batch that is merged.

        A file stream with a checkpoint, run as bounded batches.  A batch that is lost half way comes again under its number."""

        def merged(rows: DataFrame, batch: int) -> None:
            self.merge(rows, batch)
            if after:
                after(batch)

        stream = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(bronze)
        writer = stream.writeStream.foreachBatch(merged).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()


def _values(rows: DataFrame, column: str) -> list:
    """The distinct values of a partition column: as many as there are partitions touched, never rows."""
    return [r[0] for r in rows.select(column).distinct().collect()]


def refresh_partitions(
    affected: DataFrame, by: Sequence[str], build: Callable[[Column], DataFrame], path: str
) -> None:
    """Recompute those partitions of the table at ``path`` whose values stand in ``affected``, and replace them.

    ``build`` makes the rows of the table where a condition on ``by`` holds.  A partition that no row is left of goes.  ``affected`` is
    reduced to its distinct values first: there are as many as partitions (months, say)."""
    spark = affected.sparkSession
    cells = [tuple(r) for r in affected.select(*by).distinct().collect()]
    if not cells:
        return
    wanted = F.lit(False)
    for cell in cells:
        same = F.lit(True)
        for name, value in zip(by, cell):
            same = same & F.col(name).eqNullSafe(F.lit(value))
        wanted = wanted | same
    staged = f"{path.rstrip('/')}__staged-{uuid.uuid4().hex}"
    fresh = store(build(wanted), staged)
    fresh.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    written = {tuple(r) for r in fresh.select(*by).distinct().collect()}
    for cell in set(cells) - written:
        name = "/".join(f"{b}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for b, v in zip(by, cell))
        remove_folder(spark, f"{path}/{name}")
    remove_folder(spark, staged)
