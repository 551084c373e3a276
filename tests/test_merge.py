"""Incremental silver and gold equal a full build, whatever the order of arrival and wherever a run is lost."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strataflow.plans import silver
from strataflow.schemas import KEYS, RAW_SCHEMAS, TABLES
from strataflow.sources.fixtures import PAYMENT_ORDER
from strataflow.streaming import CurrentRows, refresh_partitions

AS_OF = datetime(2001, 8, 7)
SCHEMA = (
    "payment_id long, application_id long, amount decimal(10,2), currency string, payment_method string, payment_gateway string, "
    "status string, payment_time timestamp_ntz, bronze_ingestion_timestamp timestamp"
)


def versions(seed, n=400):
    pick = random.Random(seed)
    start = datetime(2024, 1, 1)
    out = []
    for k in range(n):
        key = pick.choice([None, *range(-30, 120)])
        paid = pick.choice([None, start + timedelta(days=pick.randrange(400))])
        out.append((
            key, pick.randrange(50), Decimal(pick.choice([-5, 0, 20, 150, 400])), "USD", pick.choice(["Card", "Cash"]), "gw", pick.choice(["Completed", "Failed"]),
            paid, start + timedelta(days=pick.randrange(30)),
        ))
    return out


def current(spark, folder):
    return CurrentRows(spark, "payments", str(folder), ["payment_time"], range_keys=25)


def full(spark, data):
    return silver.clean_payments(spark.createDataFrame(data, SCHEMA))


@pytest.mark.parametrize("seed", range(3))
def test_loads_in_any_order_equal_one_build(spark, tmp_path, seed):
    data = versions(seed)
    state = current(spark, tmp_path)
    cuts = [data[:150], data[100:300], data[:10], data[300:], []]  # repeats, late versions, an empty load
    for batch, load in enumerate(cuts):
        state.merge(spark.createDataFrame(load, SCHEMA), batch)
    assert rows(state.silver()) == rows(full(spark, data))


def test_only_touched_ranges_are_rewritten(spark, tmp_path):
    data = [(k, 1, Decimal(20), "USD", "Card", "gw", "Completed", datetime(2024, 1, 1), datetime(2024, 1, 1)) for k in range(100)]
    state = current(spark, tmp_path)
    state.merge(spark.createDataFrame(data, SCHEMA), 0)
    files = lambda: {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in (tmp_path / "current").iterdir() if p.is_dir()}
    before = files()
    late = [(30, 2, Decimal(50), "EUR", "Card", "gw", "Failed", datetime(2024, 2, 1), datetime(2024, 2, 1))]
    state.merge(spark.createDataFrame(late + data[30:31], SCHEMA), 1)
    changed = {name for name, held in files().items() if held != before[name]}
    assert changed == {"_range=1"}
    feed = state.changes(1).select("payment_id", "currency", "is_new")
    assert rows(feed) == [(30, "EUR", True), (30, "USD", False)]


@pytest.mark.parametrize("lost", ["arrived", "staged", "changes", "current"])
def test_a_lost_merge_can_be_repeated(spark, tmp_path, lost, monkeypatch):
    """The run ends after the write of ``lost``, or in the middle of replacing ranges; then the batch comes again."""
    from pyspark.sql.readwriter import DataFrameWriter

    first, second = versions(7, 200), versions(8, 200)
    state = current(spark, tmp_path)
    state.merge(spark.createDataFrame(first, SCHEMA), 0)
    plain = DataFrameWriter.parquet

    def breaking(self, path, *args, **kwargs):
        plain(self, path, *args, **kwargs)
        if f"/{lost}" in path:
            if lost == "current":  # half of the ranges are gone
                import shutil

                for k, folder in enumerate(sorted((tmp_path / "current").glob("_range=*"))):
                    if k % 2:
                        shutil.rmtree(folder)
            raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(DataFrameWriter, "parquet", breaking)
        with pytest.raises(RuntimeError):
            state.merge(spark.createDataFrame(second, SCHEMA), 1)
    again = current(spark, tmp_path)
    again.merge(spark.createDataFrame(second, SCHEMA), 1)
    assert rows(again.silver()) == rows(full(spark, first + second))
    assert again.changes(1).where("is_new").count() > 0


def test_a_stream_of_files_is_followed(spark, tmp_path):
    data = versions(5)
    state, bronze = current(spark, tmp_path / "state"), str(tmp_path / "bronze")
    seen = []
    for part in (data[:200], data[200:]):
        df = spark.createDataFrame(part, SCHEMA)
        df.write.mode("append").parquet(bronze)
        state.follow(bronze, df.schema, str(tmp_path / "checkpoint"), seen.append)
    state.follow(bronze, df.schema, str(tmp_path / "checkpoint"), seen.append)  # nothing new
    assert len(seen) == 2 and rows(state.silver()) == rows(full(spark, data))


def test_partitions_are_refreshed_and_emptied(spark, tmp_path):
    path = str(tmp_path / "sums")
    make = lambda data: spark.createDataFrame(data, "y int, m string, v int")
    build = lambda df: lambda wanted: df.groupBy("y", "m").agg(F.sum("v").alias("v")).where(wanted)
    one = make([(1, "a", 1), (1, "b", 2), (None, "a", 3)])
    refresh_partitions(one, ["y", "m"], build(one), path)
    two = make([(1, "a", 10), (2, "c", 5)])  # 1/b and null/a have lost their rows; only 1/b is told
    refresh_partitions(make([(1, "a", 0), (1, "b", 0), (2, "c", 0)]), ["y", "m"], build(two), path)
    held = spark.read.schema("y int, m string, v long").parquet(path).select("y", "m", "v")
    assert rows(held) == [(None, "a", 3), (1, "a", 10), (2, "c", 5)]
    refresh_partitions(make([]), ["y", "m"], build(two), path)
    assert held.count() == 3


@pytest.mark.parametrize("table", TABLES)
def test_every_table_can_be_merged(spark, small_lake, tmp_path, table):
    """Two loads with corrections and repeats equal one build, for all eleven tables."""
    key = F.col(KEYS[table])
    raw = small_lake.raw(table).select(*RAW_SCHEMAS[table].names, *(PAYMENT_ORDER if table == "payments" else ()))
    at = lambda df, day: df.withColumn(silver.ARRIVAL, F.lit(f"2001-01-{day:02d} 00:00:00").cast("timestamp"))
    text = next(f.name for f in RAW_SCHEMAS[table] if f.dataType.simpleString() == "string" and f.name not in ("email", "status"))
    first = at(raw.where(key % 4 != 1), 5)
    second = at(raw.where(key % 4 != 2), 3).unionByName(at(raw.where(key % 3 == 0).withColumn(text, F.lit("corrected")), 9))
    order = list(PAYMENT_ORDER) if table == "payments" else silver.VERSION_ORDER.get(table, [])
    state = CurrentRows(spark, table, str(tmp_path), order, range_keys=500)
    for batch, load in enumerate((first, second)):
        state.merge(load, batch)
    whole = silver.clean_table(table, first.unionByName(second), AS_OF, PAYMENT_ORDER)
    got = state.silver(AS_OF)
    assert got.count() > 0 and rows(got) == rows(whole.select(*got.columns))


def test_rows_travel_once_to_their_range(spark, tmp_path, monkeypatch):
    """What is held is shuffled once a batch, by range; the feed and the replacement of ranges shuffle nothing."""
    from pyspark.sql.readwriter import DataFrameWriter

    state, plain, plans = current(spark, tmp_path), DataFrameWriter.parquet, {}

    def noted(self, path, *args, **kwargs):
        plans[path.removeprefix(str(tmp_path)).split("/")[1]] = self._df._jdf.queryExecution().executedPlan().toString()
        plain(self, path, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(DataFrameWriter, "parquet", noted)
        for batch in range(2):
            state.merge(spark.createDataFrame(versions(batch), SCHEMA), batch)
    assert {k: plan.count("Exchange ") for k, plan in plans.items()} == {"arrived": 1, "staged": 1, "changes": 0, "current": 0}
    assert rows(state.silver()) == rows(full(spark, versions(0) + versions(1)))
    feed = state.changes(1)
    before = rows(full(spark, versions(0)).select("payment_id", "amount", "payment_time"))
    after = rows(state.silver().select("payment_id", "amount", "payment_time"))
    gone, came = (rows(feed.where(c).select("payment_id", "amount", "payment_time")) for c in ("not is_new", "is_new"))
    assert gone and len(set(gone)) == len(gone) and set(gone) <= set(before) and set(came) <= set(after)
    assert {r[0] for r in gone} == {r[0] for r in came} & {r[0] for r in before}
