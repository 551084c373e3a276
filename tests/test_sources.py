from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from strataflow import sources as src
from strataflow.schemas import RAW_SCHEMAS, TABLES
from strataflow.session import shared_folder
from strataflow.sources.fixtures import Fixtures
from strataflow.streaming import ingest_incremental, new_rows


@pytest.fixture(scope="module")
def raw(spark):
    """A raw namespace in the catalog."""
    src.ensure_schema(spark, "raw")
    fixtures = Fixtures(spark, SMALL)
    counts = {}
    for name in ("countries", "users", "visa_types"):
        df = fixtures.raw(name).select(*RAW_SCHEMAS[name].names)
        counts[name] = src.write_table(df, src.table_name("raw", name))
    return counts


def test_fixture_schemas(spark):
    fixtures = Fixtures(spark, SMALL)
    for name in TABLES:
        got = {f.name: f.dataType for f in fixtures.raw(name).schema}
        assert {f.name: got[f.name] for f in RAW_SCHEMAS[name]} == {f.name: f.dataType for f in RAW_SCHEMAS[name]}


def test_pipeline_through_the_catalog(spark, raw):
    result = src.ingest_all(spark, ["countries", "users", "missing"]).orderBy("table").collect()
    assert [(r["table"], r["success"], r["rows"]) for r in result] == [
        ("countries", True, 25), ("missing", False, 0), ("users", True, raw["users"])]
    assert "raw_missing" in result[1]["error"]
    bronze = spark.table("bronze.bronze_users")
    assert {"bronze_ingestion_timestamp", "bronze_source_table"} <= set(bronze.columns)
    assert bronze.select("bronze_source_table").distinct().first()[0] == "raw.raw_users"

    from strataflow.plans.silver import clean_users

    for layer in ("silver", "gold"):
        src.ensure_schema(spark, layer)
    n = src.build_silver("users", clean_users(src.read_table(spark, "bronze.bronze_users"), datetime(2024, 1, 1)))
    silver = spark.table("silver.silver_users")
    assert silver.count() == n
    assert silver.columns[-2:] == ["silver_processed_timestamp", "silver_source_table"]
    by_country = silver.groupBy("country").agg(F.count(F.lit(1)).alias("users"))
    src.build_gold("users_by_country", by_country)
    src.build_gold("users_by_country", by_country.withColumn("extra", F.lit(1)))  # replaced with a new schema
    assert spark.table("gold.gold_users_by_country").columns == ["country", "users", "extra", "gold_created_timestamp"]

    got = src.layer_manifest(spark, "silver").collect()
    assert [(r["table_name"], r["row_count"], r["schema_location"]) for r in got] == [("silver_users", n, "silver")]
    summary = dict(rows(src.layer_summary(src.layer_manifest(spark, "silver"), "silver")))
    assert summary["Total Tables"] == "1 tables" and summary["Total Rows"] == f"{n:,} rows"


def test_append_and_partitions(spark, raw):
    df = spark.range(5).withColumn("year", (F.col("id") % 2 + 2020).cast("int"))
    src.write_table(df, "raw.raw_numbers", partition_by=["year"])
    assert src.write_table(df, "raw.raw_numbers", mode="append", partition_by=["year"]) == 5
    again = spark.table("raw.raw_numbers").where("year = 2020")
    assert again.count() == 6
    assert "PartitionFilters: [isnotnull(year" in again._jdf.queryExecution().executedPlan().toString()


def test_namespaces_and_comments(spark, raw):
    src.tag_schema(spark, "raw", {"layer": "raw", "description": "it's raw"})
    props = spark.sql("DESCRIBE SCHEMA EXTENDED raw").collect()
    assert any("it's raw" in str(r) for r in props)
    assert "raw" in src.list_schemas(spark)
    assert "raw_users" in src.list_tables(spark, "raw")
    src.comment_table(spark, "raw.raw_countries", "Destinations", {"country_id": "the key"})
    described = [tuple(r) for r in src.describe(spark, "raw.raw_countries").collect()]
    assert ("country_id", "int", "the key") in described
    assert any(r[0] == "Comment" and r[1] == "Destinations" for r in described)
    assert src.bounded_read(spark, "raw.raw_users", 7).count() == 7


def test_read_with_schema_and_source_file(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    df = src.read_table(spark, "t", spark.range(1).schema, path)
    named = src.add_source_file(df)
    assert named.where(F.col("source_file").contains(".parquet")).count() == 3


def test_shared_folders_go_with_their_process(tmp_path):
    """Folders below a given checkpoint folder do not outlive the process that made them."""
    import subprocess
    import sys

    code = (
        "from strataflow.session import local_session, shared_folder, store, drop_shared\n"
        f"spark = local_session(1, extra={{'spark.checkpoint.dir': {str(tmp_path)!r}}})\n"
        "paths = [shared_folder(spark, 'x') for _ in range(2)]\n"
        "[store(spark.range(3), p) for p in paths]\n"
        "import os; assert all(map(os.path.isdir, paths))\n"
        "drop_shared(spark); assert not any(map(os.path.isdir, paths))\n"
        "store(spark.range(3), shared_folder(spark, 'y'))\n"
        "spark.stop()\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, cwd=Path(__file__).resolve().parent.parent)
    assert list((tmp_path / "strataflow").iterdir()) == []


def test_shared_folder_uses_the_session_setting(spark):
    folder = shared_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert folder != shared_folder(spark, "x")


def test_incremental_runs_equal_one_full_load(spark, tmp_path):
    landing, out, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    schema = "id long, at timestamp_ntz"
    first = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))], schema)
    second = spark.createDataFrame([(3, datetime(2024, 1, 3))], schema)
    first.write.mode("append").parquet(landing)
    load = lambda: ingest_incremental(spark, landing, out, marks, first.schema, "raw.raw_things")
    load()
    assert spark.read.parquet(out).count() == 2
    load()
    assert spark.read.parquet(out).count() == 2
    second.write.mode("append").parquet(landing)
    load()
    loaded = spark.read.parquet(out)
    assert rows(loaded.select("id", "at")) == rows(spark.read.parquet(landing))
    assert {"bronze_ingestion_timestamp", "bronze_source_table", "source_file"} <= set(loaded.columns)


def test_batch_high_water_mark(spark):
    source = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id int, at int")
    assert new_rows(source, None, ["id"]).count() == 3
    assert rows(new_rows(source, source.where("at <= 20"), ["id"]).select("id")) == [(3,)]
    assert new_rows(source, source.limit(0), ["id"]).count() == 3


def test_late_tied_and_timeless_rows_are_new(spark):
    from datetime import datetime as at

    day = at(2024, 5, 1)
    loaded = [(1, day), (2, at(2024, 5, 9))]
    late, tied, timeless = (3, at(2024, 5, 8)), (4, at(2024, 5, 9)), (5, None)
    make = lambda r: spark.createDataFrame(r, "id long, at timestamp")
    source, target = make([*loaded, late, tied, timeless, (None, day)]), make(loaded)
    assert rows(new_rows(source, target, ["id"]).select("id")) == [(None,), (3,), (4,), (5,)]
    assert rows(new_rows(source, target, ["id"], "at", "3 days").select("id")) == [(3,), (4,), (5,)]


def test_a_failing_overwrite_leaves_the_old_table(spark):
    from strataflow.sources.catalog import write_table

    spark.sql("CREATE DATABASE IF NOT EXISTS swap_test")
    try:
        assert write_table(spark.range(3), "swap_test.t") == 3
        with pytest.raises(Exception):
            write_table(spark.range(2).selectExpr("raise_error('no')"), "swap_test.t")
        assert spark.table("swap_test.t").count() == 3
        assert write_table(spark.table("swap_test.t").where("id > 0"), "swap_test.t") == 2
        assert rows(spark.table("swap_test.t")) == [(1,), (2,)]
    finally:
        spark.sql("DROP DATABASE swap_test CASCADE")


def test_a_reader_always_finds_the_table(spark):
    """A reader in a loop sees whole versions only, while writers replace the table and its schema."""
    import threading

    spark.sql("CREATE DATABASE IF NOT EXISTS loop_test")
    try:
        src.write_table(spark.range(100), "loop_test.t")
        seen, wrong, over = set(), [], threading.Event()

        def read():
            while not over.is_set():
                try:
                    seen.add(spark.table("loop_test.t").count())
                except Exception as error:
                    wrong.append(str(error)[:200])

        reader = threading.Thread(target=read)
        reader.start()
        for n in range(1, 7):
            rows_of = spark.range(100 * n).withColumn(f"c{n}", F.lit(n))
            assert src.write_table(rows_of, "loop_test.t") == 100 * n
        over.set()
        reader.join()
        assert not wrong and seen <= {100 * n for n in range(1, 7)} and len(seen) > 1
        assert spark.table("loop_test.t").columns == ["id", "c6"]
        kept = [t.name for t in spark.catalog.listTables("loop_test")]
        assert len(kept) == 3 and src.list_tables(spark, "loop_test") == ["t"]  # the view, its version, the one before
    finally:
        spark.sql("DROP DATABASE loop_test CASCADE")


def test_versions_keep_comments_counts_and_files(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS version_test")
    place = tmp_path / "numbers"
    try:
        for n in (3, 4, 5):
            src.write_table(spark.range(n), "version_test.numbers", path=str(place))
            if n == 3:
                src.comment_table(spark, "version_test.numbers", "some numbers", {"id": "the number"})
        src.write_table(spark.range(2), "version_test.numbers", mode="append")
        described = [tuple(r) for r in src.describe(spark, "version_test.numbers").collect()]
        assert ("id", "bigint", "the number") in described
        assert any(r[0] == "Comment" and r[1] == "some numbers" for r in described)
        assert spark.table("version_test.numbers").count() == 7
        assert len(list(place.iterdir())) == 2  # the current version and the one before
        for file in place.rglob("*.parquet"):
            file.write_bytes(b"not to be read")
        counted = src.layer_manifest(spark, "version_test").collect()
        assert [(r.table_name, r.row_count) for r in counted] == [("numbers", 7)]
    finally:
        spark.sql("DROP DATABASE version_test CASCADE")


def test_tables_of_another_origin_give_way(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS origin_test")
    try:
        spark.range(3).write.saveAsTable("origin_test.t")
        assert src.write_table(spark.range(1), "origin_test.t", mode="append") == 1
        assert src.layer_manifest(spark, "origin_test").first().row_count == 4
        assert src.write_table(spark.table("origin_test.t").limit(2).cache(), "origin_test.t") == 2
        assert src.layer_manifest(spark, "origin_test").first().row_count == 2
    finally:
        spark.sql("DROP DATABASE origin_test CASCADE")


def test_bucketed_tables_meet_without_a_shuffle(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucket_test")
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("a", "b"):
            src.write_table(spark.range(1000).withColumn(name, F.col("id") * 2), f"bucket_test.{name}", bucket_by=(4, "id"))
        joined = spark.table("bucket_test.a").join(spark.table("bucket_test.b"), "id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and joined.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
        spark.sql("DROP DATABASE bucket_test CASCADE")


def test_full_pipeline_equals_the_lakehouse(spark, small_lake):
    from strataflow.plans.lakehouse import GOLD_TABLES
    from strataflow.plans.pipeline import build_bronze_layer, build_gold_layer, build_silver_layer
    from verification.queries import AS_OF

    src.ensure_schema(spark, "raw")
    for name in TABLES:
        src.write_table(small_lake.raw(name), src.table_name("raw", name))
    order = small_lake.payment_order
    bronze = build_bronze_layer(spark)
    silver = build_silver_layer(spark, as_of=AS_OF, payment_order=order)
    gold = build_gold_layer(spark, as_of=AS_OF)
    assert [r["error"] for r in bronze.union(silver).union(gold).collect()] == [None] * (2 * len(TABLES) + len(GOLD_TABLES))
    assert {r["table"]: r["rows"] for r in silver.collect()} == {t: df.count() for t, df in small_lake.all_silver().items()}
    for name in GOLD_TABLES:
        stored = spark.table(f"gold.gold_{name}").drop("gold_created_timestamp")
        plan = small_lake.plan(name)
        assert stored.columns == plan.columns
        assert stored.exceptAll(plan).count() == 0 and plan.exceptAll(stored).count() == 0
    assert src.layer_manifest(spark, "gold").count() >= len(GOLD_TABLES)


def test_bronze_query_touches_no_table_of_the_user(spark):
    from tests.conftest import SMALL
    from verification.queries import registered

    src.ensure_schema(spark, "bronze")
    src.write_table(spark.range(3), "bronze.bronze_users")
    before = {s.name for s in spark.catalog.listDatabases()}
    rows = registered()["bronze_ingest"](spark, SMALL).collect()
    assert rows and all(r.success and r.rows > 0 for r in rows)
    assert spark.table("bronze.bronze_users").count() == 3
    assert {s.name for s in spark.catalog.listDatabases()} == before
