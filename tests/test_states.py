"""Mergeable states, quarantine, one-pass totals and plans that scan, sort and shuffle no more than they need."""

import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strataflow import sources as src
from strataflow.functions.moments import moment, time_of
from strataflow.operators import (
    distinct_from_state,
    distinct_state,
    group_with_share,
    histogram_state,
    last_event,
    quantile_from_state,
    quarantine,
    top_k_with_other,
)
from strataflow.plans import gold, kpis, quality, silver
from strataflow.schemas import TABLES


def plan(df):
    """The plan before it is run, with whole paths."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    fresh = df.select("*")
    try:
        return fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def scans(df, table=""):
    return len(re.findall(rf"FileScan parquet[^\n]*{table}", plan(df)))


def test_distinct_counts_merge_exactly(spark):
    pick = random.Random(1)
    ids = [0, 1, -1, 32_768, 32_769, -32_768, 2**40, -(2**40), 2**63 - 1, -(2**63), None, *[pick.randrange(90_000) for _ in range(3_000)]]
    data = [(pick.choice("xyz"), pick.choice([1, 2, None]), i) for i in ids for _ in range(2)]
    df = spark.createDataFrame(data, "a string, b int, id long")
    state = distinct_state(df, ["a", "b"], "id").cache()
    for by in (["a", "b"], ["a"], ["b"], []):
        direct = df.groupBy(*by).agg(F.count_distinct("id").alias("n"))
        assert rows(distinct_from_state(state, by, "n").select(*by, "n")) == rows(direct.select(*by, "n"))


def test_quantiles_merge_exactly(spark):
    pick = random.Random(2)
    data = [(pick.choice("xyz"), pick.choice([1, None]), pick.choice([None, *range(-5, 20)])) for _ in range(2_000)] + [("lonely", 1, 7)]
    df = spark.createDataFrame(data, "a string, b int, v int")
    state = histogram_state(df, ["a", "b"], "v").cache()
    for by in (["a"], ["a", "b"], []):
        for q in (0.25, 0.5, 0.99):
            known = df.where("v is not null")
            direct = known.groupBy(*by).agg(F.count("*").alias("rows"), F.expr(f"percentile_disc({q}) within group (order by v)").cast("int").alias("m"))
            assert rows(quantile_from_state(state, by, q, "m")) == rows(direct)


def test_moments_order_like_time_and_id(spark):
    times = [None, datetime(1, 1, 1), datetime(1969, 12, 31, 23, 59, 59, 999_999), datetime(1970, 1, 1), datetime(2024, 2, 29, 1, 2, 3, 4), datetime(9999, 12, 31, 23, 59, 59, 999_999)]
    data = [(t, i) for t in times for i in (None, -(2**63), -1, 0, 5, 2**63 - 1)]
    df = spark.createDataFrame(data, "t timestamp_ntz, id long").withColumn("m", moment("t", "id"))
    assert dict(df.dtypes)["m"] == "decimal(38,0)"
    by_struct = [tuple(r) for r in df.orderBy(F.struct("t", "id")).select("t", "id").collect()]
    assert [tuple(r) for r in df.orderBy("m").select("t", "id").collect()] == by_struct
    assert df.where(~time_of(F.col("m"), df.schema["t"].dataType).eqNullSafe(F.col("t"))).count() == 0


def test_shares_need_one_scan_and_match_two(spark, tmp_path):
    pick = random.Random(3)
    data = [(pick.choice(["a", "b", None]), pick.randrange(4), pick.choice([1, 2, 3, None])) for _ in range(500)]
    spark.createDataFrame(data, "g string, h int, v int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    measures = {"n": F.count(F.lit(1)), "v": F.sum("v"), "kinds": F.count_distinct("v")}
    for dims in (["g"], ["g", "h"], [F.upper("g").alias("u")]):
        got = group_with_share(df, dims, measures, "n", "share")
        want = df.groupBy(*dims).agg(*[m.alias(k) for k, m in measures.items()]).withColumn("share", F.round(F.col("n") * 100.0 / 500, 2))
        assert rows(got) == rows(want.select(*got.columns))
        assert scans(got) == 1
    assert group_with_share(df.limit(0), ["g"], measures, "n", "share").collect() == []


def test_top_k_and_the_rest(spark, tmp_path):
    data = [("a", 5), ("b", 9), ("c", 5), ("d", 1), (None, 2), ("e", None)]
    spark.createDataFrame(data, "d string, m int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    top = top_k_with_other(df, "d", "m", 2, share="pct")
    assert [tuple(r) for r in top.collect()] == [("b", 9, 40.91), ("a", 5, 22.73), ("Other", 8, 36.36)]
    assert scans(top) == 1
    assert [r["d"] for r in top_k_with_other(df, "d", "m", 6).collect()] == ["b", "a", "c", None, "d", "e"]  # no rest, no row
    assert top_k_with_other(df.limit(0), "d", "m", 2).collect() == []


def test_quarantine_splits_and_counts_in_one_pass(spark, tmp_path):
    df = spark.createDataFrame([(1, 5, "x"), (2, -1, "y"), (3, None, None), (4, -2, None), (4, -2, None)], "id int, v int, s string")
    rules = {"positive": F.col("v") > 0, "named": F.col("s").isNotNull()}
    split = quarantine(df, rules, str(tmp_path / "q"))
    assert rows(split.good) == [(1, 5, "x")]
    assert rows(split.rejected) == [(2, -1, "y", ["positive"]), (3, None, None, ["named"]), (4, -2, None, ["positive", "named"]), (4, -2, None, ["positive", "named"])]
    assert dict(split.counts) == {"rows read": 5, "good rows": 1, "rejected rows": 4, "positive": 3, "named": 3}
    assert split.good.unionByName(split.rejected.drop("broken_rules")).exceptAll(df).count() == 0
    empty = quarantine(df.limit(0), rules, str(tmp_path / "none"))
    assert empty.good.count() == empty.rejected.count() == 0 and set(empty.counts.values()) == {0}


@pytest.fixture(scope="module")
def stored(small_lake):
    small_lake.all_silver()
    small_lake.all_gold()
    return small_lake


def test_totals_scan_their_fact_once(stored):
    g, s = stored.gold, stored.silver
    unpaid = g("unpaid_applications")
    once = [
        gold.stage_dropoff(g("application_funnel")), gold.gap_by_country(g("payment_reconciliation")),
        gold.payment_gap_by_status(s("applications"), s("payments"), unpaid),
        kpis.revenue_breakdown(g("revenue_metrics"), ["payment_method"]), kpis.revenue_top(g("revenue_metrics"), "country_name"),
        kpis.pending_ageing(g("abandoned_applications")),
    ]
    assert [scans(df) for df in once] == [1] * len(once)
    by_visa = gold.payment_gap_by_visa_type(s("applications"), s("payments"), s("countries"), s("visa_types"), unpaid)
    assert scans(by_visa, "gold_unpaid_applications") == 1
    recon = gold.payment_reconciliation(
        s("applications"), s("payments"), s("countries"), s("visa_types"), None, unpaid, g("gap_counts"))
    assert scans(recon, "gold_unpaid_applications") == 1


def test_orphans_scan_each_table_once_for_each_side(stored):
    """Read as a child once for all its keys, as a parent once for all its children."""
    report = quality.fk_report(stored.all_silver())
    assert {t: scans(report, f"silver_{t}\\b") for t in ("applications", "users", "reviews", "payments", "support_tickets")} == {
        "applications": 1, "users": 1, "reviews": 1, "payments": 1, "support_tickets": 1}


def test_first_and_last_are_hash_aggregates(stored):
    s = stored.silver
    plans = [
        last_event(s("application_events"), "application_id", "event_time", "event_id", ["event_type"]),
        gold.abandoned_applications(s("applications"), s("application_events"), s("countries"), s("visa_types")),
        silver.flag_payment_retry(s("payments")),
    ]
    assert not any("SortAggregate" in plan(df) for df in plans)


def test_slices_open_only_their_partitions(stored):
    revenue = stored.gold("revenue_metrics").where("payment_year = 1997 and country_name = 'NATION_3'")
    weeks = stored.gold("operational_metrics").where("application_year >= 1997")
    assert "PartitionFilters: [isnotnull(payment_year" in plan(revenue)
    assert "PartitionFilters: [isnotnull(application_year" in plan(weeks)


def test_the_manifest_is_read_from_the_run_table(stored):
    counted = stored.manifest("silver", TABLES)
    assert scans(counted) == scans(counted, "_runs") == 1
    assert dict(rows(counted)) == {f"silver_{t}": df.count() for t, df in stored.all_silver().items()}


def test_funnel_joins_bucketed_applications_where_they_lie(spark, stored):
    spark.sql("CREATE DATABASE IF NOT EXISTS funnel_test")
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        src.build_silver("applications", stored.silver("applications"), schema="funnel_test", bucket_by=(4, "application_id"))
        apps = spark.table("funnel_test.silver_applications")
        funnel = gold.application_funnel(apps, stored.silver("application_events"), stored.silver("payments"))
        lines = plan(funnel).splitlines()
        scan = next(k for k, line in enumerate(lines) if "silver_applications" in line and "FileScan" in line)
        depth = lines[scan].index("FileScan")
        above = [line for line in lines[:scan] if 0 <= len(line) - len(line.lstrip(" :+-*()0123456789")) < depth]
        join = max(k for k, line in enumerate(lines[:scan]) if "SortMergeJoin" in line and "LeftOuter" in line and lines.index(line) < scan)
        assert "Bucketed: true" in lines[scan]
        assert not any("Exchange" in line for line in lines[join:scan]) and above
        assert funnel.drop("silver_processed_timestamp").count() == stored.gold("application_funnel").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
        spark.sql("DROP DATABASE funnel_test CASCADE")


def test_quality_history_is_append_only(spark, tmp_path, stored):
    s, path = stored.silver, str(tmp_path / "history")
    first = quality.dq_log(s("users"), s("applications").limit(0), s("payments"), datetime(2024, 1, 1))
    second = quality.dq_log(s("users"), s("applications"), s("payments"), datetime(2024, 1, 2))
    quality.record_run(first, path)
    quality.record_run(second, path)
    again = quality.record_run(second, path)  # the same run once more
    assert again.count() == 10
    changes = quality.dq_changes(again).where("previous_issue_count is not null").collect()
    assert {str(r.checked_at) for r in changes} == {"2024-01-02 00:00:00"} and len(changes) == 5
    orphans = next(r for r in changes if r.check_name == "Orphaned Payment Records")
    assert orphans.new_issues < 0 and not orphans.is_worse


def test_stored_results_are_written_with_a_tight_codec(spark, tmp_path):
    from strataflow.session import store

    stored = store(spark.range(1000).withColumn("k", F.col("id") % 3), str(tmp_path / "t"), ["k"])
    assert stored.count() == 1000
    files = list((tmp_path / "t").rglob("*.parquet"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)
