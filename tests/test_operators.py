from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strataflow.operators import (
    MetricView,
    cast_columns,
    change_from_previous,
    dedup_any,
    dedup_latest,
    dedup_report,
    fill_defaults,
    first_times,
    join_dim,
    join_first,
    last_event,
    pct_of_total,
    pct_within,
    preview,
    reject_counts,
    row_filter,
    slice_rows,
    standardise_labels,
    star_join,
    top_k,
    top_k_with_other,
    with_match,
    without_match,
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "d", 9), (None, "e", 1)], "k int, s string, v int")


def test_dedup_latest(pairs):
    assert rows(dedup_latest(pairs, "k", ["v"])) == rows(pairs.where("s in ('b', 'd', 'e')"))
    assert rows(dedup_latest(pairs, "k", [F.asc("v")])) == rows(pairs.where("s in ('a', 'd', 'e')"))


def test_dedup_latest_limits_before_the_shuffle(pairs):
    assert plan(dedup_latest(pairs, "k", ["v"])).count("WindowGroupLimit") == 2


def test_dedup_latest_is_repeatable_on_ties(spark):
    ties = spark.createDataFrame([(1, f"s{i}") for i in range(50)], "k int, s string")
    once = dedup_latest(ties.repartition(7), "k").first()
    assert once == dedup_latest(ties.repartition(3, "s"), "k").first()


def test_dedup_any_and_report(pairs):
    assert dedup_any(pairs, "k").count() == 3
    assert tuple(dedup_report(pairs, "k", "t").first()) == ("t", 5, 3, 2)
    assert tuple(dedup_report(pairs.limit(0), "k", "t").first()) == ("t", 0, 0, 0)


def test_anti_and_semi_split_the_left_side(pairs, spark):
    right = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    out, kept = without_match(pairs, right, "k"), with_match(pairs, right, "k")
    assert out.count() + kept.count() == pairs.count()
    assert rows(out.select("s")) == [("d",), ("e",)]


def test_lookups_carry_no_broadcast_hint(spark, pairs):
    dim = spark.range(10).select(F.col("id").cast("int").alias("k"), F.lit("n").alias("name"))
    for df in (join_dim(pairs, dim, "k"), row_filter(pairs, "k", dim)):
        assert "hint" not in df._jdf.queryExecution().logical().toString().lower()


def test_join_dim_and_star(spark, pairs):
    dim = spark.createDataFrame([(1, "one", "x")], "k int, name string, other string")
    joined = join_dim(pairs, dim, "k", ["name"])
    assert joined.columns == ["k", "s", "v", "name"] and joined.count() == 3
    assert join_dim(pairs, dim, "k", ["name"], "left").count() == 5
    second = spark.createDataFrame([(3, "three")], "v int, label string")
    assert rows(star_join(pairs, [(dim, "k", ["name"]), (second, "v", ["label"])])) == [(3, 1, "b", "one", "three")]


def test_join_first_never_multiplies(spark, pairs):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert rows(join_first(left, pairs, "k", ["v"])) == [(1, "b", 3), (2, "d", 9), (3, None, None)]


def test_events(spark):
    t = lambda h: datetime(2024, 1, 1, h)
    events = spark.createDataFrame(
        [(1, 1, "A", t(5)), (2, 1, "A", t(3)), (3, 1, "B", t(5)), (4, 2, "B", t(1))],
        "event_id long, k int, kind string, at timestamp_ntz",
    )
    assert rows(first_times(events, "k", "kind", "at", {"A": "a_at", "B": "b_at"})) == [
        (1, t(3), t(5)), (2, None, t(1)),
    ]
    assert rows(last_event(events, "k", "at", "event_id", ["kind"])) == [(1, t(5), "B"), (2, t(1), "B")]


def test_shares(spark):
    grouped = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("b", "x", 4)], "g string, d string, n int")
    assert [r["p"] for r in pct_of_total(grouped, "n", "p").orderBy("g", "d").collect()] == [12.5, 37.5, 50.0]
    within = pct_within(grouped, "n", "g", "t", "p").orderBy("g", "d").collect()
    assert [(r["t"], r["p"]) for r in within] == [(4, 25.0), (4, 75.0), (4, 100.0)]
    assert "SinglePartition" not in plan(pct_within(grouped, "n", "g", "t", "p"))


def test_top_k_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("c", 5), ("a", 5), ("b", 9), ("d", 1)], "d string, m int")
    assert [r["d"] for r in top_k(df, "m", 2, "d").collect()] == ["b", "a"]
    assert rows(top_k_with_other(df, "d", "m", 2)) == [("Other", 6), ("a", 5), ("b", 9)]


def test_change_from_previous(spark):
    log = spark.createDataFrame(
        [("t", date(2024, 1, 1), 100), ("t", date(2024, 1, 2), 120), ("t", date(2024, 1, 3), 150)],
        "table_name string, day date, n int",
    )
    got = change_from_previous(log, "table_name", "day", "n").orderBy("day").collect()
    assert [(r["change_pct"], r["is_alert"]) for r in got] == [(None, False), (20.0, False), (25.0, True)]


def test_preview_slice_filter(spark, pairs):
    assert [tuple(r) for r in preview(pairs.dropna(), ["v", "s"], 2).collect()] == [(1, "a"), (2, "c")]
    assert [r[0] for r in slice_rows(pairs, F.col("k").isin(1, 2), ["s"], [F.desc("v")], 2).collect()] == ["d", "b"]
    allowed = spark.createDataFrame([(2,), (2,)], "k int")
    assert rows(row_filter(pairs, "k", allowed)) == [(2, "d", 9)]
    assert row_filter(pairs, "k", None) is pairs


def test_defaults_and_labels(spark):
    df = spark.createDataFrame([(" pay pal", None), ("cash", 1)], "m string, n int")
    assert rows(fill_defaults(df, {"n": 0})) == [(" pay pal", 0), ("cash", 1)]
    assert rows(standardise_labels(df, "m", {"Pay Pal ": "PayPal"}).select("m")) == [("PayPal",), ("cash",)]


def test_cast_columns(spark):
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", "n/a"), (None, None)], "a string, b string")
    out = cast_columns(df, {"a": "int", "b": "date"})
    assert [tuple(r) for r in out.collect()] == [
        (1, date(2024, 1, 1), []), (None, None, ["a", "b"]), (None, None, []),
    ]
    assert rows(reject_counts(out, ["a", "b"])) == [(3, "a", 1), (3, "b", 1)]


def test_metric_view_reaggregates(spark):
    cube = spark.createDataFrame([("a", 1, 10), ("a", 3, 10), ("b", 9, 10)], "d string, ok int, n int")
    view = MetricView(cube, {"d": F.col("d")}, {"rate": F.sum("ok") * 100 / F.sum("n"), "n": F.sum("n")})
    assert rows(view.query(["d"], ["rate"])) == [("a", 20.0), ("b", 90.0)]
    assert view.query(where="d = 'a'").first() == (20.0, 20)
    with pytest.raises(KeyError):
        view.query(["nope"])


