from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from strataflow.functions import (
    bucketize,
    days_elapsed,
    email_ok,
    exact_avg,
    flag,
    hours_elapsed,
    hours_fraction,
    month_start,
    only_if,
    pct,
    stable_round,
    sum_where,
    threshold_status,
    week_start,
)


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def moment(text):
    return F.lit(text).cast("timestamp_ntz")


def test_bucketize_boundaries_and_nulls(spark):
    df = spark.createDataFrame([(0.75,), (0.5,), (0.49,), (None,)], "v double")
    bands = [(0.75, "High"), (0.5, "Medium")]
    got = df.select(
        bucketize("v", ">=", bands, "Low").alias("a"), bucketize("v", ">=", bands, "Low", "Unknown").alias("b")
    ).collect()
    assert [r.a for r in got] == ["High", "Medium", "Low", "Low"]
    assert [r.b for r in got] == ["High", "Medium", "Low", "Unknown"]


def test_flag_and_only_if(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    assert [r[0] for r in df.select(flag(F.col("v") > 0)).collect()] == [True, False]
    assert [r[0] for r in df.select(only_if(F.col("v") > 0, "v")).collect()] == [1, None]


def test_calendar_and_elapsed_days_differ(spark):
    a, b = moment("2024-01-01 23:00:00"), moment("2024-01-02 01:00:00")
    assert value(spark, F.date_diff(b, a)) == 1
    assert value(spark, days_elapsed(a, b)) == 0


def test_elapsed_hours_truncate(spark):
    a, b = moment("2024-01-01 00:59:00"), moment("2024-01-01 01:01:00")
    assert value(spark, hours_elapsed(a, b)) == 0
    assert value(spark, hours_elapsed(b, a)) == 0
    assert abs(value(spark, hours_fraction(a, b)) - 2 / 60) < 1e-12


def test_week_and_month_start(spark):
    assert value(spark, week_start(F.lit(date(2024, 7, 14)))) == date(2024, 7, 8)
    assert value(spark, week_start(F.lit(datetime(2024, 7, 8, 5)))) == date(2024, 7, 8)
    assert value(spark, month_start(F.lit(2024), F.lit(2))) == date(2024, 2, 1)


def test_email(spark):
    mails = ["a@b.co", "a@bxco", "a@bxxco", " A@B.CO ", None]
    df = spark.createDataFrame([(m,) for m in mails], "m string")
    got = [r[0] for r in df.select(email_ok(F.lower(F.trim("m")))).collect()]
    assert got == [True, False, False, True, None]


def test_pct_guards_zero(spark):
    assert value(spark, pct(F.lit(1), F.lit(8))) == 12.5
    assert value(spark, pct(F.lit(1), F.lit(0))) is None
    assert value(spark, pct(F.lit(201), F.lit(20_000))) == 1.01


def test_exact_avg_rounds_half_up_in_decimal(spark):
    df = spark.createDataFrame([(Decimal("1.00"),), (Decimal("1.01"),), (None,)], "v decimal(10,2)")
    assert df.agg(exact_avg(F.sum("v"), F.count("v"))).first()[0] == 1.01
    assert df.limit(0).agg(exact_avg(F.sum("v"), F.count("v"))).first()[0] is None


def test_stable_round_ignores_noise(spark):
    assert value(spark, stable_round(F.lit(46.72499999999999))) == 46.73


def test_sum_where_is_zero_on_nothing(spark):
    df = spark.createDataFrame([(1, 5)], "k int, v int")
    assert df.agg(sum_where(F.col("k") == 2, "v")).first()[0] == 0


def test_threshold_status(spark):
    df = spark.createDataFrame([(61.0,), (60.0,), (None,)], "v double")
    got = [r[0] for r in df.select(threshold_status("v", ">", [(60, "red")], "ok")).collect()]
    assert got == ["red", "ok", "unknown"]
