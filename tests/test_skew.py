"""The skew-safe join equals the plain join when one key dominates."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strataflow.operators import hot_keys, join_many, skew_join

FORCE = {"hot_rows": 20}


@pytest.fixture(scope="module")
def sides(spark):
    pick = random.Random(5)
    wide = []
    for i in range(1_500):
        share = pick.random()
        key = 7 if share < 0.35 else None if share < 0.55 else pick.randint(0, 400)
        wide.append((i, key, pick.randint(0, 9)))
    many = spark.createDataFrame(wide, "id long, k long, v int")
    one = spark.createDataFrame([(k, f"n{k}") for k in range(0, 300)] + [(None, "none")], "k long, name string")
    return many, one


def test_hot_keys_are_found(sides):
    many, _ = sides
    found = {r["k"]: r["_rows"] for r in hot_keys(many, ["k"], 100).collect()}
    counts = {r["k"]: r["count"] for r in many.groupBy("k").count().collect()}
    assert found == {k: n for k, n in counts.items() if k is not None and n > 100}
    assert set(found) == {7}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_left(sides, how):
    many, one = sides
    plain = many.join(one, "k", how)
    salted = skew_join(many, one, "k", how, "left", "id", **FORCE)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_right(sides, how):
    many, one = sides
    plain = one.join(many, "k", how)
    salted = skew_join(one, many, "k", how, "right", "id", **FORCE)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_hot_right_with_few_rows_and_many_parts(spark):
    """Parts of a hot key that happen to be empty must not create unmatched rows."""
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, name string")
    right = spark.createDataFrame([(i, 1) for i in range(30)] + [(99, 2)], "id long, k long")
    salted = skew_join(left, right, "k", "left", "right", "id", hot_rows=1)
    assert rows(salted) == rows(left.join(right, "k", "left"))


def test_two_column_key_and_both_sides_hot(spark):
    left = spark.createDataFrame([(i, 1 if i < 40 else i, 1) for i in range(80)], "lid long, a long, b long")
    right = spark.createDataFrame(
        [(i, 1 if i < 50 else i, 1 if i % 2 else None) for i in range(100)], "rid long, a long, b long"
    )
    salted = join_many(left, right, ["a", "b"], "rid", hot_rows=5)
    assert rows(salted) == rows(left.join(right, ["a", "b"], "left"))


def test_salted_work_is_spread(sides):
    """The rows of the hot key land in many join partitions."""
    many, one = sides
    spark_conf = many.sparkSession.conf
    before = spark_conf.get("spark.sql.adaptive.enabled")
    spark_conf.set("spark.sql.adaptive.enabled", "false")  # else small partitions are merged again
    salted = skew_join(many, one.hint("merge"), "k", "inner", "left", "id", **FORCE)
    by_key = {}
    for row in salted.select("k", F.spark_partition_id().alias("p")).distinct().collect():
        by_key.setdefault(row["k"], set()).add(row["p"])
    spark_conf.set("spark.sql.adaptive.enabled", before)
    assert len(by_key[7]) > 1


def test_keys_of_the_probe_that_the_hot_side_lacks_lose_nothing(sides):
    many, one = sides
    with pytest.raises(ValueError):
        skew_join(one, many, "k", "left", "right", "id", probe=many)
    few = many.where("k <> 7 or k is null")
    salted = skew_join(few, one, "k", "left", "left", "id", probe=many, **FORCE)
    assert rows(salted) == rows(few.join(one, "k", "left"))


def test_gold_tables_are_the_same_with_salting(medium_lake):
    from strataflow.plans import gold, kpis, silver
    from verification.queries import AS_OF

    s = medium_lake.silver
    force = {"hot_rows": 3}
    pairs = [
        lambda **k: gold.user_cohorts(s("users"), s("passports"), s("applications"), s("payments"), **k),
        lambda **k: gold.abandoned_carts(
            s("applications"), s("application_events"), s("payments"), s("countries"), s("visa_types"), AS_OF, **k
        ),
        lambda **k: gold.ticket_impact(s("support_tickets"), s("applications"), s("users"), s("reviews"), AS_OF, **k),
        lambda **k: silver.flag_payment_retry(s("payments"), **k),
        lambda **k: kpis.retry_due(s("payments"), AS_OF, **k),
    ]
    for build in pairs:
        plain, salted = build(), build(**force)
        assert plain.columns == salted.columns
        difference = plain.exceptAll(salted).count() + salted.exceptAll(plain).count()
        assert difference == 0
        assert plain.agg(F.count(F.lit(1))).first()[0] == salted.agg(F.count(F.lit(1))).first()[0]
