import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strataflow.operators import without_match
from strataflow.plans import gold, kpis, silver
from test_silver import table

AS_OF = datetime(2024, 6, 1)


def at(day, hour=0, month=1):
    return datetime(2024, month, day, hour)


@pytest.fixture(scope="module")
def world(spark):
    """A few applications with every payment and event situation."""
    app = lambda i, status, day=date(2024, 1, 1), **kw: {
        "application_id": i, "user_id": i % 3, "country_id": 1, "visa_type_id": 1, "application_date": day, "status": status, **kw}
    pay = lambda i, a, status, t: {
        "payment_id": i, "application_id": a, "amount": Decimal("100.00"), "status": status, "payment_time": t,
        "payment_method": "Card", "payment_gateway": "g"}
    ev = lambda i, a, kind, t: {"event_id": i, "application_id": a, "event_type": kind, "event_time": t}
    raw = {
        "countries": [{"country_id": 1, "country_name": "X", "visa_fee_usd": Decimal("50.00"), "processing_days": 9}],
        "visa_types": [{"visa_type_id": 1, "visa_type_name": "V"}],
        "applications": [
            app(1, "Approved", completed_date=date(2024, 5, 30)),  # no payment
            app(2, "Approved", completed_date=date(2024, 1, 2)),  # failed payment only
            app(3, "Approved", completed_date=date(2024, 1, 2)),  # paid, no event
            app(4, "Pending"),
            app(5, "Cancelled", date(2024, 5, 20)),
        ],
        "payments": [
            pay(1, 2, "Failed", at(3)), pay(2, 3, "Completed", at(3)), pay(3, 4, "Failed", at(4)), pay(4, 4, "Completed", at(5)),
        ],
        "application_events": [
            ev(1, 1, "Approved", at(2)), ev(2, 1, "Cancelled", at(3)), ev(3, 4, "Application Created", at(1, 23)),
            ev(4, 4, "Documents Submitted", at(2, 1)), ev(5, 4, "Odd", at(2, 1)), ev(6, 2, "Odd", at(1)),
        ],
    }
    return {n: silver.clean_table(n, table(spark, n, *r), AS_OF).cache() for n, r in raw.items()}


def test_funnel(world):
    funnel = gold.application_funnel(world["applications"], world["application_events"], world["payments"])
    assert funnel.count() == world["applications"].count()
    got = {r["application_id"]: r for r in funnel.collect()}
    assert got[1]["stage_reached"] == "Approved"  # wins over the later cancellation
    assert got[2]["stage_reached"] == "Unknown" and got[3]["stage_reached"] is None
    assert got[4]["stage_reached"] == "Documents Uploaded" and got[4]["hours_to_docs_upload"] == 2
    assert not got[3]["has_payment"]  # paid, but without an event the payment is unknown here
    assert got[4]["has_payment"] and got[4]["payment_count"] == 1


def test_reconciliation(world):
    recon = gold.payment_reconciliation(
        world["applications"], world["payments"], world["countries"], world["visa_types"], AS_OF)
    row = recon.first()
    assert recon.count() == 1 and row["application_id"] == 1
    assert (row["days_since_approval"], row["reconciliation_priority"]) == (2, "Medium")
    assert (row["country_concentration_pct"], row["month_concentration_pct"]) == (100.0, 100.0)


def test_breakdown_and_gap(world):
    got = rows(gold.approved_payment_breakdown(world["applications"], world["payments"]))
    assert got == [("Failed payment attempts only", 1, 1), ("Has successful payment", 1, 1), ("No payment record", 1, 1)]
    gap = gold.payment_gap_by_status(world["applications"], world["payments"])
    assert rows(gap) == [("Approved", "Success", 1, 50.0, 1, 0), ("Cancelled", "Other", 1, 50.0, 0, 1)]


def test_carts(world):
    carts = gold.abandoned_carts(
        world["applications"], world["application_events"], world["payments"], world["countries"], world["visa_types"], AS_OF)
    assert carts.groupBy("application_id").count().where("application_id = 4").first()["count"] == 2
    four = carts.where("application_id = 4").first()
    assert four["last_stage_reached"] == "Odd"  # same time, greater event id
    assert (four["total_events"], four["unique_event_types"], four["aging_priority"]) == (3, 3, "Critical (>90d)")
    five = carts.where("application_id = 5").first()
    assert (five["recovery_opportunity"], five["payment_status"], five["aging_priority"]) == (
        "Reactivation Opportunity", "No Payment", "Medium (7-30d)")
    tiers = {r["application_id"]: r["recovery_tier"] for r in gold.recovery_tier(carts).collect()}
    assert tiers == {4: "High", 5: "Low"}


def test_retry_due(world):
    assert rows(kpis.retry_due(world["payments"], AS_OF).select("payment_id")) == [(1,)]
    assert kpis.retry_due(world["payments"], at(3, 23)).count() == 0


def test_week_over_a_month_end(spark):
    """Documents of one week and two application months repeat the row unless rolled up."""
    app = lambda i, day: {"application_id": i, "user_id": 1, "country_id": 1, "visa_type_id": 1, "application_date": day,
                          "completed_date": day, "status": "Approved"}
    apps = silver.clean_applications(table(spark, "applications", app(1, date(2024, 4, 30)), app(2, date(2024, 5, 1))))
    docs = silver.clean_documents(table(
        spark, "documents", *[{"document_id": i, "application_id": a, "upload_time": datetime(2024, 5, 2)} for i, a in [(1, 1), (2, 1), (3, 2)]]))
    tickets = silver.clean_tickets(table(spark, "support_tickets", {"ticket_id": 1, "created_at": datetime(2024, 5, 2)}))
    countries = silver.clean_countries(table(spark, "countries", {"country_id": 1}))
    visas = silver.clean_standard(table(spark, "visa_types", {"visa_type_id": 1}), "visa_type_id")
    faithful = gold.operational_metrics(apps, docs, tickets, countries, visas)
    once = gold.operational_metrics(apps, docs, tickets, countries, visas, rollup=True)
    assert sorted(r["total_documents"] for r in faithful.collect()) == [1, 1, 2, 2]
    assert sorted(r["total_documents"] for r in once.collect()) == [3, 3]
    assert {r["total_tickets"] for r in faithful.collect()} == {0}


def test_ticket_without_application(spark):
    tickets = silver.clean_tickets(table(spark, "support_tickets", {"ticket_id": 1, "user_id": 1, "created_at": at(1)}), AS_OF)
    empty = lambda n: silver.clean_table(n, table(spark, n))
    out = gold.ticket_impact(tickets, empty("applications"), empty("users"), empty("reviews"), AS_OF)
    assert [(r["application_status_context"], r["user_rating"]) for r in out.collect()] == [("Other", None)]


# --- invariants on the test tables ---------------------------------------------------------


def test_anti_join_and_counts_add_up(medium_lake):
    apps, pay = medium_lake.silver("applications"), medium_lake.silver("payments")
    gap = without_match(apps, pay, "application_id").count()
    matched = apps.join(pay.select("application_id").distinct(), "application_id").count()
    assert gap + matched == apps.count()
    by_status = gold.payment_gap_by_status(apps, pay)
    assert by_status.agg(F.sum("applications_without_payment")).first()[0] == gap
    assert abs(by_status.agg(F.sum("pct_of_gap")).first()[0] - 100) < 0.05


def test_approved_is_gap_plus_paid(medium_lake):
    apps, pay = medium_lake.silver("applications"), medium_lake.silver("payments")
    parts = {r["payment_category"]: r["applications"] for r in gold.approved_payment_breakdown(apps, pay).collect()}
    approved = apps.where("status = 'Approved'").count()
    assert sum(parts.values()) == approved
    assert medium_lake.gold("payment_reconciliation").count() == parts["No payment record"]


def test_revenue_cube_adds_up(medium_lake):
    cube = medium_lake.gold("revenue_metrics")
    total = cube.agg(
        F.sum("total_transactions"), F.sum(F.col("successful_payments") + F.col("failed_payments")),
        F.sum(F.col("low_amount_count") + F.col("medium_amount_count") + F.col("high_amount_count")),
        F.sum("total_revenue"),
    ).first()
    known = medium_lake.silver("payments").join(medium_lake.silver("applications").select("application_id"), "application_id")
    n, amount = known.agg(F.count(F.lit(1)), F.sum("amount")).first()
    assert tuple(total) == (n, n, n, amount)


def test_funnel_rows_equal_applications(medium_lake):
    assert medium_lake.gold("application_funnel").count() == medium_lake.silver("applications").count()


def test_published_facts_of_the_fixture(medium_lake):
    """Counts recorded when the fixture was designed (FIXTURES.md)."""
    raw = medium_lake.raw
    assert raw("applications").count() == 15_075
    assert raw("payments").select("payment_id").distinct().count() == 45_832
    assert raw("users").where(~F.col("email").contains("@")).count() == 30
    assert medium_lake.plan("operational_metrics").count() == 9_009
    # a broadcast dimension, one shuffle per join key, no single-partition window
    text = medium_lake.plan("operational_metrics")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SinglePartition" not in text


@pytest.fixture
def plain_joins(spark):
    """No broadcast, and parts small enough for a hot key of a few thousand rows to be split."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.files.maxPartitionBytes": "64k",
    }
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_payments_travel_once_to_the_cube(spark, tmp_path, plain_joins):
    """One exchange by application, none by application and cell; a hot application is split and counts once a cell."""
    paid = F.timestamp_add("DAY", (F.col("id") % 70).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("payment_time")
    raw = spark.range(0, 9000, 1, 8).select(
        F.col("id").alias("payment_id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 400).cast("long").alias("application_id"),
        (F.xxhash64("id") % 40_000 / 100 + 500).cast("decimal(10,2)").alias("amount"), F.lit("USD").alias("currency"),
        F.concat(F.lit("m"), (F.col("id") % 4).cast("string")).alias("payment_method"), F.lit("g").alias("payment_gateway"),
        F.when(F.col("id") % 5 == 0, "Failed").otherwise("Completed").alias("status"), paid,
    )
    silver.enrich_payments(raw).write.parquet(f"{tmp_path}/payments")
    payments = spark.read.parquet(f"{tmp_path}/payments")
    apps = spark.range(300).select(
        F.col("id").alias("application_id"), (F.col("id") % 3).cast("int").alias("country_id"), (F.col("id") % 2).cast("int").alias("visa_type_id"))
    countries = spark.range(3).select(F.col("id").cast("int").alias("country_id"), F.lit("n").alias("country_name"), F.lit("c").alias("continent"))
    visas = spark.range(2).select(F.col("id").cast("int").alias("visa_type_id"), F.lit("v").alias("visa_type_name"))
    cube = gold.revenue_metrics(payments, apps, countries, visas)
    shown = cube.select(
        "country_id", "visa_type_id", "payment_year", "payment_month", "payment_method", "total_transactions", "total_applications",
        "total_revenue", "successful_payments", "successful_revenue", "min_transaction_value", "max_transaction_value")
    got = rows(shown)
    plan = shown._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    first = plan[plan.index("Initial Plan"):]
    assert len(re.findall(r"hashpartitioning\(application_id#", first)) == 2  # one of each side
    assert not re.search(r"hashpartitioning\(application_id#\w+, payment_year", first)
    ok = F.col("is_successful")
    assert got == rows(payments.join(apps, "application_id").groupBy(
        "country_id", "visa_type_id", "payment_year", "payment_month", "payment_method").agg(
        F.count("*"), F.count_distinct("application_id"), F.sum("amount"), F.count_if(ok),
        F.coalesce(F.sum(F.when(ok, F.col("amount"))), F.lit(0)).cast("decimal(20,2)"), F.min("amount"), F.max("amount")))
    kinds = dict(cube.dtypes)
    assert kinds["total_revenue"] == kinds["revenue_lost_to_failed_payments"] == "decimal(30,2)"
    assert kinds["successful_revenue"] == "decimal(31,2)"


def test_the_gap_carries_what_its_reports_read(medium_lake):
    s, stored = medium_lake.silver, medium_lake.gold("unpaid_applications")
    assert stored.columns == list(gold.UNPAID_COLUMNS) and "passport_id" not in stored.columns
    tables = s("applications"), s("payments"), s("countries"), s("visa_types")
    builds = (
        lambda **k: gold.payment_gap_by_visa_type(*tables, **k), lambda **k: gold.payment_reconciliation(*tables, AS_OF, **k),
        lambda **k: gold.payment_gap_by_status(*tables[:2], **k),
    )
    for build in builds:
        assert rows(build()) == rows(build(unpaid=stored))
