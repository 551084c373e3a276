from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strataflow.plans import silver
from strataflow.schemas import RAW_SCHEMAS


def table(spark, name, *records):
    """Rows given by the columns of interest; everything else is NULL."""
    schema = RAW_SCHEMAS[name]
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in records], schema)


def first(df, *columns):
    return tuple(df.select(*columns).first())


def test_country_bands_and_nulls(spark):
    raw = table(
        spark, "countries",
        {"country_id": 1, "approval_rate": Decimal("0.75"), "processing_days": 7},
        {"country_id": 2, "approval_rate": Decimal("0.50"), "processing_days": 14},
        {"country_id": 3},
    )
    out = silver.clean_countries(raw).select("country_id", "approval_rating", "processing_speed")
    assert rows(out) == [(1, "High", "Fast"), (2, "Medium", "Standard"), (3, "Low", "Slow")]
    named = silver.clean_countries(raw, unknown_label="Unknown").where("country_id = 3")
    assert first(named, "approval_rating", "processing_speed") == ("Unknown", "Unknown")


def test_users(spark):
    raw = table(
        spark, "users",
        {"user_id": 1, "first_name": " ann ", "last_name": "lee", "email": " A@B.CO ", "dob": date(1999, 12, 31),
         "signup_date": date(2024, 1, 1), "is_verified": True},
        {"user_id": 2, "first_name": "bo", "email": "b@b.co"},
        {"user_id": 3, "email": "a@bxxco"},
        {"user_id": 4},
    )
    out = silver.clean_users(raw, datetime(2024, 1, 11))
    assert [r["user_id"] for r in out.orderBy("user_id").collect()] == [1, 2]
    assert first(out.where("user_id = 1"), "full_name", "email", "age", "age_group", "days_since_signup", "verification_status") == (
        "ANN LEE", "a@b.co", 25, "25-34", 10, "Verified")
    assert first(out.where("user_id = 2"), "full_name", "age_group", "verification_status") == (None, "55+", "Unverified")


def test_applications(spark):
    day = date(2024, 1, 7)  # a Sunday
    raw = table(
        spark, "applications",
        {"application_id": 1, "user_id": 1, "application_date": day, "completed_date": date(2024, 1, 9),
         "expected_completion": date(2024, 1, 8), "status": "Approved", "travel_date": date(2024, 2, 1)},
        {"application_id": 1, "user_id": 1, "application_date": date(2024, 1, 6), "status": "Pending"},
        {"application_id": 2, "user_id": 1, "application_date": day, "completed_date": day},
        {"application_id": 3, "application_date": day},
        {"application_id": 4, "user_id": 1},
    )
    out = silver.clean_applications(raw)
    assert rows(out.select("application_id")) == [(1,), (2,)]
    assert first(
        out.where("application_id = 1"), "status_category", "is_late_completion", "late_by_days", "processing_days_actual",
        "processing_days_expected", "days_until_travel", "application_day_of_week", "application_quarter",
    ) == ("Success", True, True, 2, 1, 25, 1, 1)
    # unknown status and unknown deadline
    assert first(out.where("application_id = 2"), "status_category", "is_completed", "is_late_completion") == ("Other", True, False)


def test_payments(spark):
    at = datetime(2024, 5, 6, 7, 8)
    def row(i, **kw):
        return {"payment_id": i, "application_id": 9, "amount": Decimal("100.00"), "status": "Completed", "payment_time": at, **kw}
    raw = table(
        spark, "payments", row(1), row(2, amount=Decimal("99.99"), status="Failed"), row(3, amount=Decimal("300.00"), status=None),
        row(4, amount=Decimal("0.00")), row(5, payment_time=None), row(6, amount=None),
        row(1, status="Failed", payment_time=datetime(2024, 5, 1)),
    )
    out = silver.clean_payments(raw).select("payment_id", "payment_amount_category", "is_successful", "payment_date", "payment_hour")
    assert rows(out) == [
        (1, "Medium", True, "2024-05-06", 7), (2, "Low", False, "2024-05-06", 7), (3, "High", False, "2024-05-06", 7),
    ]
    renamed = silver.clean_payments(raw, success_values=("Failed",)).where("is_successful")
    assert rows(renamed.select("payment_id")) == [(2,)]
    assert silver.clean_payments(raw, keep="any").count() == 3


def test_documents(spark):
    up = datetime(2024, 1, 1)
    raw = table(
        spark, "documents",
        {"document_id": 1, "verified": True, "upload_time": up, "verification_time": datetime(2024, 1, 2)},
        {"document_id": 2, "verified": True, "upload_time": up, "verification_time": datetime(2024, 1, 2, 0, 30)},
        {"document_id": 3, "verified": False, "upload_time": up, "verification_time": datetime(2024, 1, 4, 1)},
        {"document_id": 4, "upload_time": up},
    )
    out = silver.clean_documents(raw).select("document_id", "verification_hours", "verification_speed")
    assert rows(out) == [
        (1, 24.0, "Fast (<24h)"), (2, 24.5, "Standard (24-72h)"), (3, 73.0, "Slow (>72h)"), (4, None, "Pending"),
    ]


def test_tickets(spark):
    made = datetime(2024, 1, 1)
    raw = table(
        spark, "support_tickets",
        {"ticket_id": 1, "priority": "High", "status": "Open", "created_at": made},
        {"ticket_id": 2, "priority": "High", "status": "Resolved", "created_at": made, "resolved_at": made, "resolution_time_hours": 4.0},
        {"ticket_id": 3, "priority": "High", "status": None, "created_at": made, "resolution_time_hours": 72.5},
    )
    out = silver.clean_tickets(raw, datetime(2024, 1, 2)).select(
        "ticket_id", "is_resolved", "resolution_speed", "is_high_priority_open", "open_ticket_age_hours")
    assert rows(out) == [
        (1, False, "Open", True, 24.0), (2, True, "Immediate (<4h)", False, None), (3, False, "Slow (>72h)", False, 24.0),
    ]
    assert rows(silver.silver_rates(silver.clean_documents(table(spark, "documents")), silver.clean_tickets(raw)))[1] == (
        "support_tickets", 3, 1, 33.33, 1)


def test_retry_flags(spark):
    raw = table(
        spark, "payments",
        *[{"payment_id": i, "application_id": a, "amount": Decimal("1.00"), "status": s, "payment_time": datetime(2024, 1, d)}
          for i, a, s, d in [(1, 1, "Failed", 1), (2, 1, "Completed", 2), (3, 2, "Completed", 1), (4, 2, "Failed", 2), (5, 3, "Failed", 1)]],
    )
    out = silver.flag_payment_retry(raw).select("payment_id", "attempt_is_retry", "retry_after_failure")
    assert rows(out) == [(1, False, False), (2, True, True), (3, False, False), (4, True, False), (5, False, False)]


def test_clean_standard(spark):
    raw = table(spark, "reviews", {"review_id": 1, "rating": 1}, {"review_id": 1, "rating": 1}, {"review_id": 2})
    assert silver.clean_standard(raw, "review_id").count() == 2
    assert silver.clean_standard(raw, "review_id", keep="any").count() == 2


@pytest.mark.parametrize("name", ["countries", "users", "applications", "payments", "documents", "support_tickets", "airports"])
def test_empty_input(spark, name):
    assert silver.clean_table(name, table(spark, name)).count() == 0


def test_the_version_that_arrived_last_stays(spark):
    from strataflow.plans import silver
    from strataflow.plans.silver import ARRIVAL
    from strataflow.schemas import RAW_SCHEMAS

    names = RAW_SCHEMAS["applications"]
    first = spark.range(1000).select(
        *[
            (F.col("id") if f.name == "application_id" else F.lit("Pending") if f.name == "status"
             else F.lit("2024-01-01") if f.dataType.typeName() in ("date", "timestamp") else F.lit("1"))
            .cast(f.dataType).alias(f.name)
            for f in names
        ],
        F.lit("2024-05-01 00:00:00").cast("timestamp").alias(ARRIVAL),
    )
    later = first.withColumn("status", F.lit("Approved")).withColumn(ARRIVAL, F.col(ARRIVAL) + F.expr("INTERVAL 1 DAY"))
    out = silver.clean_applications(later.union(first).union(later))
    assert rows(out.groupBy("status").count()) == [("Approved", 1000)] and ARRIVAL not in out.columns
