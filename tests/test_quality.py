from datetime import date, datetime

import pytest
from pyspark.sql import types as T

from conftest import rows
from strataflow.plans import quality, silver
from strataflow.schemas import RAW_SCHEMAS
from test_silver import table


@pytest.fixture(scope="module")
def faulty(spark):
    day = date(2024, 1, 1)
    return {
        "users": table(spark, "users", {"user_id": 1, "email": "a@b.co", "country": "X"}, {"user_id": 2, "email": "bad"}, {"user_id": 2, "country": "Y"}),
        "applications": table(
            spark, "applications", {"application_id": 1, "user_id": 1, "status": "Approved", "application_date": day},
            {"application_id": 2, "user_id": 9, "status": None, "application_date": date(2030, 1, 1)}),
        "application_events": table(spark, "application_events", {"event_id": 1, "application_id": 1}, {"event_id": 2, "application_id": 8}, {"event_id": 3}),
        "payments": table(spark, "payments", {"payment_id": 1, "application_id": 1}, {"payment_id": 2, "application_id": 7}, {"payment_id": 3, "application_id": 7}),
        "documents": table(spark, "documents"),
        "reviews": table(spark, "reviews", {"review_id": 1, "application_id": 1, "user_id": 3}),
        "support_tickets": table(spark, "support_tickets", {"ticket_id": 1, "user_id": 1}, {"ticket_id": 2, "user_id": 4, "application_id": 5}),
    }


def test_fk_report(faulty):
    got = rows(quality.fk_report(faulty))
    assert got == sorted([
        ("application_events", 2, "application_id"), ("payments", 2, "application_id"), ("documents", 0, "application_id"),
        ("reviews", 0, "application_id"), ("reviews", 1, "user_id"), ("support_tickets", 1, "user_id"), ("support_tickets", 1, "application_id"),
    ], key=lambda t: tuple((True, str(v)) for v in t))
    assert quality.missing_parent_rows(faulty["payments"], faulty["applications"], "application_id").count() == 2


def test_null_reports(faulty):
    got = rows(quality.null_report({"u": (faulty["users"], ["user_id", "email"])}))
    assert got == [("u", 3, "email", 1), ("u", 3, "user_id", 0)]
    assert rows(quality.key_null_report(faulty["users"], faulty["applications"])) == [
        ("silver_applications", 2, 0, 0, 1), ("silver_users", 3, 0, 1, 1)]


def test_score(faulty):
    got = {r["criterion"]: (r["weight"], r["score"], r["points"]) for r in quality.dq_score(
        faulty["users"], faulty["applications"], faulty["application_events"], faulty["payments"]).collect()}
    assert got["completeness"] == (30, 80.0, 24.0)  # 3 of 15 cells are missing
    assert got["uniqueness"] == (25, 80.0, 20.0)
    assert got["validity"] == (25, 33.33, 8.3325)
    assert got["consistency"] == (20, 50.0, 10.0)  # 1 of 2 event keys, 1 of 2 payment keys
    assert got["final"] == (100, None, 62.3325)


def test_log(faulty):
    got = {r["check_name"]: r for r in quality.dq_log(faulty["users"], faulty["applications"], faulty["payments"]).collect()}
    assert got["Critical Columns Null Check"]["issue_count"] == 2
    assert got["Email Format Validation"]["issue_count"] == 1  # a missing address is no format error
    assert got["Orphaned Payment Records"]["issue_count"] == 2
    assert got["Orphaned Payment Records"]["resolution_status"] == "Failed"
    assert got["Primary Key Duplication"]["resolution_status"] == "Passed"
    assert got["Approved Without Payment"]["resolution_status"] == "Documented"


def test_expectations(faulty, spark):
    users, apps = faulty["users"], faulty["applications"]
    as_of = datetime(2024, 6, 1)
    report = quality.expectation_report(
        quality.expect_unique(users, "user_id"),
        quality.expect_between(users, "user_id", 0, 1),
        quality.expect_in(apps, "status", ["Approved"]),
        quality.expect_in_set(apps, "user_id", users),
        quality.expect_date_range(apps, "application_date", "2020-01-01", as_of),
    )
    got = {r["expectation"]: (r["checked_rows"], r["failed_rows"], r["success"]) for r in report.collect()}
    assert got == {
        "unique": (3, 2, False), "between": (3, 2, False), "in": (1, 0, True), "in_set": (2, 1, False), "date_range": (2, 1, False)}


def test_schema_drift(spark):
    expected = RAW_SCHEMAS["reviews"]
    df = table(spark, "reviews", {"review_id": 1}, {"review_id": 2})
    assert quality.schema_drift(df, expected).count() == 0
    changed = df.selectExpr("review_id", "application_id", "user_id", "cast(review_id as string) rating", "1 as extra")
    assert rows(quality.schema_drift(changed, expected)) == [
        ("extra", "unexpected", None, "int", 2), ("rating", "type changed", "int", "string", 2), ("review_text", "missing", "string", None, 2)]
    assert [f.dataType for f in quality.schema_drift(df, expected).schema] == [f.dataType for f in quality.schema_drift(changed, expected).schema]


def test_gold_contract(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "d string, m int")
    assert rows(quality.gold_contract(df, ["d"], ["m"])) == [("m", 3, 1, False), ("unique dimensions", 3, 2, False)]
