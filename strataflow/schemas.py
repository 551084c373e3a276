"""Schemas, keys and relations of the eleven raw tables."""

from __future__ import annotations

from pyspark.sql import types as T

_INT, _LONG, _TEXT, _DATE = T.IntegerType(), T.LongType(), T.StringType(), T.DateType()
_TIME, _BOOL, _DOUBLE = T.TimestampNTZType(), T.BooleanType(), T.DoubleType()
_MONEY, _RATE = T.DecimalType(10, 2), T.DecimalType(4, 2)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Table and column names of the data model.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "countries": _table(
        country_id=_INT, country_name=_TEXT, continent=_TEXT, visa_fee_usd=_MONEY, currency=_TEXT,
        processing_days=_INT, approval_rate=_RATE,
    ),
    "visa_types": _table(visa_type_id=_INT, visa_type_name=_TEXT),
    "airports": _table(airport_id=_LONG, airport_name=_TEXT, country_id=_INT),
    "users": _table(
        user_id=_LONG, first_name=_TEXT, last_name=_TEXT, email=_TEXT, phone=_TEXT, gender=_TEXT,
        dob=_DATE, signup_date=_DATE, country=_TEXT, city=_TEXT, device_type=_TEXT, os=_TEXT,
        acquisition_channel=_TEXT, is_verified=_BOOL,
    ),
    "passports": _table(passport_id=_LONG, user_id=_LONG, issuing_country=_TEXT),
    "applications": _table(
        application_id=_LONG, user_id=_LONG, country_id=_INT, visa_type_id=_INT, passport_id=_LONG,
        application_date=_DATE, travel_date=_DATE, status=_TEXT, expected_completion=_DATE,
        completed_date=_DATE, source=_TEXT, platform=_TEXT,
    ),
    "payments": _table(
        payment_id=_LONG, application_id=_LONG, amount=_MONEY, currency=_TEXT, payment_method=_TEXT,
        payment_gateway=_TEXT, status=_TEXT, payment_time=_TIME,
    ),
    "documents": _table(
        document_id=_LONG, application_id=_LONG, document_type=_TEXT, verified=_BOOL,
        upload_time=_TIME, verification_time=_TIME,
    ),
    "application_events": _table(
        event_id=_LONG, application_id=_LONG, event_type=_TEXT, event_time=_TIME
    ),
    "reviews": _table(
        review_id=_LONG, application_id=_LONG, user_id=_LONG, rating=_INT, review_text=_TEXT
    ),
    "support_tickets": _table(
        ticket_id=_LONG, user_id=_LONG, application_id=_LONG, category=_TEXT, priority=_TEXT,
        status=_TEXT, created_at=_TIME, resolved_at=_TIME, resolution_time_hours=_DOUBLE,
    ),
}

TABLES: tuple[str, ...] = tuple(RAW_SCHEMAS)

KEYS: dict[str, str] = {
    "countries": "country_id",
    "visa_types": "visa_type_id",
    "airports": "airport_id",
    "users": "user_id",
    "passports": "passport_id",
    "applications": "application_id",
    "payments": "payment_id",
    "documents": "document_id",
    "application_events": "event_id",
    "reviews": "review_id",
    "support_tickets": "ticket_id",
}

# (child table, foreign key, parent table, NULL counts as an orphan).  Only a ticket may have
# no application; everywhere else a missing key is an orphan.
FOREIGN_KEYS: tuple[tuple[str, str, str, bool], ...] = (
    ("application_events", "application_id", "applications", True),
    ("payments", "application_id", "applications", True),
    ("documents", "application_id", "applications", True),
    ("reviews", "application_id", "applications", True),
    ("reviews", "user_id", "users", True),
    ("support_tickets", "user_id", "users", True),
    ("support_tickets", "application_id", "applications", False),
)
