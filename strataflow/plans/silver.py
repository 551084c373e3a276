"""Silver layer: cleaned, enriched tables with one row per key.

Each function filters and deduplicates the base columns first and derives columns afterwards, so
only base columns are shuffled.  ``as_of`` fixes the moment for ages and open durations; it
defaults to now.  ``unknown_label`` routes missing inputs to their own label instead of the last
branch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    as_time,
    bucketize,
    count_where,
    email_ok,
    flag,
    hours_fraction,
    only_if,
    pct,
)
from ..functions.moments import moment
from ..operators.dedup import dedup_any, dedup_latest
from ..operators.joins import join_one
from ..schemas import KEYS, RAW_SCHEMAS

# Band limits and labels.
APPROVAL_BANDS = [(0.75, "High"), (0.50, "Medium")]
PROCESSING_BANDS = [(7, "Fast"), (14, "Standard")]
AGE_BANDS = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")]
AMOUNT_BANDS = [(100, "Low"), (300, "Medium")]
VERIFICATION_BANDS = [(24, "Fast (<24h)"), (72, "Standard (24-72h)")]
RESOLUTION_BANDS = [(4, "Immediate (<4h)"), (24, "Fast (<24h)"), (72, "Standard (24-72h)")]
SLOW_HOURS = "Slow (>72h)"
STATUS_CATEGORIES = {"Approved": "Success", "Rejected": "Failure", "Pending": "In Progress"}


#: When a row arrived in bronze: the newest arrival of a key is its current version.
ARRIVAL = "bronze_ingestion_timestamp"


def _base(df: DataFrame, table: str, extra: Sequence[str] = ()) -> DataFrame:
    arrival = [ARRIVAL] if ARRIVAL in df.columns else []
    return df.select(*RAW_SCHEMAS[table].names, *extra, *arrival)


def version_order(df: DataFrame, order_by: Sequence[str]) -> list[str]:
    """What makes a version the newer one: a later arrival (where bronze says when), then a greater ``order_by``."""
    return [*([ARRIVAL] if ARRIVAL in df.columns else []), *order_by]


def _unique(df: DataFrame, table: str, order_by: Sequence[str], keep: str) -> DataFrame:
    """One row per key: the latest to arrive (where bronze says when), then the greatest by ``order_by``.

    Versions that are equal in all of these are told apart by a hash of the row: one is kept, the same on every run, but
    which of them means nothing.  Without an arrival time that is all there is to go by."""
    if keep == "any":
        return dedup_any(df, KEYS[table]).drop(ARRIVAL)
    return dedup_latest(df, KEYS[table], version_order(df, order_by)).drop(ARRIVAL)


# Each table has a valid form (row by row: base columns, tidied, bad rows removed) and an enriched one (row by row again).
# Between them stands the choice of one version per key, the only step that shuffles.


def valid_users(df: DataFrame) -> DataFrame:
    tidy = _base(df, "users").withColumns(
        {
            "first_name": F.trim(F.upper("first_name")),
            "last_name": F.trim(F.upper("last_name")),
            "email": F.lower(F.trim("email")),
        }
    )
    return tidy.where(email_ok("email"))


def valid_applications(df: DataFrame) -> DataFrame:
    return _base(df, "applications").dropna(subset=["application_date", "user_id"])


def valid_payments(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return _base(df, "payments", extra).where((F.col("amount") > 0) & F.col("payment_time").isNotNull())


def enrich_countries(rows: DataFrame, unknown_label: str | None = None) -> DataFrame:
    return rows.select(
        "*",
        bucketize("approval_rate", ">=", APPROVAL_BANDS, "Low", unknown_label).alias("approval_rating"),
        bucketize("processing_days", "<=", PROCESSING_BANDS, "Slow", unknown_label).alias("processing_speed"),
    )


def enrich_users(rows: DataFrame, as_of=None, unknown_label: str | None = None) -> DataFrame:
    today = as_time(as_of).cast("date")
    age = F.year(today) - F.year("dob")
    verified = F.when(F.col("is_verified"), "Verified")
    if unknown_label is not None:
        verified = verified.when(F.col("is_verified").isNull(), unknown_label)
    return (
        rows.withColumn("full_name", F.concat("first_name", F.lit(" "), "last_name"))
        .withColumn("age", age)
        .withColumn("days_since_signup", F.date_diff(today, F.col("signup_date")))
        .withColumn("verification_status", verified.otherwise("Unverified"))
        .withColumn("age_group", bucketize("age", "<", AGE_BANDS, "55+", unknown_label))
    )


def enrich_applications(rows: DataFrame, unknown_label: str | None = None) -> DataFrame:
    applied = F.col("application_date")
    category = F
    for status, label in STATUS_CATEGORIES.items():
        category = category.when(F.col("status") == status, label)
    if unknown_label is not None:
        category = category.when(F.col("status").isNull(), unknown_label)
    return rows.select(
        "*",
        F.date_diff("travel_date", applied).alias("days_until_travel"),
        F.date_diff("completed_date", applied).alias("processing_days_actual"),
        F.date_diff("expected_completion", applied).alias("processing_days_expected"),
        F.year(applied).alias("application_year"),
        F.month(applied).alias("application_month"),
        F.quarter(applied).alias("application_quarter"),
        F.dayofweek(applied).alias("application_day_of_week"),
        category.otherwise("Other").alias("status_category"),
        F.col("completed_date").isNotNull().alias("is_completed"),
        flag(F.col("completed_date") > F.col("expected_completion")).alias("is_late_completion"),
        # the documented variant: actual days against the expected number of days
        flag(
            F.date_diff("completed_date", applied) > F.date_diff("expected_completion", applied)
        ).alias("late_by_days"),
    )


def enrich_payments(rows: DataFrame, success_values: Sequence[str] = ("Completed",)) -> DataFrame:
    paid = F.col("payment_time")
    return rows.select(
        "*",
        F.year(paid).alias("payment_year"),
        F.month(paid).alias("payment_month"),
        F.quarter(paid).alias("payment_quarter"),
        F.date_format(paid, "yyyy-MM-dd").alias("payment_date"),
        F.hour(paid).alias("payment_hour"),
        bucketize("amount", "<", AMOUNT_BANDS, "High").alias("payment_amount_category"),
        flag(F.col("status").isin(*success_values)).alias("is_successful"),
    )


def enrich_documents(rows: DataFrame) -> DataFrame:
    checked = F.col("verification_time").isNotNull()
    return (
        rows.withColumn("is_verified", F.col("verified"))
        .withColumn("verification_hours", only_if(checked, hours_fraction("upload_time", "verification_time")))
        .withColumn(
            "verification_speed",
            F.when(checked, bucketize("verification_hours", "<=", VERIFICATION_BANDS, SLOW_HOURS))
            .otherwise("Pending"),
        )
        .select(
            "*",
            F.year("upload_time").alias("upload_year"),
            F.month("upload_time").alias("upload_month"),
            F.date_format("upload_time", "yyyy-MM-dd").alias("upload_date"),
        )
    )


def enrich_tickets(rows: DataFrame, as_of=None) -> DataFrame:
    made, solved = F.col("created_at"), F.col("resolved_at")
    return rows.select(
        "*",
        solved.isNotNull().alias("is_resolved"),
        bucketize("resolution_time_hours", "<=", RESOLUTION_BANDS, SLOW_HOURS, null_label="Open").alias("resolution_speed"),
        flag((F.col("priority") == "High") & (F.col("status") != "Resolved")).alias("is_high_priority_open"),
        F.year(made).alias("created_year"),
        F.month(made).alias("created_month"),
        F.quarter(made).alias("created_quarter"),
        F.date_format(made, "yyyy-MM-dd").alias("created_date"),
        F.dayofweek(made).alias("created_day_of_week"),
        only_if(solved.isNull(), hours_fraction(made, as_time(as_of))).alias("open_ticket_age_hours"),
    )


def clean_countries(df: DataFrame, keep: str = "latest", unknown_label: str | None = None) -> DataFrame:
    return enrich_countries(_unique(_base(df, "countries"), "countries", [], keep), unknown_label)


def clean_users(
    df: DataFrame, as_of=None, keep: str = "latest", unknown_label: str | None = None
) -> DataFrame:
    """Names in capitals, e-mail in lower case; rows without a well-formed e-mail are removed."""
    return enrich_users(_unique(valid_users(df), "users", VERSION_ORDER["users"], keep), as_of, unknown_label)


def clean_applications(
    df: DataFrame,
    keep: str = "latest",
    order_by: Sequence[str] = ("application_date",),
    unknown_label: str | None = None,
) -> DataFrame:
    """Rows need a date and a user."""
    return enrich_applications(_unique(valid_applications(df), "applications", order_by, keep), unknown_label)


def clean_payments(
    df: DataFrame,
    success_values: Sequence[str] = ("Completed",),
    keep: str = "latest",
    order_by: Sequence[str] = ("payment_time",),
) -> DataFrame:
    """Rows need a positive amount and a time.  ``order_by`` may name columns outside the schema
    (an arrival order); they decide which duplicate wins and are dropped."""
    extra = [c for c in order_by if c not in RAW_SCHEMAS["payments"].names]
    rows = _unique(valid_payments(df, extra), "payments", order_by, keep).drop(*extra)
    return enrich_payments(rows, success_values)


def clean_documents(df: DataFrame, keep: str = "latest") -> DataFrame:
    return enrich_documents(_unique(_base(df, "documents"), "documents", VERSION_ORDER["documents"], keep))


def clean_tickets(df: DataFrame, as_of=None, keep: str = "latest") -> DataFrame:
    rows = _unique(_base(df, "support_tickets"), "support_tickets", VERSION_ORDER["support_tickets"], keep)
    return enrich_tickets(rows, as_of)


def clean_standard(df: DataFrame, key: str, keep: str = "latest") -> DataFrame:
    """A table that only needs one row per key: the latest to arrive, where bronze says when."""
    return dedup_any(df, key) if keep == "any" else dedup_latest(df, key, version_order(df, []))


# Which version of a key is the current one, after its arrival.
VERSION_ORDER = {
    "users": ["signup_date"],
    "applications": ["application_date"],
    "payments": ["payment_time"],
    "documents": ["upload_time"],
    "support_tickets": ["created_at"],
}


def clean_table(name: str, raw: DataFrame, as_of=None, payment_order: Sequence[str] = ("payment_time",)) -> DataFrame:
    """The silver form of any of the eleven tables."""
    special: Mapping[str, Callable[[], DataFrame]] = {
        "countries": lambda: clean_countries(raw),
        "users": lambda: clean_users(raw, as_of),
        "applications": lambda: clean_applications(raw),
        "payments": lambda: clean_payments(raw, order_by=payment_order),
        "documents": lambda: clean_documents(raw),
        "support_tickets": lambda: clean_tickets(raw, as_of),
    }
    return special[name]() if name in special else clean_standard(raw, KEYS[name])


def valid_rows(name: str, raw: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The rows of a table that may become silver, base columns and arrival only; ``extra`` columns order versions."""
    if name == "users":
        return valid_users(raw)
    if name == "applications":
        return valid_applications(raw)
    if name == "payments":
        return valid_payments(raw, extra)
    return _base(raw, name, extra)


def enrich_rows(name: str, rows: DataFrame, as_of=None) -> DataFrame:
    """Silver columns of rows that are valid and unique."""
    special: Mapping[str, Callable[[], DataFrame]] = {
        "countries": lambda: enrich_countries(rows),
        "users": lambda: enrich_users(rows, as_of),
        "applications": lambda: enrich_applications(rows),
        "payments": lambda: enrich_payments(rows),
        "documents": lambda: enrich_documents(rows),
        "support_tickets": lambda: enrich_tickets(rows, as_of),
    }
    return special[name]() if name in special else rows


def silver_rates(documents: DataFrame, tickets: DataFrame) -> DataFrame:
    """Verified share, resolved share and open high-priority tickets: one row per measure."""
    n = F.count(F.lit(1))
    docs = documents.agg(
        F.lit("documents").alias("table_name"),
        n.alias("total_rows"),
        count_where(F.col("is_verified")).alias("done_rows"),
        pct(count_where(F.col("is_verified")), n).alias("done_pct"),
        F.lit(None).cast("bigint").alias("high_priority_open"),
    )
    tick = tickets.agg(
        F.lit("support_tickets").alias("table_name"),
        n.alias("total_rows"),
        count_where(F.col("is_resolved")).alias("done_rows"),
        pct(count_where(F.col("is_resolved")), n).alias("done_pct"),
        count_where(F.col("is_high_priority_open")).alias("high_priority_open"),
    )
    return docs.unionByName(tick)


def flag_payment_retry(payments: DataFrame, **skew) -> DataFrame:
    """``attempt_is_retry``: an earlier attempt exists for the same application;
    ``retry_after_failure``: an earlier attempt of that application failed.

    Attempts are ordered by time and id.  Both flags only need the first (failed) attempt per
    application, a hash-aggregated minimum that is combined map-side.  The attempts then meet one row a key, a
    join that adaptive execution splits where a key is hot; ``hot_rows`` salts hot keys instead.
    """
    attempt = moment("payment_time", "payment_id")
    firsts = payments.groupBy("application_id").agg(
        F.min(attempt).alias("_first"),
        F.min(F.when(F.col("status") == "Failed", attempt)).alias("_first_failed"),
    )
    joined = join_one(payments, firsts, "application_id", spread_on="payment_id", **skew)
    return joined.select(
        *payments.columns,
        flag(attempt > F.col("_first")).alias("attempt_is_retry"),
        flag(attempt > F.col("_first_failed")).alias("retry_after_failure"),
    )
