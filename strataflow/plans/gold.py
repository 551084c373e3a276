"""Gold layer: business tables built from silver tables.

Facts are aggregated to the join key before they are joined, dimensions are looked up after
aggregation, and joins that may meet a hot key go through the skew-safe helpers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    as_time,
    bucketize,
    count_where,
    days_elapsed,
    exact_avg,
    flag,
    hours_elapsed,
    only_if,
    pct,
    rounded_avg,
    stable_round,
    week_start,
)
from ..functions.moments import time_of
from ..operators.grouping import first_times, group_with_share, group_with_totals, newest_by, pct_within, top_k
from ..operators.joins import join_dim, join_many, join_one, star_join, without_match


def _rows() -> Column:
    return F.count(F.lit(1))


# Event types, in the order of precedence of the stage they lead to.
STAGES = (
    ("Approved", "approved_at", "Approved"),
    ("Rejected", "rejected_at", "Rejected"),
    ("Cancelled", "cancelled_at", "Cancelled"),
    ("Verification Started", "under_review_at", "Under Review"),
    ("Documents Submitted", "docs_uploaded_at", "Documents Uploaded"),
    ("Application Created", "created_at", "Created"),
)
# Limits and labels of the classes.
RECONCILIATION_BANDS = [(90, "Critical"), (30, "High")]
AGING_BANDS = [(90, "Critical (>90d)"), (30, "High (30-90d)"), (7, "Medium (7-30d)")]
VALUE_BANDS = [(500, "High Value"), (200, "Medium Value")]
FAST, STANDARD, SLOW = "Fast (<24h)", "Standard (24-72h)", "Slow (>72h)"


# --- funnel -------------------------------------------------------------------------------


def application_funnel(apps: DataFrame, events: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per application: stage times, furthest stage, successful payments, hours between
    stages.  Payment columns are known only for applications that have an event; ``stage_reached``
    is NULL for an application without any."""
    stages = first_times(
        events, "application_id", "event_type", "event_time", {kind: column for kind, column, _ in STAGES}
    )
    furthest = F.coalesce(
        *[F.when(F.col(column).isNotNull(), F.lit(label)) for _, column, label in STAGES], F.lit("Unknown")
    )
    paid = (
        payments.where("is_successful")
        .groupBy("application_id")
        .agg(F.min("payment_time").alias("paid_at"), _rows().alias("payment_count"))
    )
    progress = join_one(stages, paid, "application_id").withColumn("stage_reached", furthest)
    return join_one(apps, progress, "application_id").select(
        "application_id", "user_id", "country_id", "visa_type_id", "passport_id",
        "created_at", "docs_uploaded_at", "under_review_at", "paid_at", "approved_at",
        "rejected_at", "cancelled_at",
        "application_date", "travel_date", F.col("status").alias("final_status"), "status_category",
        "completed_date", "processing_days_actual", "processing_days_expected",
        "is_late_completion", "days_until_travel",
        "stage_reached",
        F.col("paid_at").isNotNull().alias("has_payment"),
        F.coalesce("payment_count", F.lit(0)).alias("payment_count"),
        hours_elapsed("created_at", "docs_uploaded_at").alias("hours_to_docs_upload"),
        hours_elapsed("docs_uploaded_at", "under_review_at").alias("hours_docs_to_review"),
        hours_elapsed("under_review_at", "approved_at").alias("hours_review_to_approval"),
        hours_elapsed("created_at", "approved_at").alias("hours_created_to_approved"),
        "source", "platform", "application_year", "application_month", "application_quarter",
        F.col("application_date").alias("application_date_str"),
    )


def funnel_overview(funnel: DataFrame) -> DataFrame:
    late = count_where(F.col("is_late_completion"))
    return funnel.agg(
        _rows().alias("total_applications"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("country_id").alias("countries_covered"),
        count_where(F.col("has_payment")).alias("apps_with_payment"),
        count_where(~F.col("has_payment")).alias("apps_without_payment"),
        rounded_avg("processing_days_actual").alias("avg_processing_days"),
        late.alias("late_completions"),
        pct(late, _rows()).alias("late_completion_pct"),
    )


def stage_dropoff(funnel: DataFrame) -> DataFrame:
    measures = {
        "applications": _rows(),
        "avg_processing_days": rounded_avg("processing_days_actual"),
        "late_count": count_where(F.col("is_late_completion")),
    }
    return (
        group_with_share(funnel, ["stage_reached"], measures, "applications", "pct_of_total")
        .select("stage_reached", "applications", "pct_of_total", "avg_processing_days", "late_count")
        .orderBy(F.desc("applications"), "stage_reached")
    )


# --- payment gap --------------------------------------------------------------------------


# What the reports below read of an application without payment: the anti join carries no more than is asked for.
UNPAID_COLUMNS = (
    "application_id", "user_id", "country_id", "visa_type_id", "status", "status_category", "is_completed", "completed_date",
    "application_date", "application_year", "application_month", "source", "platform",
)


def unpaid_applications(apps: DataFrame, payments: DataFrame) -> DataFrame:
    """Applications without any payment row.

    The reports below each use this several times (rows, group counts, total).  Anti joins of
    facts are dear, so store the result and pass it as ``unpaid``; without it they compute it.
    """
    return without_match(apps, payments, "application_id")


def payment_gap_by_status(
    apps: DataFrame, payments: DataFrame, unpaid: DataFrame | None = None
) -> DataFrame:
    """Applications without any payment row, by status, as a share of the whole gap."""
    gap = unpaid_applications(apps, payments) if unpaid is None else unpaid
    measures = {
        "applications_without_payment": _rows(),
        "completed_count": count_where(F.col("is_completed")),
        "not_completed_count": count_where(~F.col("is_completed")),
    }
    return (
        group_with_share(gap, ["status", "status_category"], measures, "applications_without_payment", "pct_of_gap")
        .select(
            "status", "status_category", "applications_without_payment", "pct_of_gap",
            "completed_count", "not_completed_count",
        )
        .orderBy(F.desc("applications_without_payment"), "status")
    )


def payment_gap_by_visa_type(
    apps: DataFrame,
    payments: DataFrame,
    countries: DataFrame,
    visa_types: DataFrame,
    unpaid: DataFrame | None = None,
) -> DataFrame:
    """The gap by status, visa type and fee, with the share of the whole gap and of the status.

    The whole gap counts every application without payment, also those of an unknown country."""
    rows = unpaid_applications(apps, payments) if unpaid is None else unpaid
    gap = group_with_totals(rows, ["status", "visa_type_id", "country_id"], {"n": _rows()}, ["n"])
    named = join_dim(gap, visa_types, "visa_type_id", ["visa_type_name"])
    named = join_dim(named, countries, "country_id", ["visa_fee_usd"])
    grouped = (
        named.groupBy("status", "visa_type_name", "visa_fee_usd")
        .agg(F.sum("n").alias("app_count"), F.max("_total_n").alias("_whole"))
        .withColumn("pct_of_total_gap", pct(F.col("app_count"), F.col("_whole")))
        .drop("_whole")
    )
    return pct_within(grouped, "app_count", "status", "total_by_status", "pct_within_status").orderBy(
        "status", F.desc("app_count"), "visa_type_name", "visa_fee_usd"
    )


MONTH = ("application_year", "application_month")


def gap_counts(unpaid: DataFrame) -> DataFrame:
    """Approved applications without payment by country, by month and in all: grouping sets, one pass.  ``grain`` says which."""
    approved = unpaid.where(F.col("status") == "Approved")
    counted = approved.groupingSets([["country_id"], list(MONTH), []], "country_id", *MONTH).agg(
        F.grouping_id().alias("_set"), _rows().alias("n")
    )
    grain = F.when(F.col("_set") == 3, "country").when(F.col("_set") == 4, "month").otherwise("all")
    return counted.select(grain.alias("grain"), "country_id", *MONTH, "n")


def payment_reconciliation(
    apps: DataFrame,
    payments: DataFrame,
    countries: DataFrame,
    visa_types: DataFrame,
    as_of=None,
    unpaid: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Approved applications with no payment row at all, with fee, concentration and age.

    The concentration counts come from one small aggregate of the gap (``gap_counts``) instead
    of windows over it: a window by country would sort a third of the gap in one task if one
    country holds a third.  They are used three times: pass them stored, as ``unpaid``.
    """
    approved = F.col("status") == "Approved"
    gap = unpaid.where(approved) if unpaid is not None else unpaid_applications(apps.where(approved), payments)
    counts = gap_counts(gap) if counts is None else counts
    gap = gap.select(
        "application_id", "user_id", "country_id", "visa_type_id", "status",
        F.col("completed_date").alias("approved_at"), "application_date", "application_year",
        "application_month", "source", "platform",
    )
    month = list(MONTH)
    whole = counts.where(F.col("grain") == "all").agg(F.max("n")).scalar()
    in_country = counts.where(F.col("grain") == "country").select("country_id", F.col("n").alias("country_concentration_count"))
    in_month = counts.where(F.col("grain") == "month").select(*month, F.col("n").alias("month_concentration_count"))

    country = countries.select(
        "country_id", "country_name", F.col("visa_fee_usd").alias("expected_fee"),
        F.col("processing_days").alias("expected_processing_days"),
    )
    known = country.join(in_country, "country_id")
    # A date has a year below 10,000: at most 120,000 months.
    months = F.broadcast(in_month)
    same_month = gap[month[0]].eqNullSafe(months[month[0]]) & gap[month[1]].eqNullSafe(months[month[1]])
    rows = gap.join(months, same_month).drop(months[month[0]], months[month[1]]).join(known, "country_id")
    rows = join_dim(rows, visa_types, "visa_type_id", ["visa_type_name"])

    now = as_time(as_of)
    return rows.withColumn("days_since_approval", days_elapsed("approved_at", now)).select(
        "application_id", "user_id", "country_id", "visa_type_id",
        F.lit("Missing").alias("payment_status"), "expected_fee", "expected_processing_days",
        "status", "approved_at", "application_date", "country_name", "visa_type_name", "source",
        "platform", "country_concentration_count",
        pct(F.col("country_concentration_count"), whole).alias("country_concentration_pct"),
        "month_concentration_count",
        pct(F.col("month_concentration_count"), whole).alias("month_concentration_pct"),
        *month, "days_since_approval",
        bucketize("days_since_approval", ">", RECONCILIATION_BANDS, "Medium").alias("reconciliation_priority"),
        F.col("expected_fee").alias("estimated_revenue_loss"),
    )


def reconciliation_overview(recon: DataFrame) -> DataFrame:
    priority = F.col("reconciliation_priority")
    return recon.agg(
        _rows().alias("total_unreconciled_apps"),
        F.sum("estimated_revenue_loss").alias("total_revenue_at_risk"),
        exact_avg(F.sum("expected_fee"), F.count("expected_fee")).alias("avg_expected_fee"),
        F.count_distinct("country_id").alias("countries_affected"),
        F.count_distinct("visa_type_id").alias("visa_types_affected"),
        count_where(priority == "Critical").alias("critical_priority_count"),
        count_where(priority == "High").alias("high_priority_count"),
        rounded_avg("days_since_approval").alias("avg_days_since_approval"),
    )


def gap_by_country(recon: DataFrame, k: int = 10) -> DataFrame:
    """The k countries with most unreconciled applications."""
    measures = {
        "unreconciled_count": _rows(),
        "revenue_at_risk": F.sum("estimated_revenue_loss"),
        "avg_days_since_approval": rounded_avg("days_since_approval"),
        "visa_types_affected": F.count_distinct("visa_type_name"),
    }
    grouped = group_with_share(recon, ["country_name"], measures, "unreconciled_count", "pct_of_gap")
    return top_k(grouped, "unreconciled_count", k, "country_name")


def approved_payment_breakdown(apps: DataFrame, payments: DataFrame) -> DataFrame:
    """Approved applications by payment outcome.  ``app_count`` counts joined rows (one per
    payment, at least one per application), ``applications`` counts applications."""
    attempts = payments.groupBy("application_id").agg(
        F.count("payment_id").alias("n"), count_where(F.col("is_successful")).alias("ok")
    )
    approved = apps.where(F.col("status") == "Approved").select("application_id")
    category = (
        F.when(F.coalesce("n", F.lit(0)) == 0, "No payment record")
        .when(F.col("ok") == 0, "Failed payment attempts only")
        .otherwise("Has successful payment")
    )
    return (
        join_one(approved, attempts, "application_id")
        .groupBy(category.alias("payment_category"))
        .agg(
            F.sum(F.greatest(F.coalesce("n", F.lit(0)), F.lit(1))).alias("app_count"),
            _rows().alias("applications"),
        )
    )


# --- revenue ------------------------------------------------------------------------------

PAYMENT_DIMS = ("payment_year", "payment_month", "payment_quarter", "payment_method", "payment_gateway")


def revenue_metrics(
    payments: DataFrame, apps: DataFrame, countries: DataFrame, visa_types: DataFrame
) -> DataFrame:
    """Payment volume, revenue and outcome by destination, visa type, month, method and gateway.

    Payments travel once, by application and reduced to what the cube reads.  They meet the owner of their application there,
    are combined per application and cell where they lie, and the later count of applications is a plain count.  An
    application with very many payments is a join partition that adaptive execution splits; its parts are then combined before
    they travel.  Combining before the join would shorten nothing else: few payments of an application share a cell.
    Silver guarantees what this relies on: unique ``payment_id`` and ``application_id``, no missing amount or outcome, amounts
    as decimals.  They are summed in whole units of their last digit, whose buffers are half as long.
    Successful figures are the difference of all and failed ones, which keeps the aggregation
    buffers short.
    """
    failed, size = ~F.col("is_successful"), F.col("payment_amount_category")
    scale = payments.schema["amount"].dataType.scale
    units = (F.col("amount") * F.lit(Decimal(10**scale))).cast("bigint")

    def money(total: Column) -> Column:
        return (total.cast("decimal(30,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(30,{scale})")

    slim = payments.select("application_id", *PAYMENT_DIMS, "amount", failed.alias("failed"), size)
    owners = apps.select("application_id", "country_id", "visa_type_id")
    cell = ("country_id", "visa_type_id", *PAYMENT_DIMS)
    per_application = join_one(slim, owners, "application_id", "inner").groupBy("application_id", *cell).agg(
        _rows().alias("n"),
        F.sum(units).alias("total"),
        F.min("amount").alias("low"),
        F.max("amount").alias("high"),
        count_where(F.col("failed")).alias("n_failed"),
        F.sum(F.when(F.col("failed"), units)).alias("lost"),
        count_where(size == "Low").alias("n_low"),
        count_where(size == "Medium").alias("n_medium"),
    )
    cells = per_application.groupBy(*cell).agg(
        F.sum("n").alias("total_transactions"),
        _rows().alias("total_applications"),
        money(F.sum("total")).alias("total_revenue"),
        F.min("low").alias("min_transaction_value"),
        F.max("high").alias("max_transaction_value"),
        F.sum("n_failed").alias("failed_payments"),
        F.coalesce(money(F.sum("lost")), F.lit(0)).alias("revenue_lost_to_failed_payments"),
        F.sum("n_low").alias("low_amount_count"),
        F.sum("n_medium").alias("medium_amount_count"),
    )
    n, total = F.col("total_transactions"), F.col("total_revenue")
    ok = n - F.col("failed_payments")
    earned = total - F.col("revenue_lost_to_failed_payments")
    cube = cells.withColumns(
        {
            "avg_transaction_value": exact_avg(total, n),
            "successful_payments": ok,
            "payment_success_rate": pct(ok, n),
            "high_amount_count": n - F.col("low_amount_count") - F.col("medium_amount_count"),
            "successful_revenue": earned,
            "avg_successful_value": exact_avg(earned, ok),
        }
    )
    named = star_join(
        cube, [(countries, "country_id", ["country_name", "continent"]), (visa_types, "visa_type_id", ["visa_type_name"])]
    )
    return named.select(
        "country_id", "country_name", "continent", "visa_type_id", "visa_type_name", *PAYMENT_DIMS,
        "total_transactions", "total_applications", "total_revenue", "avg_transaction_value",
        "min_transaction_value", "max_transaction_value", "successful_payments", "failed_payments",
        "payment_success_rate", "revenue_lost_to_failed_payments", "low_amount_count",
        "medium_amount_count", "high_amount_count", "successful_revenue", "avg_successful_value",
    )


def grain_density(
    cube: DataFrame,
    dims: Mapping[str, Column | str] | None = None,
) -> DataFrame:
    """Distinct members per dimension, the number of possible cells and the share present."""
    dims = dims or {
        "countries": "country_id",
        "visa_types": "visa_type_id",
        "payment_methods": "payment_method",
        "payment_gateways": "payment_gateway",
        "year_months": F.concat_ws("-", "payment_year", "payment_month"),
    }
    counted = cube.agg(
        _rows().alias("total_rows"),
        *[F.count_distinct(c).alias(f"distinct_{name}") for name, c in dims.items()],
    )
    possible = F.lit(1).cast("bigint")
    for name in dims:
        possible = possible * F.col(f"distinct_{name}")
    return counted.withColumn("possible_rows", possible).withColumn(
        "density_pct", pct(F.col("total_rows"), F.col("possible_rows"), 1)
    )


def validation_report(breakdown: DataFrame, density: DataFrame) -> DataFrame:
    """Payment breakdown and grain of the revenue cube as readable (check, metric, value) rows.

    Takes the results of :func:`approved_payment_breakdown` and :func:`grain_density`."""

    def text(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    def members(name: str) -> Column:
        return F.col(f"distinct_{name}")

    gap = breakdown.select(
        F.lit("Payment Gap Breakdown").alias("validation_check"),
        F.col("payment_category").alias("metric"),
        text(F.col("app_count"), " approved apps").alias("value"),
    )
    size = text(
        members("countries"), " countries × ", members("visa_types"), " visa types × ",
        members("payment_methods"), " methods × ", members("payment_gateways"), " gateways × ",
        members("year_months"), " months",
    )
    present = text(
        F.col("total_rows"), " rows / ", F.col("possible_rows"), " possible = ", F.col("density_pct"),
        "% (sparse as expected)",
    )
    entries = [
        F.struct(F.lit(metric).alias("metric"), value.alias("value"))
        for metric, value in (("Dimensions", size), ("Data density", present))
    ]
    grain = density.select(F.explode(F.array(*entries)).alias("e")).select(
        F.lit("Revenue Metrics Grain").alias("validation_check"), "e.*"
    )
    return gap.unionByName(grain)


# --- users --------------------------------------------------------------------------------


def user_cohorts(
    users: DataFrame,
    passports: DataFrame,
    apps: DataFrame,
    payments: DataFrame,
    **skew,
) -> DataFrame:
    """One row per user and passport: application history, retention, spend, expatriate flag.

    Application and payment history are combined in a single pass: successful payments are
    reduced to one row per application, attached to it, and grouped by user once.
    """
    status = F.col("status")
    spend = payments.where("is_successful").groupBy("application_id").agg(
        _rows().alias("n"), F.count("amount").alias("n_amount"), F.sum("amount").alias("spent")
    )
    history = (
        join_one(
            apps.select("application_id", "user_id", "status", "application_date", "country_id", "visa_type_id"),
            spend,
            "application_id",
        )
        .groupBy("user_id")
        .agg(
            _rows().alias("total_applications"),
            count_where(status == "Approved").alias("approved_applications"),
            count_where(status == "Rejected").alias("rejected_applications"),
            count_where(status == "Cancelled").alias("cancelled_applications"),
            count_where(status == "Pending").alias("pending_applications"),
            F.min("application_date").alias("first_application_date"),
            F.max("application_date").alias("last_application_date"),
            F.count_distinct("country_id").alias("countries_applied_to"),
            F.count_distinct("visa_type_id").alias("visa_types_applied"),
            F.sum("n").alias("total_payments"),
            F.sum("spent").alias("spent"),
            exact_avg(F.sum("spent"), F.sum("n_amount")).alias("avg_payment_amount"),
        )
    )
    people = join_one(
        users.select(
            "user_id", "full_name", "email", "country", "age", "age_group", "signup_date",
            "days_since_signup", "verification_status", "device_type", "acquisition_channel",
        ),
        history,
        "user_id",
    )
    rows = join_many(
        people, passports.select("passport_id", "user_id", "issuing_country"), "user_id", "passport_id",
        **skew,
    )

    def count_or_zero(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).alias(name)

    spent = F.col("spent")
    return rows.select(
        "user_id", "full_name", "email",
        F.col("country").alias("residence_country"),
        F.col("issuing_country").alias("nationality"),
        "age", "age_group", "signup_date",
        F.year("signup_date").alias("signup_year"),
        F.month("signup_date").alias("signup_month"),
        F.quarter("signup_date").alias("signup_quarter"),
        "days_since_signup", "verification_status", "device_type", "acquisition_channel",
        *[
            count_or_zero(c)
            for c in (
                "total_applications", "approved_applications", "rejected_applications",
                "cancelled_applications", "pending_applications",
            )
        ],
        "first_application_date", "last_application_date",
        F.date_diff("first_application_date", "signup_date").alias("days_to_first_application"),
        flag(F.col("total_applications") >= 2).alias("is_repeat_applicant"),
        flag(F.col("total_applications") >= 5).alias("is_power_user"),
        count_or_zero("countries_applied_to"), count_or_zero("visa_types_applied"),
        count_or_zero("total_payments"),
        F.coalesce(spent, F.lit(0)).alias("total_spent"),
        "avg_payment_amount",
        F.when(spent > 0, bucketize(spent, ">=", VALUE_BANDS, "Low Value"))
        .otherwise("No Spend")
        .alias("user_value_segment"),
        flag(F.col("country") != F.col("issuing_country")).alias("is_expatriate"),
    )


# --- operations ---------------------------------------------------------------------------


def _weekly_documents(docs: DataFrame, owners: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Documents by destination and upload week, combined per application first."""
    speed = F.col("verification_speed")
    per_application = docs.groupBy("application_id", week_start("upload_time").alias("week")).agg(
        _rows().alias("n"),
        count_where(F.col("is_verified")).alias("verified"),
        F.sum("verification_hours").alias("hours"),
        F.count("verification_hours").alias("n_hours"),
        count_where(speed == FAST).alias("fast"),
        count_where(speed == STANDARD).alias("standard"),
        count_where(speed == SLOW).alias("slow"),
    )
    return per_application.join(owners, "application_id").groupBy(*dims).agg(
        F.sum("n").alias("total_documents"),
        F.sum("verified").alias("verified_documents"),
        stable_round(F.try_divide(F.sum("hours"), F.sum("n_hours"))).alias("avg_verification_hours"),
        F.sum("fast").alias("fast_verifications"),
        F.sum("standard").alias("standard_verifications"),
        F.sum("slow").alias("slow_verifications"),
    )


def _weekly_tickets(tickets: DataFrame, owners: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Tickets by destination and week.  Tickets without an application have no destination and
    can match no application group, so they are left out before the shuffle."""
    speed, week = F.col("resolution_speed"), week_start("created_at").alias("week")
    made = [F.year("created_at").alias("ticket_year"), F.month("created_at").alias("ticket_month")]
    per_application = (
        tickets.where(F.col("application_id").isNotNull())
        .groupBy("application_id", week, *made)
        .agg(
            _rows().alias("n"),
            count_where(F.col("is_resolved")).alias("resolved"),
            count_where(F.col("is_high_priority_open")).alias("urgent"),
            F.sum("resolution_time_hours").alias("hours"),
            F.count("resolution_time_hours").alias("n_hours"),
            count_where(speed == "Immediate (<4h)").alias("immediate"),
            count_where(speed == FAST).alias("fast"),
        )
    )
    return per_application.join(owners, "application_id").groupBy(*dims).agg(
        F.sum("n").alias("total_tickets"),
        F.sum("resolved").alias("resolved_tickets"),
        F.sum("urgent").alias("high_priority_open"),
        stable_round(F.try_divide(F.sum("hours"), F.sum("n_hours"))).alias("avg_resolution_hours"),
        F.sum("immediate").alias("immediate_resolutions"),
        F.sum("fast").alias("fast_resolutions"),
    )


def operational_metrics(
    apps: DataFrame,
    docs: DataFrame,
    tickets: DataFrame,
    countries: DataFrame,
    visa_types: DataFrame,
    rollup: bool = False,
) -> DataFrame:
    """Weekly SLA measures of completed applications, their documents and tickets.

    By default documents and tickets keep the month in their grain but are matched by week, so a
    week that spans two months repeats a row.  ``rollup=True`` groups them by the join key only
    and gives exactly one row per application group.
    """
    key = ["country_id", "visa_type_id", "week"]
    month = ["application_year", "application_month"]
    late, status = F.col("is_late_completion"), F.col("status")
    weekly = (
        apps.where("is_completed")
        .groupBy("country_id", "visa_type_id", *month, week_start("application_date").alias("week"))
        .agg(
            _rows().alias("total_applications"),
            count_where(status == "Approved").alias("approved_count"),
            count_where(status == "Rejected").alias("rejected_count"),
            count_where(late).alias("late_completions"),
            rounded_avg("processing_days_actual").alias("avg_processing_days"),
            rounded_avg("processing_days_expected").alias("avg_expected_days"),
        )
    )
    owners = apps.select("application_id", "country_id", "visa_type_id", *month)
    documents = _weekly_documents(docs, owners, key if rollup else key + month)
    support = _weekly_tickets(tickets, owners, key if rollup else [*key, "ticket_year", "ticket_month"])
    measures = weekly.join(documents.drop(*month), key, "left").join(
        support.drop("ticket_year", "ticket_month"), key, "left"
    )
    named = join_dim(measures, countries, "country_id", ["country_name"])
    named = join_dim(named, visa_types, "visa_type_id", ["visa_type_name"])
    n = F.col("total_applications")
    return named.select(
        "country_id", "country_name", "visa_type_id", "visa_type_name", *month,
        F.col("week").alias("application_week"),
        n, "approved_count", "rejected_count",
        pct(F.col("approved_count"), n).alias("approval_rate"),
        "late_completions",
        pct(F.col("late_completions"), n).alias("late_completion_pct"),
        pct(n - F.col("late_completions"), n).alias("on_time_pct"),
        "avg_processing_days", "avg_expected_days",
        stable_round(F.col("avg_processing_days") - F.col("avg_expected_days")).alias("avg_delay_days"),
        F.coalesce("total_documents", F.lit(0)).alias("total_documents"),
        F.coalesce("verified_documents", F.lit(0)).alias("verified_documents"),
        pct(F.col("verified_documents"), F.col("total_documents")).alias("document_verification_rate"),
        "avg_verification_hours", "fast_verifications", "standard_verifications", "slow_verifications",
        F.coalesce("total_tickets", F.lit(0)).alias("total_tickets"),
        F.coalesce("resolved_tickets", F.lit(0)).alias("resolved_tickets"),
        pct(F.col("resolved_tickets"), F.col("total_tickets")).alias("ticket_resolution_rate"),
        "high_priority_open", "avg_resolution_hours", "immediate_resolutions", "fast_resolutions",
    )


def operational_weekly(apps: DataFrame, countries: DataFrame, visa_types: DataFrame) -> DataFrame:
    """All applications by week, country and visa type."""
    grouped = apps.groupBy("country_id", "visa_type_id", week_start("application_date").alias("application_week")).agg(
        _rows().alias("total_applications"),
        rounded_avg("processing_days_actual").alias("avg_processing_days"),
        F.round(F.avg(F.when(F.col("is_late_completion"), 100.0).otherwise(0.0)), 2).alias("avg_late_pct"),
        count_where(F.col("status").isin("Approved", "Rejected")).alias("completed_count"),
    )
    named = join_dim(grouped, countries, "country_id", ["country_name"])
    named = join_dim(named, visa_types, "visa_type_id", ["visa_type_name"])
    return named.select(
        "application_week", "country_name", "visa_type_name", "total_applications",
        "avg_processing_days", "avg_late_pct", "completed_count",
    )


# --- abandoned applications ---------------------------------------------------------------


def abandoned_applications(
    apps: DataFrame,
    events: DataFrame,
    countries: DataFrame,
    visa_types: DataFrame,
    as_of=None,
    statuses: Sequence[str] = ("Pending", "Cancelled"),
) -> DataFrame:
    """Unfinished applications, one row each, with last event, age and recovery class."""
    now = as_time(as_of)
    # Event histories are reduced to a row per application and type (hash aggregation, combined map-side);
    # event_id settles equal times.
    history = Window.partitionBy("application_id")
    activity = (
        newest_by(events, "application_id", "event_time", "event_id", ["event_type"])
        .withColumns({
            "total_events": F.sum("_rows").over(history),
            "unique_event_types": F.count("event_type").over(history),
        })
        .where(F.col("_place") == 1)
        .select(
            "application_id", "total_events", "unique_event_types",
            F.col("event_type").alias("last_stage_reached"),
            time_of(F.col("_moment"), events.schema["event_time"].dataType).alias("time_of_last_activity"),
        )
    )
    open_apps = apps.where(F.col("status").isin(*statuses)).select(
        "application_id", "user_id", "country_id", "visa_type_id", "application_date", "travel_date",
        "status", "status_category", "source", "platform", "application_year",
        "application_month", "application_quarter",
    )
    carts = join_one(open_apps, activity, "application_id")
    carts = join_dim(carts, countries, "country_id", ["country_name", "visa_fee_usd"])
    carts = join_dim(carts, visa_types, "visa_type_id", ["visa_type_name"])
    carts = carts.withColumn(
        "days_since_last_activity", days_elapsed("time_of_last_activity", now)
    ).withColumn("days_pending", days_elapsed("application_date", now))
    idle, age, status = F.col("days_since_last_activity"), F.col("days_pending"), F.col("status")
    recovery = (
        F.when((status == "Pending") & (idle <= 7), "High Recovery Potential")
        .when((status == "Pending") & (idle <= 30), "Medium Recovery Potential")
        .when((status == "Cancelled") & (age <= 30), "Reactivation Opportunity")
        .otherwise("Low Recovery Potential")
    )
    return carts.select(
        "application_id", "user_id", "country_id", "country_name", "visa_type_id", "visa_type_name",
        "application_date", "travel_date", "status", "status_category", "source", "platform",
        "last_stage_reached", "time_of_last_activity", "days_since_last_activity",
        "total_events", "unique_event_types", "days_pending",
        bucketize("days_pending", ">", AGING_BANDS, "Low (<7d)").alias("aging_priority"),
        only_if(status == "Cancelled", "last_stage_reached").alias("cancelled_after_stage"),
        recovery.alias("recovery_opportunity"),
        F.col("visa_fee_usd").alias("potential_revenue"),
        "application_year", "application_month", "application_quarter",
    )


def abandoned_carts(
    apps: DataFrame,
    events: DataFrame,
    payments: DataFrame,
    countries: DataFrame,
    visa_types: DataFrame,
    as_of=None,
    statuses: Sequence[str] = ("Pending", "Cancelled"),
    **skew,
) -> DataFrame:
    """Unfinished applications with their payment attempts: one row per application and payment,
    one row for an application without payment."""
    attempts = payments.select(
        "application_id", "payment_id", "payment_method", F.col("status").alias("payment_attempt_status")
    )
    carts = abandoned_applications(apps, events, countries, visa_types, as_of, statuses)
    paid = F.when(F.col("payment_id").isNotNull(), "Has Payment").otherwise("No Payment")
    return (
        join_many(carts, attempts, "application_id", "payment_id", **skew)
        .withColumn("payment_status", paid)
        .drop("payment_id")
    )


def abandoned_rollup(carts: DataFrame) -> DataFrame:
    """Abandoned applications (one row each) by last stage and recovery class."""
    return carts.groupBy("last_stage_reached", "recovery_opportunity").agg(
        _rows().alias("total_abandoned"),
        F.sum("potential_revenue").alias("total_potential_revenue"),
        rounded_avg("days_since_last_activity").alias("avg_days_since_abandonment"),
    )


# Recovery tier of the last stage.
RECOVERY_TIERS = {
    "Payment Initiated": "High",
    "Documents Submitted": "Medium",
    "Verification Started": "Low",
    "Cancelled": "Low",
}


def recovery_tier(carts: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Carts with a recovery tier.  A payment attempt is a stage of its own, above any event; a
    stage outside the mapping (also no event at all) is "Low"."""
    stage = F.when(F.col("payment_status") == "Has Payment", "Payment Initiated").otherwise(
        F.col("last_stage_reached")
    )
    tier = F
    for name, label in (mapping or RECOVERY_TIERS).items():
        tier = tier.when(F.col("recovery_stage") == name, label)
    return carts.withColumn("recovery_stage", stage).withColumn("recovery_tier", tier.otherwise("Low"))


# --- documents and support ----------------------------------------------------------------


def document_friction(
    apps: DataFrame, docs: DataFrame, countries: DataFrame, visa_types: DataFrame
) -> DataFrame:
    """Applications with documents: verification measures, friction flags, late completion."""
    speed = F.col("verification_speed")
    stats = docs.groupBy("application_id").agg(
        _rows().alias("document_count"),
        count_where(F.col("is_verified")).alias("verified_count"),
        rounded_avg("verification_hours").alias("avg_verification_hours"),
        F.max("verification_hours").alias("max_verification_hours"),
        count_where(speed == FAST).alias("fast_verifications"),
        count_where(speed == SLOW).alias("slow_verifications"),
        count_where(speed == "Pending").alias("pending_verifications"),
    )
    rows = stats.join(apps, "application_id")
    rows = join_dim(rows, countries, "country_id", ["country_name"])
    rows = join_dim(rows, visa_types, "visa_type_id", ["visa_type_name"])
    low_rate = flag(F.col("verified_count") * 2 < F.col("document_count"))
    slow = F.col("slow_verifications") > 0
    return rows.select(
        "application_id", "user_id", "country_id", "country_name", "visa_type_id", "visa_type_name",
        F.col("status").alias("application_status"), "status_category", "is_late_completion",
        "processing_days_actual", "processing_days_expected",
        "document_count", "verified_count",
        pct(F.col("verified_count"), F.col("document_count")).alias("verification_rate"),
        "avg_verification_hours", "max_verification_hours", "fast_verifications",
        "slow_verifications", "pending_verifications",
        low_rate.alias("has_low_verification_rate"),
        slow.alias("has_slow_verifications"),
        (F.col("pending_verifications") > 0).alias("has_pending_verifications"),
        flag((low_rate | slow) & F.col("is_late_completion")).alias("friction_caused_delay"),
        "application_year", "application_month",
    )


def ticket_impact(
    tickets: DataFrame,
    apps: DataFrame,
    users: DataFrame,
    reviews: DataFrame,
    as_of=None,
    **skew,
) -> DataFrame:
    """Tickets with the state of their application, the user's review of it and impact flags.
    One row per ticket and review."""
    linked = apps.select(
        "application_id", F.col("status").alias("linked_application_status"),
        F.col("status_category").alias("linked_application_category"), "application_date",
        "completed_date", F.col("country_id").alias("application_country_id"),
    )
    opinions = reviews.select(
        "review_id", "application_id", "user_id", F.col("rating").alias("user_rating"), "review_text"
    )
    people = users.select("user_id", F.col("country").alias("user_country"))
    rows = join_one(tickets, linked, "application_id", spread_on="ticket_id", **skew)
    rows = join_one(rows, people, "user_id", spread_on="ticket_id", **skew)
    rows = join_many(rows, opinions, ["application_id", "user_id"], "review_id", **skew)

    state, made = F.col("linked_application_status"), F.col("created_at")
    finished = F.col("completed_date").cast("timestamp_ntz")
    open_until = F.coalesce(finished, as_time(as_of).cast("timestamp_ntz"))
    before_cancellation = flag((state == "Cancelled") & (made <= finished))
    context = (
        F.when(
            (state == "Pending") & made.between(F.col("application_date").cast("timestamp_ntz"), open_until),
            "Pending During Ticket",
        )
        .when(before_cancellation, "Cancelled After Ticket")
        .when(state.isin("Approved", "Rejected"), state)
        .otherwise("Other")
    )
    return rows.select(
        "ticket_id", "user_id", "application_id",
        F.col("category").alias("ticket_category"), F.col("priority").alias("ticket_priority"),
        F.col("status").alias("ticket_status"), made.alias("ticket_created_at"),
        F.col("resolved_at").alias("ticket_resolved_at"), "is_resolved", "resolution_time_hours",
        "resolution_speed", "is_high_priority_open", "open_ticket_age_hours",
        "linked_application_status", "linked_application_category", "application_date",
        context.alias("application_status_context"), "user_rating", "review_text",
        before_cancellation.alias("ticket_before_cancellation"),
        flag(~F.col("is_resolved") & F.col("is_high_priority_open")).alias("unresolved_high_priority"),
        flag(F.col("resolution_time_hours") > 72).alias("slow_resolution"),
        flag(F.col("user_rating") <= 2).alias("negative_review_after_ticket"),
        "user_country", "application_country_id", "created_year", "created_month", "created_quarter",
    )


# --- overview -----------------------------------------------------------------------------


def kpi_overview(apps: DataFrame, payments: DataFrame) -> DataFrame:
    """One row of headline figures; revenue counts successful payments."""
    revenue = payments.where("is_successful").agg(F.sum("amount")).scalar()
    return apps.agg(
        _rows().alias("total_applications"),
        pct(count_where(F.col("is_late_completion")), _rows()).alias("late_completion_rate"),
        rounded_avg("processing_days_actual").alias("avg_processing_days"),
    ).select(
        "total_applications", revenue.alias("total_revenue"),
        F.col("late_completion_rate").cast("decimal(5,2)").alias("late_completion_rate"),
        "avg_processing_days",
    )
