"""Business metrics on top of the silver and gold tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    as_time,
    count_where,
    exact_avg,
    hours_elapsed,
    month_start,
    pct,
    rounded_avg,
    sum_where,
    threshold_status,
)
from ..operators.grouping import group_with_share, top_k_with_other, trend
from ..operators.joins import join_dim, join_one
from ..operators.metric_view import MetricView, plain_dims
from ..operators.states import distinct_from_state, distinct_state, histogram_state, quantile_from_state

# Statuses counted as abandoned.
ABANDONED = ("Pending", "Cancelled")


def _rows() -> Column:
    return F.count(F.lit(1))


def revenue_view(cube: DataFrame) -> MetricView:
    """Metric view over the revenue cube.

    ``avg_transaction_value`` averages the averages of the cells, as the metric is defined;
    ``weighted_avg_value`` divides revenue by transactions.
    """
    ok, failed = F.sum("successful_payments"), F.sum("failed_payments")
    dims = plain_dims(
        "payment_year", "payment_month", "payment_quarter", "country_name", "visa_type_name",
        "payment_method", "payment_gateway",
    )
    dims["payment_month_date"] = month_start("payment_year", "payment_month")
    return MetricView(
        cube,
        dims,
        {
            "total_revenue": F.sum("total_revenue"),
            "total_transactions": F.sum("total_transactions"),
            "successful_payments": ok,
            "failed_payments": failed,
            "avg_transaction_value": rounded_avg("avg_transaction_value", 4),
            "weighted_avg_value": exact_avg(F.sum("total_revenue"), F.sum("total_transactions")),
            "payment_success_rate": pct(ok, ok + failed),
        },
    )


# --- distinct users at any grain ----------------------------------------------------------

# The periods that months add up to.
PERIODS = {
    "month": ("application_year", "application_quarter", "application_month"),
    "quarter": ("application_year", "application_quarter"),
    "year": ("application_year",),
    "all": (),
}


def applicant_state(apps: DataFrame, dims: Sequence[str] = ("country_id",)) -> DataFrame:
    """Who applied in which month (and ``dims``), as bitmaps: a state to store."""
    return distinct_state(apps, [*PERIODS["month"], *dims], "user_id")


def applicants(state: DataFrame, period: str, dims: Sequence[str] = ()) -> DataFrame:
    """Distinct applicants by period (and ``dims``) from the stored ``applicant_state``: exact, though users come again."""
    return distinct_from_state(state, [*PERIODS[period], *dims], "applicants")


# --- rates --------------------------------------------------------------------------------


def payment_success_rate(payments: DataFrame) -> DataFrame:
    ok = count_where(F.col("is_successful"))
    return payments.agg(
        ok.alias("successful_payments"),
        count_where(~F.col("is_successful")).alias("failed_payments"),
        pct(ok, F.count("is_successful")).alias("payment_success_rate"),
    )


def late_completion_rate(apps: DataFrame) -> DataFrame:
    """By completion date and by number of days."""
    return apps.agg(
        _rows().alias("applications"),
        pct(count_where(F.col("is_late_completion")), _rows()).alias("late_completion_rate"),
        pct(count_where(F.col("late_by_days")), _rows()).alias("late_by_days_rate"),
    )


def abandonment_rate(apps: DataFrame, statuses: Sequence[str] = ABANDONED) -> DataFrame:
    gone = count_where(F.col("status").isin(*statuses))
    return apps.agg(
        _rows().alias("applications"), gone.alias("abandoned"), pct(gone, _rows()).alias("abandonment_rate")
    )


def revenue_at_risk(apps: DataFrame, countries: DataFrame, statuses: Sequence[str] = ABANDONED) -> DataFrame:
    """Fees of abandoned applications; the fee belongs to the destination country."""
    per_country = apps.groupBy("country_id").agg(
        _rows().alias("applications"), count_where(F.col("status").isin(*statuses)).alias("abandoned")
    )
    fees = join_dim(per_country, countries, "country_id", ["visa_fee_usd"])
    return fees.agg(
        F.sum("applications").alias("applications"),
        F.sum("abandoned").alias("abandoned"),
        F.sum(F.col("abandoned") * F.col("visa_fee_usd")).alias("revenue_at_risk"),
    )


# --- breakdowns and trends ----------------------------------------------------------------


def revenue_breakdown(cube: DataFrame, dims: Sequence[str | Column]) -> DataFrame:
    """Successful revenue and its share by any dimensions of the revenue cube."""
    measures = {"revenue": F.sum("successful_revenue"), "transactions": F.sum("total_transactions")}
    return group_with_share(cube, dims, measures, "revenue", "revenue_pct")


def revenue_top(cube: DataFrame, dim: str, k: int = 5) -> DataFrame:
    """The k members with most successful revenue and the rest as "Other", with shares."""
    return top_k_with_other(cube, dim, "successful_revenue", k, share="revenue_pct")


def application_trend(apps: DataFrame, dims: Sequence[str | Column]) -> DataFrame:
    """Volume, processing time and late share by any dimension or period."""
    return trend(
        apps,
        dims,
        {
            "applications": _rows(),
            "avg_processing_days": rounded_avg("processing_days_actual"),
            "late_pct": pct(count_where(F.col("is_late_completion")), _rows()),
        },
    )


def approval_trend(apps: DataFrame, period: Column) -> DataFrame:
    """Decided applications, approval rate and open applications by period."""
    status = F.col("status")
    approved, rejected = count_where(status == "Approved"), count_where(status == "Rejected")
    return trend(
        apps,
        [period],
        {
            "applications": _rows(),
            "approved": approved,
            "rejected": rejected,
            "in_progress": count_where(status == "Pending"),
            "approval_rate": pct(approved, approved + rejected),
        },
    )


# Alert limits.
LATE_RULES = [(60, "red")]
PROCESSING_RULES = [(20, "escalate")]
HEALTH_RULES = [(90, "green"), (75, "amber")]


def kpi_status(df: DataFrame, late: str, days: str, health: str) -> DataFrame:
    """Alert labels: late share above 60 red, processing above 20 days escalate, health green
    from 90 and amber from 75."""
    return df.withColumns(
        {
            "late_status": threshold_status(late, ">", LATE_RULES, "ok"),
            "processing_status": threshold_status(days, ">", PROCESSING_RULES, "ok"),
            "health_status": threshold_status(health, ">=", HEALTH_RULES, "red"),
        }
    )


def ops_kpis(apps: DataFrame, payments: DataFrame) -> DataFrame:
    """Revenue per application and applications in progress."""
    revenue = payments.where("is_successful").agg(F.coalesce(F.sum("amount"), F.lit(0))).scalar()
    return (
        apps.agg(
            _rows().alias("applications"), count_where(F.col("status") == "Pending").alias("in_progress")
        )
        .withColumn("revenue", revenue)
        .withColumn("revenue_per_application", exact_avg(F.col("revenue"), F.col("applications")))
    )


def abandonment_by(apps: DataFrame, dims: Sequence[str | Column], statuses: Sequence[str] = ABANDONED) -> DataFrame:
    """Abandonment by stage, country, visa type or period."""
    gone = count_where(F.col("status").isin(*statuses))
    return trend(
        apps, dims, {"applications": _rows(), "abandoned": gone, "abandonment_rate": pct(gone, _rows())}
    )


# Steps of the funnel and the stage times between which they run.
STEPS = (
    ("created to documents", "created_at", "docs_uploaded_at"),
    ("documents to review", "docs_uploaded_at", "under_review_at"),
    ("review to approval", "under_review_at", "approved_at"),
    ("created to approval", "created_at", "approved_at"),
)


def _steps(funnel: DataFrame, *by: str) -> DataFrame:
    steps = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("step"), hours_elapsed(start, end).alias("hours"))
                for name, start, end in STEPS
            ]
        )
    ).alias("s")
    return funnel.select(*by, steps).where("s.hours IS NOT NULL")


def stage_hours(funnel: DataFrame, by: Sequence[str] = ("country_id", "visa_type_id")) -> DataFrame:
    """How many applications spent how many hours in each step, by ``by``: a state to store, from which
    ``stage_medians`` answers at any coarser grain."""
    return histogram_state(_steps(funnel, *by).select(*by, "s.step", "s.hours"), [*by, "step"], "hours")


def stage_medians(hours: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Applications and median hours of each step from the stored ``stage_hours``."""
    return quantile_from_state(hours, [*by, "step"], 0.5, "median_hours").withColumnRenamed("rows", "applications")


def stage_durations(funnel: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Hours spent in each step: where is the bottleneck."""
    return (
        _steps(funnel, *by)
        .groupBy(*by, F.col("s.step").alias("step"))
        .agg(
            _rows().alias("applications"),
            rounded_avg("s.hours").alias("avg_hours"),
            # exact at any group size: Spark keeps one count per distinct hour
            F.expr("CAST(percentile_disc(0.5) WITHIN GROUP (ORDER BY s.hours) AS BIGINT)").alias("median_hours"),
            F.min("s.hours").alias("min_hours"),
            F.max("s.hours").alias("max_hours"),
        )
    )


def pending_ageing(carts: DataFrame) -> DataFrame:
    """Open and cancelled applications by age class, with the share of the whole."""
    status = F.col("status")
    measures = {
        "applications": _rows(),
        "pending": count_where(status == "Pending"),
        "cancelled": count_where(status == "Cancelled"),
        "cancelled_pct": pct(count_where(status == "Cancelled"), _rows()),
    }
    return group_with_share(carts, ["aging_priority"], measures, "applications", "pct_of_total")


def cohort_summary(cohorts: DataFrame, dim: str) -> DataFrame:
    """Users, repeat applicants, spend and expatriates by any cohort dimension."""
    repeat = count_where(F.col("is_repeat_applicant"))
    return trend(
        cohorts,
        [dim],
        {
            "members": _rows(),
            "repeat_applicants": repeat,
            "repeat_pct": pct(repeat, _rows()),
            "power_users": count_where(F.col("is_power_user")),
            "expatriates": count_where(F.col("is_expatriate")),
            "applications": F.sum("total_applications"),
            "total_spent": F.sum("total_spent"),
            "avg_days_to_first_application": rounded_avg("days_to_first_application"),
        },
    )


def payment_health(cube: DataFrame, dims: Sequence[str | Column]) -> DataFrame:
    """Success rate and average values by gateway, method or visa type."""
    ok, failed = F.sum("successful_payments"), F.sum("failed_payments")
    return trend(
        cube,
        dims,
        {
            "successful_payments": ok,
            "failed_payments": failed,
            "success_rate": pct(ok, ok + failed),
            "avg_value": exact_avg(F.sum("total_revenue"), F.sum("total_transactions")),
            "revenue_lost": F.sum("revenue_lost_to_failed_payments"),
        },
    )


# Reminder delays in hours.
REMINDERS = [(168, "7d"), (72, "72h"), (24, "24h")]


def recovery_targets(carts: DataFrame, min_fee, as_of=None, reminders: Iterable[tuple[int, str]] = REMINDERS) -> DataFrame:
    """Abandoned applications above a fee, with the latest reminder that is due."""
    idle = F.coalesce("time_of_last_activity", F.col("application_date").cast("timestamp_ntz"))
    rows = carts.where(F.col("potential_revenue") > F.lit(min_fee)).withColumn(
        "idle_hours", hours_elapsed(idle, as_time(as_of))
    )
    due = F
    for hours, label in reminders:
        due = due.when(F.col("idle_hours") >= hours, label)
    return rows.select(
        "application_id", "user_id", "country_name", "potential_revenue", "last_stage_reached",
        "idle_hours", due.otherwise("not due").alias("reminder_due"),
    )


def retry_due(payments: DataFrame, as_of=None, after_hours: int = 24, **skew) -> DataFrame:
    """Failed payments with no later success of the same application and a day gone by."""
    last_success = payments.where("is_successful").groupBy("application_id").agg(
        F.max("payment_time").alias("last_success")
    )
    failed = payments.where(~F.col("is_successful")).select(
        "payment_id", "application_id", "amount", "payment_method", "payment_gateway", "payment_time"
    )
    rows = join_one(failed, last_success, "application_id", spread_on="payment_id", **skew)
    waited = hours_elapsed("payment_time", as_time(as_of))
    later = F.coalesce(F.col("last_success") > F.col("payment_time"), F.lit(False))
    return rows.where(~later & (waited >= after_hours)).select(
        "payment_id", "application_id", "amount", "payment_method", "payment_gateway", "payment_time",
        waited.alias("hours_since_failure"),
    )
