"""Integer columns that may be missing.

Engines hand such columns to the outside in different types (a nullable integer here, a double
with NaN there), so both sides of a comparison present them as double.
"""

OPTIONAL_NUMBERS: dict[str, tuple[str, ...]] = {
    "silver_users": ("age",),
    "silver_applications": ("processing_days_actual",),
    "silver_tickets": ("application_id",),
    "silver_rates": ("high_priority_open",),
    "dq_history": ("previous_issue_count", "new_issues"),
    "row_count_delta": ("previous_value",),
    "application_funnel": (
        "hours_created_to_approved", "hours_docs_to_review", "hours_review_to_approval",
        "hours_to_docs_upload", "processing_days_actual",
    ),
    "application_funnel_bucketed": (
        "hours_created_to_approved", "hours_docs_to_review", "hours_review_to_approval",
        "hours_to_docs_upload", "processing_days_actual",
    ),
    "user_cohorts": ("age", "days_to_first_application"),
    "operational_metrics": (
        "fast_resolutions", "fast_verifications", "high_priority_open", "immediate_resolutions",
        "slow_verifications", "standard_verifications",
    ),
    "operational_metrics_rollup": (
        "fast_resolutions", "fast_verifications", "high_priority_open", "immediate_resolutions",
        "slow_verifications", "standard_verifications",
    ),
    "abandoned_carts": ("days_since_last_activity", "total_events", "unique_event_types"),
    "document_friction": ("processing_days_actual",),
    "ticket_impact": ("application_country_id", "application_id", "user_rating"),
    "first_payment_per_application": ("payment_id",),
}
