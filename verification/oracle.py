"""The registered queries once more, as SQL for DuckDB over the generic test tables.

Written independently of the Spark plans: windows and plain joins where the plans use aggregates
and pre-aggregation, integer arithmetic where they use decimals.  Named parts are chained as
common table expressions; every query pulls in only the parts it needs.
"""

from __future__ import annotations

import re

from .columns import OPTIONAL_NUMBERS

AS_OF = "TIMESTAMP '2001-08-07 00:00:00'"
EMAIL = r"'^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$'"


def r(expression: str, digits: int = 2) -> str:
    """Round half up on the decimal value."""
    return f"CAST(round(CAST(({expression}) AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def share(part: str, whole: str, digits: int = 2) -> str:
    return r(f"CAST({part} AS DOUBLE) * 100 / nullif({whole}, 0)", digits)


def money_avg(total: str, rows: str) -> str:
    """Average of a two-digit amount in whole cents."""
    cents = f"CAST(({total}) * 100 AS HUGEINT)"
    n = f"nullif({rows}, 0)"
    return f"(CAST((2 * {cents} + {n}) // (2 * {n}) AS DOUBLE) / 100)"


def n_if(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def dbl(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def txt(expression: str) -> str:
    return f"CAST({expression} AS VARCHAR)"


def i32(expression: str) -> str:
    return f"CAST({expression} AS INTEGER)"


PARTS: dict[str, str] = {}

# --- raw ----------------------------------------------------------------------------------

PARTS["raw_countries"] = """
SELECT n_nationkey AS country_id, n_name AS country_name, r_name AS continent,
       CAST(20 + (n_nationkey * 7) % 166 AS DECIMAL(10,2)) AS visa_fee_usd, 'USD' AS currency,
       CAST(3 + n_nationkey % 20 AS INTEGER) AS processing_days,
       CAST(0.40 + (n_nationkey % 12) * 0.05 AS DECIMAL(4,2)) AS approval_rate
FROM nation JOIN region ON n_regionkey = r_regionkey"""

PARTS["raw_visa_types"] = """
SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS visa_type_id,
       substr(o_orderpriority, 3) AS visa_type_name
FROM orders"""

PARTS["raw_airports"] = """
SELECT s_suppkey AS airport_id, s_name AS airport_name, s_nationkey AS country_id FROM supplier"""

PARTS["raw_users"] = """
SELECT c_custkey AS user_id, ' ' || substr(c_name, 1, 8) || ' ' AS first_name, substr(c_name, 10) AS last_name,
       CASE WHEN c_custkey % 50 = 0 THEN 'bad-' || CAST(c_custkey AS VARCHAR)
            ELSE ' User' || CAST(c_custkey AS VARCHAR) || '@Example.com ' END AS email,
       '+1' || CAST(c_custkey AS VARCHAR) AS phone,
       CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       CASE WHEN c_custkey % 211 <> 0 THEN DATE '1945-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER) END AS dob,
       DATE '1994-01-01' + CAST((c_custkey * 11) % 2500 AS INTEGER) AS signup_date,
       n_name AS country, 'City' || CAST(c_custkey % 40 AS VARCHAR) AS city,
       CASE WHEN c_custkey % 2 = 0 THEN 'Mobile' ELSE 'Desktop' END AS device_type,
       ['iOS', 'Android', 'Windows'][CAST(c_custkey % 3 AS INTEGER) + 1] AS os,
       c_mktsegment AS acquisition_channel, c_custkey % 3 <> 0 AS is_verified
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

PARTS["raw_passports"] = """
SELECT c_custkey AS passport_id, c_custkey AS user_id, n_name AS issuing_country
FROM customer JOIN nation ON n_nationkey = (c_nationkey + CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END) % 25
UNION ALL
SELECT c_custkey + 1000000, c_custkey, n_name
FROM customer JOIN nation ON n_nationkey = (c_nationkey + 2) % 25 WHERE c_custkey % 25 = 0"""

PARTS["one_arrival"] = """
SELECT o_orderkey AS application_id, CASE WHEN o_orderkey % 500 <> 499 THEN o_custkey END AS user_id,
       c_nationkey AS country_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS visa_type_id,
       o_custkey AS passport_id,
       CASE WHEN o_orderkey % 997 <> 996 THEN CAST(o_orderdate AS DATE) END AS application_date,
       CAST(o_orderdate AS DATE) + CAST(20 + o_orderkey % 90 AS INTEGER) AS travel_date,
       CASE WHEN o_orderstatus = 'F' THEN 'Approved' WHEN o_orderstatus = 'O' THEN 'Pending'
            WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'Rejected' ELSE 'Cancelled' END AS status,
       CAST(o_orderdate AS DATE) + CAST(5 + o_custkey % 15 AS INTEGER) AS expected_completion,
       CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + CAST((o_orderkey * 7) % 31 AS INTEGER) END AS completed_date,
       ['web', 'app', 'agent'][CAST(o_orderkey % 3 AS INTEGER) + 1] AS source,
       ['iOS', 'Android', 'Web'][CAST(o_custkey % 3 AS INTEGER) + 1] AS platform
FROM orders JOIN customer ON o_custkey = c_custkey"""

PARTS["raw_applications"] = """
SELECT * FROM one_arrival UNION ALL SELECT * FROM one_arrival WHERE application_id % 200 = 0"""

PARTS["raw_payments"] = """
SELECT l_orderkey * 10 + l_linenumber AS payment_id, l_orderkey AS application_id,
       CASE WHEN l_partkey % 400 = 0 THEN CAST(-1 AS DECIMAL(10,2))
            ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) % 500 AS DECIMAL(10,2)) END AS amount,
       'USD' AS currency,
       ['Credit Card', 'Debit Card', 'PayPal', 'Bank Transfer', 'Apple Pay', 'Google Pay'][CAST(l_suppkey % 6 AS INTEGER) + 1] AS payment_method,
       'gw' || CAST(l_partkey % 5 AS VARCHAR) AS payment_gateway,
       CASE WHEN l_returnflag = 'R' THEN 'Failed' ELSE 'Completed' END AS status,
       CASE WHEN l_partkey % 777 <> 0 THEN l_shipdate + INTERVAL '1' HOUR * (l_suppkey % 24) END AS payment_time,
       l_shipdate AS arrival, l_partkey AS arrival_part, l_suppkey AS arrival_supplier
FROM lineitem"""

PARTS["event_orders"] = """
SELECT event_id, o_orderkey, o_custkey, event_type, value,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
       o_orderdate + INTERVAL '1' SECOND * CAST((event_id % 5) * 86400 + hour(ts) * 3600 + minute(ts) * 60 AS INTEGER) AS event_time
FROM events JOIN orders ON o_orderkey = user_id * 100 + day(ts)"""

PARTS["raw_application_events"] = """
SELECT event_id, o_orderkey AS application_id,
       CASE event_type WHEN 'view' THEN 'Application Created' WHEN 'click' THEN 'Documents Submitted'
            WHEN 'signup' THEN 'Verification Started' WHEN 'purchase' THEN 'Approved'
            ELSE CASE WHEN event_id % 2 = 0 THEN 'Rejected' ELSE 'Cancelled' END END AS event_type,
       event_time
FROM event_orders"""

PARTS["raw_support_tickets"] = """
SELECT event_id AS ticket_id, o_custkey AS user_id,
       CASE WHEN event_id % 7 <> 0 THEN o_orderkey END AS application_id,
       ['Payment', 'Documents', 'Status', 'Technical'][k % 4 + 1] AS category,
       ['High', 'Medium', 'Low'][k % 3 + 1] AS priority,
       CASE WHEN k < 65 THEN 'Resolved' ELSE 'Open' END AS status, event_time AS created_at,
       CASE WHEN k < 65 THEN event_time + INTERVAL '1' SECOND * CAST(floor(value * 3600) AS INTEGER) END AS resolved_at,
       CASE WHEN k < 65 THEN value END AS resolution_time_hours
FROM event_orders WHERE event_type = 'error'"""

PARTS["raw_reviews"] = """
SELECT event_id AS review_id, CASE WHEN event_id % 50 = 0 THEN -1 - event_id ELSE o_orderkey END AS application_id,
       o_custkey AS user_id, CAST(1 + k % 5 AS INTEGER) AS rating, 'review ' || CAST(k AS VARCHAR) AS review_text
FROM event_orders WHERE event_type = 'purchase'"""

PARTS["raw_documents"] = """
SELECT doc_id AS document_id, o_orderkey AS application_id, lang AS document_type,
       coalesce(quality = 1, FALSE) AS verified, o_orderdate + INTERVAL '1' HOUR * CAST(doc_id % 48 AS INTEGER) AS upload_time,
       CASE WHEN quality IS NOT NULL THEN o_orderdate + INTERVAL '1' HOUR * CAST(doc_id % 48 + n_chars % 120 AS INTEGER) END AS verification_time
FROM documents LEFT JOIN labels USING (doc_id) JOIN orders ON o_orderkey = doc_id // 2"""

# --- silver -------------------------------------------------------------------------------

PARTS["silver_countries"] = """
SELECT *, CASE WHEN approval_rate >= 0.75 THEN 'High' WHEN approval_rate >= 0.5 THEN 'Medium' ELSE 'Low' END AS approval_rating,
       CASE WHEN processing_days <= 7 THEN 'Fast' WHEN processing_days <= 14 THEN 'Standard' ELSE 'Slow' END AS processing_speed
FROM raw_countries"""

PARTS["silver_visa_types"] = "SELECT DISTINCT * FROM raw_visa_types"
PARTS["silver_airports"] = "SELECT DISTINCT * FROM raw_airports"
PARTS["silver_passports"] = "SELECT DISTINCT * FROM raw_passports"
PARTS["silver_application_events"] = "SELECT DISTINCT * FROM raw_application_events"
PARTS["silver_reviews"] = "SELECT DISTINCT * FROM raw_reviews"

PARTS["silver_users"] = f"""
WITH tidy AS (
  SELECT * REPLACE (trim(upper(first_name)) AS first_name, trim(upper(last_name)) AS last_name, lower(trim(email)) AS email),
         year({AS_OF}) - year(dob) AS years
  FROM raw_users)
SELECT * EXCLUDE (years), first_name || ' ' || last_name AS full_name, {i32('years')} AS age,
       {i32(f"date_diff('day', signup_date, CAST({AS_OF} AS DATE))")} AS days_since_signup,
       CASE WHEN is_verified THEN 'Verified' ELSE 'Unverified' END AS verification_status,
       CASE WHEN years < 25 THEN '18-24' WHEN years < 35 THEN '25-34' WHEN years < 45 THEN '35-44'
            WHEN years < 55 THEN '45-54' ELSE '55+' END AS age_group
FROM tidy WHERE regexp_full_match(email, {EMAIL})"""

PARTS["silver_applications"] = f"""
SELECT DISTINCT *, {i32("date_diff('day', application_date, travel_date)")} AS days_until_travel,
       {i32("date_diff('day', application_date, completed_date)")} AS processing_days_actual,
       {i32("date_diff('day', application_date, expected_completion)")} AS processing_days_expected,
       {i32('year(application_date)')} AS application_year, {i32('month(application_date)')} AS application_month,
       {i32('quarter(application_date)')} AS application_quarter,
       {i32('dayofweek(application_date) + 1')} AS application_day_of_week,
       CASE status WHEN 'Approved' THEN 'Success' WHEN 'Rejected' THEN 'Failure' WHEN 'Pending' THEN 'In Progress' ELSE 'Other' END AS status_category,
       completed_date IS NOT NULL AS is_completed,
       coalesce(completed_date > expected_completion, FALSE) AS is_late_completion,
       coalesce(completed_date - application_date > expected_completion - application_date, FALSE) AS late_by_days
FROM raw_applications WHERE application_date IS NOT NULL AND user_id IS NOT NULL"""

PARTS["silver_payments"] = f"""
SELECT * EXCLUDE (arrival, arrival_part, arrival_supplier),
       {i32('year(payment_time)')} AS payment_year, {i32('month(payment_time)')} AS payment_month,
       {i32('quarter(payment_time)')} AS payment_quarter, strftime(payment_time, '%Y-%m-%d') AS payment_date,
       {i32('hour(payment_time)')} AS payment_hour,
       CASE WHEN amount < 100 THEN 'Low' WHEN amount < 300 THEN 'Medium' ELSE 'High' END AS payment_amount_category,
       status = 'Completed' AS is_successful
FROM raw_payments WHERE amount > 0 AND payment_time IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY arrival DESC, arrival_part DESC, arrival_supplier DESC) = 1"""

PARTS["silver_documents"] = f"""
WITH timed AS (SELECT DISTINCT *, epoch(verification_time - upload_time) / 3600 AS hours FROM raw_documents)
SELECT * EXCLUDE (hours), verified AS is_verified, {dbl('hours')} AS verification_hours,
       CASE WHEN hours IS NULL THEN 'Pending' WHEN hours <= 24 THEN 'Fast (<24h)' WHEN hours <= 72 THEN 'Standard (24-72h)'
            ELSE 'Slow (>72h)' END AS verification_speed,
       {i32('year(upload_time)')} AS upload_year, {i32('month(upload_time)')} AS upload_month,
       strftime(upload_time, '%Y-%m-%d') AS upload_date
FROM timed"""

PARTS["silver_support_tickets"] = f"""
SELECT DISTINCT *, resolved_at IS NOT NULL AS is_resolved,
       CASE WHEN resolution_time_hours IS NULL THEN 'Open' WHEN resolution_time_hours <= 4 THEN 'Immediate (<4h)'
            WHEN resolution_time_hours <= 24 THEN 'Fast (<24h)' WHEN resolution_time_hours <= 72 THEN 'Standard (24-72h)'
            ELSE 'Slow (>72h)' END AS resolution_speed,
       priority = 'High' AND status <> 'Resolved' AS is_high_priority_open,
       {i32('year(created_at)')} AS created_year, {i32('month(created_at)')} AS created_month,
       {i32('quarter(created_at)')} AS created_quarter, strftime(created_at, '%Y-%m-%d') AS created_date,
       {i32('dayofweek(created_at) + 1')} AS created_day_of_week,
       CASE WHEN resolved_at IS NULL THEN {dbl(f"date_diff('second', created_at, {AS_OF})")} / 3600 END AS open_ticket_age_hours
FROM raw_support_tickets"""

# --- gold ---------------------------------------------------------------------------------

PARTS["stage_rows"] = """
SELECT application_id,
       min(event_time) FILTER (WHERE event_type = 'Application Created') AS created_at,
       min(event_time) FILTER (WHERE event_type = 'Documents Submitted') AS docs_uploaded_at,
       min(event_time) FILTER (WHERE event_type = 'Verification Started') AS under_review_at,
       min(event_time) FILTER (WHERE event_type = 'Approved') AS approved_at,
       min(event_time) FILTER (WHERE event_type = 'Rejected') AS rejected_at,
       min(event_time) FILTER (WHERE event_type = 'Cancelled') AS cancelled_at,
       arg_min(event_type, CASE event_type WHEN 'Approved' THEN 1 WHEN 'Rejected' THEN 2 WHEN 'Cancelled' THEN 3
               WHEN 'Verification Started' THEN 4 WHEN 'Documents Submitted' THEN 5 ELSE 6 END) AS top_event
FROM silver_application_events GROUP BY application_id"""

PARTS["gold_funnel"] = f"""
SELECT a.application_id, a.user_id, a.country_id, a.visa_type_id, a.passport_id,
       s.created_at, s.docs_uploaded_at, s.under_review_at,
       CASE WHEN s.application_id IS NOT NULL THEN p.paid_at END AS paid_at,
       s.approved_at, s.rejected_at, s.cancelled_at, a.application_date, a.travel_date,
       a.status AS final_status, a.status_category, a.completed_date, a.processing_days_actual,
       a.processing_days_expected, a.is_late_completion, a.days_until_travel,
       CASE s.top_event WHEN 'Application Created' THEN 'Created' WHEN 'Documents Submitted' THEN 'Documents Uploaded'
            WHEN 'Verification Started' THEN 'Under Review' ELSE s.top_event END AS stage_reached,
       s.application_id IS NOT NULL AND p.paid_at IS NOT NULL AS has_payment,
       CASE WHEN s.application_id IS NULL THEN 0 ELSE coalesce(p.n, 0) END AS payment_count,
       date_sub('hour', s.created_at, s.docs_uploaded_at) AS hours_to_docs_upload,
       date_sub('hour', s.docs_uploaded_at, s.under_review_at) AS hours_docs_to_review,
       date_sub('hour', s.under_review_at, s.approved_at) AS hours_review_to_approval,
       date_sub('hour', s.created_at, s.approved_at) AS hours_created_to_approved,
       a.source, a.platform, a.application_year, a.application_month, a.application_quarter,
       a.application_date AS application_date_str
FROM silver_applications a
LEFT JOIN stage_rows s USING (application_id)
LEFT JOIN (SELECT application_id, min(payment_time) AS paid_at, count(*) AS n FROM silver_payments
           WHERE is_successful GROUP BY application_id) p USING (application_id)"""

PARTS["gap"] = """
SELECT * FROM silver_applications a
WHERE NOT EXISTS (SELECT 1 FROM silver_payments p WHERE p.application_id = a.application_id)"""

PARTS["gold_recon"] = f"""
WITH counted AS (
  SELECT *, count(*) OVER (PARTITION BY country_id) AS in_country,
         count(*) OVER (PARTITION BY application_year, application_month) AS in_month, count(*) OVER () AS n
  FROM gap WHERE status = 'Approved'),
aged AS (SELECT *, date_sub('day', CAST(completed_date AS TIMESTAMP), {AS_OF}) AS age FROM counted)
SELECT application_id, user_id, country_id, visa_type_id, 'Missing' AS payment_status, visa_fee_usd AS expected_fee,
       processing_days AS expected_processing_days, status, completed_date AS approved_at, application_date,
       country_name, visa_type_name, source, platform,
       in_country AS country_concentration_count, {share('in_country', 'n')} AS country_concentration_pct,
       in_month AS month_concentration_count, {share('in_month', 'n')} AS month_concentration_pct,
       application_year, application_month, age AS days_since_approval,
       CASE WHEN age > 90 THEN 'Critical' WHEN age > 30 THEN 'High' ELSE 'Medium' END AS reconciliation_priority,
       visa_fee_usd AS estimated_revenue_loss
FROM aged JOIN silver_countries USING (country_id) JOIN silver_visa_types USING (visa_type_id)"""

PARTS["gold_revenue"] = f"""
SELECT a.country_id, c.country_name, c.continent, a.visa_type_id, v.visa_type_name, p.payment_year, p.payment_month,
       p.payment_quarter, p.payment_method, p.payment_gateway,
       count(DISTINCT p.payment_id) AS total_transactions, count(DISTINCT p.application_id) AS total_applications,
       sum(p.amount) AS total_revenue, {money_avg('sum(p.amount)', 'count(p.amount)')} AS avg_transaction_value,
       min(p.amount) AS min_transaction_value, max(p.amount) AS max_transaction_value,
       {n_if('p.is_successful')} AS successful_payments, {n_if('NOT p.is_successful')} AS failed_payments,
       {share(n_if('p.is_successful'), 'count(*)')} AS payment_success_rate,
       coalesce(sum(p.amount) FILTER (WHERE NOT p.is_successful), 0) AS revenue_lost_to_failed_payments,
       {n_if("payment_amount_category = 'Low'")} AS low_amount_count,
       {n_if("payment_amount_category = 'Medium'")} AS medium_amount_count,
       {n_if("payment_amount_category = 'High'")} AS high_amount_count,
       coalesce(sum(p.amount) FILTER (WHERE p.is_successful), 0) AS successful_revenue,
       {money_avg('sum(p.amount) FILTER (WHERE p.is_successful)', n_if('p.is_successful'))} AS avg_successful_value
FROM silver_payments p JOIN silver_applications a USING (application_id)
JOIN silver_countries c ON c.country_id = a.country_id JOIN silver_visa_types v ON v.visa_type_id = a.visa_type_id
GROUP BY ALL"""

PARTS["gold_cohorts"] = f"""
WITH history AS (
  SELECT user_id, count(*) AS n, min(application_date) AS first_day, max(application_date) AS last_day,
         {n_if("status = 'Approved'")} AS approved, {n_if("status = 'Rejected'")} AS rejected,
         {n_if("status = 'Cancelled'")} AS cancelled, {n_if("status = 'Pending'")} AS pending,
         count(DISTINCT country_id) AS countries, count(DISTINCT visa_type_id) AS visas
  FROM silver_applications GROUP BY user_id),
spending AS (
  SELECT a.user_id, count(DISTINCT p.payment_id) AS n, sum(p.amount) AS spent,
         {money_avg('sum(p.amount)', 'count(p.amount)')} AS mean
  FROM silver_payments p JOIN silver_applications a USING (application_id) WHERE p.is_successful GROUP BY a.user_id)
SELECT u.user_id, u.full_name, u.email, u.country AS residence_country, p.issuing_country AS nationality, u.age, u.age_group,
       u.signup_date, {i32('year(u.signup_date)')} AS signup_year, {i32('month(u.signup_date)')} AS signup_month,
       {i32('quarter(u.signup_date)')} AS signup_quarter, u.days_since_signup, u.verification_status, u.device_type,
       u.acquisition_channel, coalesce(h.n, 0) AS total_applications, coalesce(h.approved, 0) AS approved_applications,
       coalesce(h.rejected, 0) AS rejected_applications, coalesce(h.cancelled, 0) AS cancelled_applications,
       coalesce(h.pending, 0) AS pending_applications, h.first_day AS first_application_date,
       h.last_day AS last_application_date,
       {i32("date_diff('day', u.signup_date, h.first_day)")} AS days_to_first_application,
       coalesce(h.n >= 2, FALSE) AS is_repeat_applicant, coalesce(h.n >= 5, FALSE) AS is_power_user,
       coalesce(h.countries, 0) AS countries_applied_to, coalesce(h.visas, 0) AS visa_types_applied,
       coalesce(s.n, 0) AS total_payments, coalesce(s.spent, 0) AS total_spent, s.mean AS avg_payment_amount,
       CASE WHEN s.spent >= 500 THEN 'High Value' WHEN s.spent >= 200 THEN 'Medium Value' WHEN s.spent > 0 THEN 'Low Value'
            ELSE 'No Spend' END AS user_value_segment,
       coalesce(u.country <> p.issuing_country, FALSE) AS is_expatriate
FROM silver_users u LEFT JOIN silver_passports p ON p.user_id = u.user_id
LEFT JOIN history h ON h.user_id = u.user_id LEFT JOIN spending s ON s.user_id = u.user_id"""


def _weeks(document_month: str, ticket_month: str) -> str:
    """Weekly measures; the month columns decide the grain of documents and tickets."""
    return f"""
WITH weekly AS (
  SELECT country_id, visa_type_id, application_year, application_month,
         CAST(date_trunc('week', application_date) AS DATE) AS week, count(*) AS n,
         {n_if('is_late_completion')} AS late, {r('avg(processing_days_actual)')} AS days,
         {r('avg(processing_days_expected)')} AS wanted, {n_if("status = 'Approved'")} AS approved,
         {n_if("status = 'Rejected'")} AS rejected
  FROM silver_applications WHERE is_completed GROUP BY ALL),
docs AS (
  SELECT a.country_id, a.visa_type_id, {document_month} CAST(date_trunc('week', d.upload_time) AS DATE) AS week,
         count(*) AS n, {n_if('d.is_verified')} AS verified, {r('avg(d.verification_hours)')} AS hours,
         {n_if("d.verification_speed = 'Fast (<24h)'")} AS fast,
         {n_if("d.verification_speed = 'Standard (24-72h)'")} AS standard,
         {n_if("d.verification_speed = 'Slow (>72h)'")} AS slow
  FROM silver_documents d JOIN silver_applications a USING (application_id) GROUP BY ALL),
support AS (
  SELECT a.country_id, a.visa_type_id, {ticket_month} CAST(date_trunc('week', t.created_at) AS DATE) AS week,
         count(*) AS n, {n_if('t.is_resolved')} AS resolved, {n_if('t.is_high_priority_open')} AS urgent,
         {r('avg(t.resolution_time_hours)')} AS hours,
         {n_if("t.resolution_speed = 'Immediate (<4h)'")} AS immediate, {n_if("t.resolution_speed = 'Fast (<24h)'")} AS fast
  FROM silver_support_tickets t LEFT JOIN silver_applications a ON a.application_id = t.application_id GROUP BY ALL)
SELECT w.country_id, c.country_name, w.visa_type_id, v.visa_type_name, w.application_year, w.application_month,
       w.week AS application_week, w.n AS total_applications, w.approved AS approved_count, w.rejected AS rejected_count,
       {share('w.approved', 'w.n')} AS approval_rate, w.late AS late_completions,
       {share('w.late', 'w.n')} AS late_completion_pct, {share('w.n - w.late', 'w.n')} AS on_time_pct,
       w.days AS avg_processing_days, w.wanted AS avg_expected_days, {r('w.days - w.wanted')} AS avg_delay_days,
       coalesce(d.n, 0) AS total_documents, coalesce(d.verified, 0) AS verified_documents,
       {share('d.verified', 'd.n')} AS document_verification_rate, d.hours AS avg_verification_hours,
       d.fast AS fast_verifications, d.standard AS standard_verifications, d.slow AS slow_verifications,
       coalesce(t.n, 0) AS total_tickets, coalesce(t.resolved, 0) AS resolved_tickets,
       {share('t.resolved', 't.n')} AS ticket_resolution_rate, t.urgent AS high_priority_open,
       t.hours AS avg_resolution_hours, t.immediate AS immediate_resolutions, t.fast AS fast_resolutions
FROM weekly w JOIN silver_countries c USING (country_id) JOIN silver_visa_types v USING (visa_type_id)
LEFT JOIN docs d ON d.country_id = w.country_id AND d.visa_type_id = w.visa_type_id AND d.week = w.week
LEFT JOIN support t ON t.country_id = w.country_id AND t.visa_type_id = w.visa_type_id AND t.week = w.week"""


PARTS["gold_operations"] = _weeks(
    "a.application_year, a.application_month,",
    "year(t.created_at) AS ticket_year, month(t.created_at) AS ticket_month,",
)
PARTS["gold_operations_once"] = _weeks("", "")

PARTS["gold_unfinished"] = f"""
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY application_id ORDER BY event_time DESC, event_id DESC) AS nth,
         count(*) OVER (PARTITION BY application_id) AS n
  FROM silver_application_events),
kinds AS (SELECT application_id, count(DISTINCT event_type) AS kinds FROM silver_application_events GROUP BY 1),
aged AS (
  SELECT a.*, e.event_type, e.event_time, e.n, k.kinds, date_sub('day', e.event_time, {AS_OF}) AS idle,
         date_sub('day', CAST(a.application_date AS TIMESTAMP), {AS_OF}) AS age
  FROM silver_applications a LEFT JOIN ranked e ON e.application_id = a.application_id AND e.nth = 1
  LEFT JOIN kinds k ON k.application_id = a.application_id
  WHERE a.status IN ('Pending', 'Cancelled'))
SELECT application_id, user_id, country_id, country_name, visa_type_id, visa_type_name, application_date, travel_date,
       status, status_category, source, platform, event_type AS last_stage_reached, event_time AS time_of_last_activity,
       idle AS days_since_last_activity, n AS total_events, kinds AS unique_event_types, age AS days_pending,
       CASE WHEN age > 90 THEN 'Critical (>90d)' WHEN age > 30 THEN 'High (30-90d)' WHEN age > 7 THEN 'Medium (7-30d)'
            ELSE 'Low (<7d)' END AS aging_priority,
       CASE WHEN status = 'Cancelled' THEN event_type END AS cancelled_after_stage,
       CASE WHEN status = 'Pending' AND idle <= 7 THEN 'High Recovery Potential'
            WHEN status = 'Pending' AND idle <= 30 THEN 'Medium Recovery Potential'
            WHEN status = 'Cancelled' AND age <= 30 THEN 'Reactivation Opportunity'
            ELSE 'Low Recovery Potential' END AS recovery_opportunity,
       visa_fee_usd AS potential_revenue, application_year, application_month, application_quarter
FROM aged JOIN silver_countries USING (country_id) JOIN silver_visa_types USING (visa_type_id)"""

PARTS["gold_carts"] = """
SELECT u.*, p.payment_method, p.status AS payment_attempt_status,
       CASE WHEN p.payment_id IS NULL THEN 'No Payment' ELSE 'Has Payment' END AS payment_status
FROM gold_unfinished u LEFT JOIN silver_payments p ON p.application_id = u.application_id"""

PARTS["gold_friction"] = f"""
WITH per AS (
  SELECT application_id, count(*) AS n, {n_if('is_verified')} AS good, {r('avg(verification_hours)')} AS mean,
         max(verification_hours) AS longest, {n_if("verification_speed = 'Fast (<24h)'")} AS fast,
         {n_if("verification_speed = 'Slow (>72h)'")} AS slow, {n_if("verification_speed = 'Pending'")} AS pending
  FROM silver_documents GROUP BY application_id)
SELECT a.application_id, a.user_id, a.country_id, c.country_name, a.visa_type_id, v.visa_type_name,
       a.status AS application_status, a.status_category, a.is_late_completion, a.processing_days_actual,
       a.processing_days_expected, per.n AS document_count, per.good AS verified_count,
       {share('per.good', 'per.n')} AS verification_rate, per.mean AS avg_verification_hours,
       per.longest AS max_verification_hours, per.fast AS fast_verifications, per.slow AS slow_verifications,
       per.pending AS pending_verifications, per.good * 100.0 / per.n < 50 AS has_low_verification_rate,
       per.slow > 0 AS has_slow_verifications, per.pending > 0 AS has_pending_verifications,
       (per.good * 100.0 / per.n < 50 OR per.slow > 0) AND a.is_late_completion AS friction_caused_delay,
       a.application_year, a.application_month
FROM per JOIN silver_applications a USING (application_id)
JOIN silver_countries c ON c.country_id = a.country_id JOIN silver_visa_types v ON v.visa_type_id = a.visa_type_id"""

PARTS["gold_tickets"] = f"""
SELECT t.ticket_id, t.user_id, t.application_id, t.category AS ticket_category, t.priority AS ticket_priority,
       t.status AS ticket_status, t.created_at AS ticket_created_at, t.resolved_at AS ticket_resolved_at, t.is_resolved,
       t.resolution_time_hours, t.resolution_speed, t.is_high_priority_open, t.open_ticket_age_hours,
       a.status AS linked_application_status, a.status_category AS linked_application_category, a.application_date,
       CASE WHEN a.status IN ('Approved', 'Rejected') THEN a.status
            WHEN a.status = 'Pending' AND t.created_at >= a.application_date
                 AND t.created_at <= coalesce(CAST(a.completed_date AS TIMESTAMP), {AS_OF}) THEN 'Pending During Ticket'
            WHEN a.status = 'Cancelled' AND t.created_at <= a.completed_date THEN 'Cancelled After Ticket'
            ELSE 'Other' END AS application_status_context,
       r.rating AS user_rating, r.review_text,
       coalesce(a.status = 'Cancelled' AND t.created_at <= a.completed_date, FALSE) AS ticket_before_cancellation,
       coalesce(NOT t.is_resolved AND t.is_high_priority_open, FALSE) AS unresolved_high_priority,
       coalesce(t.resolution_time_hours > 72, FALSE) AS slow_resolution,
       coalesce(r.rating <= 2, FALSE) AS negative_review_after_ticket,
       u.country AS user_country, a.country_id AS application_country_id, t.created_year, t.created_month, t.created_quarter
FROM silver_support_tickets t
LEFT JOIN silver_applications a ON a.application_id = t.application_id
LEFT JOIN silver_users u ON u.user_id = t.user_id
LEFT JOIN silver_reviews r ON r.application_id = t.application_id AND r.user_id = t.user_id"""

PARTS["gold_quality"] = f"""
WITH checks AS (
  SELECT 'Completeness' AS check_category, 'Critical Columns Null Check' AS check_name, 'silver_users' AS table_affected,
         (count(*) - count(user_id)) + (count(*) - count(email)) + (count(*) - count(country)) AS issue_count,
         count(*) * 3 AS total_checks, 'High' AS severity, 30.0 AS weight FROM silver_users
  UNION ALL
  SELECT 'Validity', 'Email Format Validation', 'silver_users', {n_if(f'NOT regexp_full_match(email, {EMAIL})')}, count(*), 'Medium', 25.0
  FROM silver_users
  UNION ALL
  SELECT 'Uniqueness', 'Primary Key Duplication', 'silver_applications', count(*) - count(DISTINCT application_id), count(*), 'High', 25.0
  FROM silver_applications
  UNION ALL
  SELECT 'Consistency', 'Orphaned Payment Records', 'silver_payments', {n_if('a.application_id IS NULL')}, count(*), 'Critical', 20.0
  FROM silver_payments p LEFT JOIN silver_applications a ON a.application_id = p.application_id
  UNION ALL
  SELECT 'Business Rule', 'Approved Without Payment', 'silver_applications', {n_if('p.application_id IS NULL')}, count(*), 'Medium', 0.0
  FROM silver_applications a LEFT JOIN (SELECT DISTINCT application_id FROM silver_payments) p ON p.application_id = a.application_id
  WHERE a.status = 'Approved')
SELECT check_category, check_name, table_affected, {big('issue_count')} AS issue_count, {big('total_checks')} AS total_checks,
       {share('issue_count', 'total_checks')} AS issue_pct, {share('(total_checks - issue_count)', 'total_checks')} AS pass_rate,
       severity, CASE WHEN check_category = 'Business Rule' THEN 'Documented' WHEN issue_count = 0 THEN 'Passed' ELSE 'Failed' END AS resolution_status,
       {dbl('weight')} AS rubric_score_weight,
       {r('CAST(total_checks - issue_count AS DOUBLE) * weight / nullif(total_checks, 0)')} AS weighted_score_contribution,
       {AS_OF} AS checked_at
FROM checks"""

PARTS["early_applications"] = "SELECT * FROM silver_applications WHERE application_date < DATE '1997-01-01'"
PARTS["early_payments"] = "SELECT * FROM silver_payments WHERE payment_year < 1997"
PARTS["early_quality"] = (
    PARTS["gold_quality"].replace("FROM silver_applications", "FROM early_applications")
    .replace("JOIN silver_applications", "JOIN early_applications").replace("FROM silver_payments", "FROM early_payments")
    .replace(AS_OF, "TIMESTAMP '1997-01-01 00:00:00'")
)

# --- queries ------------------------------------------------------------------------------

_MONEY_REVENUE = ", ".join(
    f"{dbl(c)} AS {c}"
    for c in (
        "total_revenue", "min_transaction_value", "max_transaction_value",
        "revenue_lost_to_failed_payments", "successful_revenue",
    )
)
_RAW = {
    "countries": "country_id", "visa_types": "visa_type_id", "airports": "airport_id", "users": "user_id",
    "passports": "passport_id", "applications": "application_id", "payments": "payment_id",
    "documents": "document_id", "application_events": "event_id", "reviews": "review_id",
    "support_tickets": "ticket_id",
}
_GOLD = {
    "application_funnel": "gold_funnel", "payment_reconciliation": "gold_recon", "revenue_metrics": "gold_revenue",
    "user_cohorts": "gold_cohorts", "operational_metrics": "gold_operations",
    "abandoned_cart_analysis": "gold_carts", "document_friction": "gold_friction",
    "support_ticket_impact": "gold_tickets", "data_quality_log": "gold_quality",
}


def _dates(part: str, *columns: str, money: tuple[str, ...] = ()) -> str:
    """All columns of a part, dates as text and decimals as double."""
    changed = [f"{txt(c)} AS {c}" for c in columns] + [f"{dbl(c)} AS {c}" for c in money]
    return f"SELECT * REPLACE ({', '.join(changed)}) FROM {part}"


def _per_table(template: str, tables: dict[str, str]) -> str:
    return " UNION ALL ".join(template.format(table=t, key=k) for t, k in tables.items())


def _abandonment(by: str, source: str, status: str) -> str:
    gone = n_if(f"{status} IN ('Pending', 'Cancelled')")
    return f"SELECT {by}, count(*) AS applications, {gone} AS abandoned, {share(gone, 'count(*)')} AS abandonment_rate FROM {source} GROUP BY {by}"


def _trend(by: str) -> str:
    return f"""SELECT {by}, count(*) AS applications, {r('avg(processing_days_actual)')} AS avg_processing_days,
       {share(n_if('is_late_completion'), 'count(*)')} AS late_pct FROM silver_applications GROUP BY ALL"""


# A text column of each table that its versions differ in.
_VERSIONED = {
    "countries": "currency", "visa_types": "visa_type_name", "airports": "airport_name", "users": "city",
    "passports": "issuing_country", "applications": "platform", "payments": "currency", "documents": "document_type",
    "application_events": "event_type", "reviews": "review_text", "support_tickets": "category",
}
_VALID = {
    "users": f"regexp_full_match(lower(trim(email)), {EMAIL})",
    "applications": "application_date IS NOT NULL AND user_id IS NOT NULL",
    "payments": "amount > 0 AND payment_time IS NOT NULL",
}


def _versions(table: str) -> str:
    """The version of each key that arrived last: 3 late corrections, 2 the rows themselves, 1 what they were before."""
    key, column, valid = _RAW[table], _VERSIONED[table], _VALID.get(table, "TRUE")
    return f"""
SELECT '{table}' AS table_name, {big('key')} AS key, value FROM (
  SELECT {key} AS key, 'new' AS value, 3 AS came FROM raw_{table} WHERE {key} % 3 = 0 AND {valid}
  UNION ALL SELECT {key}, {column}, 2 FROM raw_{table} WHERE {valid}
  UNION ALL SELECT {key}, 'old', 1 FROM raw_{table} WHERE {key} % 5 = 0 AND {valid})
QUALIFY row_number() OVER (PARTITION BY key ORDER BY came DESC) = 1"""


def _broken(table: str, checks: dict[str, str]) -> str:
    """Rows per broken rule; a rule that is unknown is not broken."""
    bad = " OR ".join(f"coalesce(NOT ({c}), FALSE)" for c in checks.values())
    counts = {"rows read": "TRUE", "good rows": f"NOT ({bad})", "rejected rows": bad, "good rows stored": f"NOT ({bad})",
              "rejected rows stored": bad, **{name: f"coalesce(NOT ({c}), FALSE)" for name, c in checks.items()}}
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS check_name, {n_if(c)} AS rows FROM raw_{table}" for name, c in counts.items()
    )


def _applicants(period: str, *parts: str) -> str:
    label = " || '-' || ".join(txt(p) for p in parts) or "''"
    return f"SELECT '{period}' AS period, {label} AS label, count(DISTINCT user_id) AS applicants FROM silver_applications GROUP BY ALL"


def _duration(step: str, start: str, end: str) -> str:
    return f"SELECT visa_type_id, '{step}' AS step, date_sub('hour', {start}, {end}) AS h FROM gold_funnel"


_APPROVED, _REJECTED, _PENDING = (n_if(f"status = '{s}'") for s in ("Approved", "Rejected", "Pending"))
_OK, _BAD = "sum(successful_payments)", "sum(failed_payments)"

_STEPS = (
    ("created to documents", "created_at", "docs_uploaded_at"),
    ("documents to review", "docs_uploaded_at", "under_review_at"),
    ("review to approval", "under_review_at", "approved_at"),
    ("created to approval", "created_at", "approved_at"),
)
_STEP_ROWS = " UNION ALL ".join(
    f"SELECT country_id, '{step}' AS step, date_sub('hour', {start}, {end}) AS h FROM gold_funnel" for step, start, end in _STEPS
)

QUERIES: dict[str, str] = {
    "catalog_scan": """
SELECT 'name' AS scanned_by, status AS name, count(*) AS rows FROM silver_applications GROUP BY status
UNION ALL SELECT 'sql', continent, count(*) FROM silver_countries GROUP BY continent""",
    "catalog_namespace": "SELECT 'property' AS kind, 'description' AS name, 'Cleaned data' AS value UNION ALL "
    "SELECT 'property', 'layer', 'silver' UNION ALL SELECT 'schema', 'own schema', 'true' UNION ALL "
    + _per_table("SELECT 'table', 'silver_{table}', 'listed'", _RAW) + " UNION ALL "
    + _per_table("SELECT 'rows', 'silver_{table}', CAST(count(*) AS VARCHAR) FROM silver_{table}", _RAW),
    "append_by_status": """
SELECT application_year, count(*) AS rows, count(DISTINCT status) AS statuses,
       (SELECT count(*) FROM silver_applications) AS rows_of_table FROM silver_applications GROUP BY 1""",
    "table_replace": f"""
SELECT country, user_id % 2 AS half, count(*) AS users, {n_if('is_verified')} AS verified FROM silver_users GROUP BY 1, 2""",
    "table_comments": """
SELECT 'country_id' AS col_name, CASE typeof(country_id) WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' END AS data_type,
       'the key' AS comment FROM silver_countries GROUP BY ALL
UNION ALL SELECT 'visa_fee_usd', lower(typeof(visa_fee_usd)), 'fee in dollars' FROM silver_countries GROUP BY ALL
UNION ALL SELECT '(table)', 'table', 'Destinations'
UNION ALL SELECT '(bounded read)', 'rows', CAST(least(count(*), 7) AS VARCHAR) FROM silver_countries""",
    "bronze_audit": " UNION ALL ".join(
        f"SELECT 'raw.raw_{t}' AS bronze_source_table, '2001-08-07 00:00:00' AS ingested_at, count(*) AS rows, "
        f"count(DISTINCT {k}) AS keys FROM raw_{t}" for t, k in _RAW.items()
    ),
    "dedup_any_applications": f"""
SELECT DISTINCT application_id, user_id, status, {txt('completed_date')} AS completed_date FROM raw_applications""",
    "silver_versions": " UNION ALL ".join(f"SELECT * FROM ({_versions(t)})" for t in _RAW),
    "silver_incremental": f"SELECT * REPLACE ({dbl('amount')} AS amount) FROM silver_payments",
    "gold_incremental": f"SELECT * REPLACE ({_MONEY_REVENUE}) FROM gold_revenue",
    "quarantine_report": _broken("applications", {
        "types": "application_id % 300 <> 0",
        "user known": "user_id IS NOT NULL",
        "date known": "application_date IS NOT NULL",
        "date in range": "application_date BETWEEN DATE '1993-01-01' AND DATE '1997-12-31'",
        "completed after application": "completed_date >= application_date",
        "status known": "status IN ('Approved', 'Rejected', 'Pending')",
    }) + " UNION ALL " + _broken("payments", {
        "amount positive": "amount > 0",
        "amount plausible": "amount BETWEEN 1 AND 450",
        "time known": "payment_time IS NOT NULL",
    }),
    "dq_history": f"""
WITH runs AS (SELECT * FROM early_quality UNION ALL SELECT * FROM gold_quality),
seen AS (SELECT *, lag(issue_count) OVER w AS previous_issue_count, lag(pass_rate) OVER w AS previous_pass_rate
         FROM runs WINDOW w AS (PARTITION BY check_category, check_name, table_affected ORDER BY checked_at))
SELECT checked_at, check_category, check_name, table_affected, issue_count, total_checks, pass_rate, resolution_status,
       previous_issue_count, issue_count - previous_issue_count AS new_issues,
       {r('pass_rate - previous_pass_rate')} AS pass_rate_change, coalesce(pass_rate < previous_pass_rate, FALSE) AS is_worse
FROM seen""",
    "applicants_by_period": " UNION ALL ".join((
        _applicants("month", "application_year", "application_quarter", "application_month"),
        _applicants("quarter", "application_year", "application_quarter"),
        _applicants("year", "application_year"),
        "SELECT 'all', '', count(DISTINCT user_id) FROM silver_applications",
    )),
    "applicants_by_country": """
SELECT application_year, country_id, count(DISTINCT user_id) AS applicants FROM silver_applications GROUP BY 1, 2""",
    "stage_medians": f"""
WITH steps AS ({_STEP_ROWS})
SELECT country_id, step, count(h) AS applications, quantile_disc(h, 0.5) AS median_hours FROM steps WHERE h IS NOT NULL GROUP BY 1, 2
UNION ALL SELECT -1, step, count(h), quantile_disc(h, 0.5) FROM steps WHERE h IS NOT NULL GROUP BY step""",
    "abandonment_by_visa_type": _abandonment("visa_type_id", "silver_applications", "status"),
    "abandonment_by_month": _abandonment("application_year, application_month", "silver_applications", "status"),
    "trend_by_visa_type": _trend("visa_type_id"),
    "payment_health_by_visa_type": f"""
SELECT visa_type_name, payment_method, {big(_OK)} AS successful_payments, {big(_BAD)} AS failed_payments,
       {share(_OK, f'({_OK} + {_BAD})')} AS success_rate, {money_avg('sum(total_revenue)', 'sum(total_transactions)')} AS avg_value,
       {dbl('sum(revenue_lost_to_failed_payments)')} AS revenue_lost FROM gold_revenue GROUP BY 1, 2""",
    "bronze_ingest": _per_table("SELECT '{table}' AS \"table\", TRUE AS success, count(*) AS rows FROM raw_{table}", _RAW),
    "bronze_source_files": " UNION ALL ".join(
        f"SELECT '{t}' AS source_table, count(*) AS rows FROM {t}"
        for t in ("region", "nation", "customer", "supplier", "orders", "lineitem", "events", "documents", "labels")
    ),
    "incremental_batch": "SELECT event_type, count(*) AS rows, count(DISTINCT event_id) AS event_ids FROM events GROUP BY event_type",
    "incremental_load": "SELECT event_type, 'raw.raw_events' AS bronze_source_table, count(*) AS rows, count(DISTINCT event_id) AS event_ids FROM events GROUP BY event_type",
    "silver_countries": f"SELECT * REPLACE ({dbl('visa_fee_usd')} AS visa_fee_usd, {dbl('approval_rate')} AS approval_rate) FROM silver_countries",
    "silver_visa_types": "SELECT * FROM silver_visa_types",
    "silver_airports": "SELECT * FROM silver_airports",
    "silver_passports": "SELECT * FROM silver_passports",
    "silver_events": "SELECT * FROM silver_application_events",
    "silver_reviews": "SELECT * FROM silver_reviews",
    "silver_users": _dates("silver_users", "dob", "signup_date"),
    "silver_applications": _dates("silver_applications", "application_date", "travel_date", "expected_completion", "completed_date"),
    "silver_payments": _dates("silver_payments", money=("amount",)),
    "silver_documents": "SELECT * FROM silver_documents",
    "silver_tickets": "SELECT * FROM silver_support_tickets",
    "dedup_latest_payments": f"""
SELECT payment_id, application_id, {dbl('amount')} AS amount, status, payment_time FROM raw_payments
QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY arrival DESC, arrival_part DESC, arrival_supplier DESC) = 1""",
    "dedup_report": _per_table(
        "SELECT '{table}' AS table_name, count(*) AS initial_rows, count(DISTINCT {key}) AS final_rows, "
        "count(*) - count(DISTINCT {key}) AS duplicates_removed FROM raw_{table}", _RAW
    ),
    "payment_retry_flag": """
SELECT payment_id, application_id, status,
       row_number() OVER w > 1 AS attempt_is_retry,
       coalesce(count(*) FILTER (WHERE status = 'Failed') OVER (PARTITION BY application_id ORDER BY payment_time, payment_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 0, FALSE) AS retry_after_failure
FROM silver_payments WINDOW w AS (PARTITION BY application_id ORDER BY payment_time, payment_id)""",
    "label_standardise": f"""
SELECT CASE WHEN payment_method IN ('PayPal', 'Apple Pay', 'Google Pay') THEN 'Digital Wallet' ELSE payment_method END AS payment_method,
       CASE payment_gateway WHEN 'gw0' THEN 'Gateway A' WHEN 'gw1' THEN 'Gateway B' ELSE payment_gateway END AS payment_gateway,
       count(*) AS payments, {dbl('sum(amount)')} AS amount FROM silver_payments GROUP BY 1, 2""",
    "fill_defaults": f"""
SELECT user_id IS NULL AS no_user, {i32('coalesce(year(application_date), 1900)')} AS application_year,
       completed_date IS NULL AS still_open, count(*) AS applications FROM raw_applications GROUP BY 1, 2, 3""",
    "cast_reject_counts": """
SELECT 'travel_date' AS column_name, count(*) FILTER (WHERE application_id % 300 = 0) AS rejected_rows, count(*) AS total_rows FROM raw_applications
UNION ALL SELECT 'country_id', count(*) FILTER (WHERE application_id % 450 = 0), count(*) FROM raw_applications
UNION ALL SELECT 'passport_id', 0, count(*) FROM raw_applications""",
    "silver_rates": f"""
SELECT 'documents' AS table_name, count(*) AS total_rows, {n_if('is_verified')} AS done_rows,
       {share(n_if('is_verified'), 'count(*)')} AS done_pct, CAST(NULL AS BIGINT) AS high_priority_open FROM silver_documents
UNION ALL
SELECT 'support_tickets', count(*), {n_if('is_resolved')}, {share(n_if('is_resolved'), 'count(*)')}, {n_if('is_high_priority_open')}
FROM silver_support_tickets""",
    "preview_users": """
SELECT user_id, full_name, email, country, age, age_group, days_since_signup, verification_status, device_type, acquisition_channel
FROM silver_users ORDER BY user_id LIMIT 10""",
    "layer_manifest": _per_table("SELECT 'silver_{table}' AS table_name, count(*) AS row_count FROM silver_{table}", _RAW),
    "gold_manifest": _per_table("SELECT 'gold_{table}' AS table_name, count(*) AS row_count FROM {key}", _GOLD),
    "layer_summary": "WITH sizes AS ("
    + _per_table("SELECT count(*) AS n FROM silver_{table}", _RAW)
    + """)
SELECT 'Total Tables' AS metric, CAST(count(*) AS VARCHAR) || ' tables' AS value FROM sizes
UNION ALL SELECT 'Total Rows', format('{:,}', CAST(sum(n) AS BIGINT)) || ' rows' FROM sizes
UNION ALL SELECT 'Storage Format', 'parquet'
UNION ALL SELECT 'Storage Location', 'silver'
UNION ALL SELECT 'Status', 'All tables persisted and queryable'""",
    "null_report": " UNION ALL ".join(
        f"SELECT 'raw_{t}' AS table_name, '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS null_rows FROM raw_{t}"
        for t, columns in {
            "users": ("user_id", "email", "dob", "country"),
            "applications": ("application_id", "user_id", "application_date", "status"),
            "payments": ("payment_id", "payment_time"),
            "support_tickets": ("application_id", "resolved_at"),
        }.items()
        for c in columns
    ),
    "key_null_report": " UNION ALL ".join(
        f"SELECT 'silver_{t}' AS table_name, count(*) AS total_rows, count(*) - count({a}) AS null_user_ids, "
        f"count(*) - count({b}) AS null_emails, count(*) - count({c}) AS null_countries FROM silver_{t}"
        for t, (a, b, c) in {
            "users": ("user_id", "email", "country"),
            "applications": ("application_id", "user_id", "status"),
        }.items()
    ),
    "fk_report": " UNION ALL ".join(
        f"SELECT '{child}' AS table_name, count(*) AS orphaned_records, '{key}' AS foreign_key FROM silver_{child} c "
        f"LEFT JOIN silver_{parent} p ON p.{key} = c.{key} WHERE p.{key} IS NULL{extra}"
        for child, key, parent, extra in (
            ("application_events", "application_id", "applications", ""),
            ("payments", "application_id", "applications", ""),
            ("documents", "application_id", "applications", ""),
            ("reviews", "application_id", "applications", ""),
            ("reviews", "user_id", "users", ""),
            ("support_tickets", "user_id", "users", ""),
            ("support_tickets", "application_id", "applications", " AND c.application_id IS NOT NULL"),
        )
    ),
    "dq_score": f"""
WITH u AS (SELECT count(*) AS n, count(user_id) + count(email) + count(country) AS filled, count(DISTINCT user_id) AS ids,
                  {n_if(f'regexp_full_match(email, {EMAIL})')} AS valid FROM silver_users),
a AS (SELECT count(*) AS n, count(application_id) + count(user_id) + count(status) AS filled, count(DISTINCT application_id) AS ids
      FROM silver_applications),
e AS (SELECT count(DISTINCT e.application_id) AS ids, count(DISTINCT a.application_id) AS known
      FROM silver_application_events e LEFT JOIN silver_applications a ON a.application_id = e.application_id),
p AS (SELECT count(DISTINCT p.application_id) AS ids, count(DISTINCT a.application_id) AS known
      FROM silver_payments p LEFT JOIN silver_applications a ON a.application_id = p.application_id),
scores AS (
  SELECT 'completeness' AS criterion, 30 AS weight, {share('(u.filled + a.filled)', '(u.n + a.n) * 3')} AS score FROM u, a
  UNION ALL SELECT 'uniqueness', 25, {share('(u.ids + a.ids)', 'u.n + a.n')} FROM u, a
  UNION ALL SELECT 'validity', 25, {share('u.valid', 'u.n')} FROM u
  UNION ALL SELECT 'consistency', 20, {share('(e.known + p.known)', 'e.ids + p.ids')} FROM e, p)
SELECT criterion, {i32('weight')} AS weight, score, {r('score * weight / 100', 4)} AS points FROM scores
UNION ALL SELECT 'final', {i32('sum(weight)')}, NULL, {r(f"sum({r('score * weight / 100', 4)})", 4)} FROM scores""",
    "dq_log": "SELECT * FROM gold_quality",
    "expectation_report": f"""
WITH found AS (
  SELECT 'unique' AS expectation, 'application_id' AS column_name, count(*) AS checked_rows, {n_if('n > 1')} AS failed_rows
  FROM (SELECT count(*) OVER (PARTITION BY application_id) AS n FROM raw_applications)
  UNION ALL SELECT 'unique', 'passport_id', count(*), {n_if('n > 1')}
  FROM (SELECT count(*) OVER (PARTITION BY passport_id) AS n FROM silver_applications)
  UNION ALL SELECT 'between', 'processing_days_actual', count(processing_days_actual),
         {n_if('processing_days_actual < 0 OR processing_days_actual > 20')} FROM silver_applications
  UNION ALL SELECT 'between', 'amount', count(amount), {n_if('amount < 1 OR amount > 100000')} FROM raw_payments
  UNION ALL SELECT 'in', 'status', count(status), {n_if("status = 'Cancelled'")} FROM silver_applications
  UNION ALL SELECT 'in_set', 'application_id', count(*), {n_if('a.application_id IS NULL')}
  FROM silver_reviews v LEFT JOIN silver_applications a ON a.application_id = v.application_id
  UNION ALL SELECT 'date_range', 'application_date', count(application_date),
         {n_if(f"application_date < DATE '1993-01-01' OR application_date > {AS_OF}")} FROM silver_applications)
SELECT *, failed_rows = 0 AS success FROM found""",
    "gold_contract": f"""
WITH counted AS (SELECT *, count(*) OVER (PARTITION BY country_id, visa_type_id, application_year, application_month, application_week) AS copies
                 FROM gold_operations),
found AS (
  SELECT 'unique dimensions' AS rule, count(*) AS checked_rows, {n_if('copies > 1')} AS failed_rows FROM counted
  UNION ALL SELECT 'total_applications', count(*), count(*) - count(total_applications) FROM counted
  UNION ALL SELECT 'approval_rate', count(*), count(*) - count(approval_rate) FROM counted
  UNION ALL SELECT 'document_verification_rate', count(*), count(*) - count(document_verification_rate) FROM counted)
SELECT *, failed_rows = 0 AS success FROM found""",
    "schema_drift": """
SELECT 'category' AS column_name, 'missing' AS kind, 'string' AS expected_type, CAST(NULL AS VARCHAR) AS actual_type,
       count(*) AS affected_rows FROM raw_support_tickets
UNION ALL SELECT 'channel', 'unexpected', NULL, 'string', count(*) FROM raw_support_tickets
UNION ALL SELECT 'resolution_time_hours', 'type changed', 'double', 'string', count(resolution_time_hours) FROM raw_support_tickets""",
    "row_count_delta": f"""
WITH log AS (SELECT event_type AS table_name, CAST(date_trunc('month', event_time) AS DATE) AS run_date, count(*) AS rows
             FROM silver_application_events GROUP BY 1, 2),
seen AS (SELECT *, lag(rows) OVER (PARTITION BY table_name ORDER BY run_date) AS previous_value FROM log),
changed AS (SELECT *, {share('(rows - previous_value)', 'previous_value')} AS change_pct FROM seen)
SELECT * REPLACE ({txt('run_date')} AS run_date), coalesce(abs(change_pct) > 20, FALSE) AS is_alert FROM changed""",
    "payment_gap_by_status": f"""
SELECT status, status_category, count(*) AS applications_without_payment,
       {share('count(*)', '(SELECT count(*) FROM gap)')} AS pct_of_gap,
       {n_if('is_completed')} AS completed_count, {n_if('NOT is_completed')} AS not_completed_count
FROM gap GROUP BY status, status_category""",
    "payment_gap_by_visa_type": f"""
WITH g AS (SELECT status, visa_type_name, visa_fee_usd, count(*) AS app_count
           FROM gap JOIN silver_visa_types USING (visa_type_id) JOIN silver_countries USING (country_id) GROUP BY ALL)
SELECT status, visa_type_name, {dbl('visa_fee_usd')} AS visa_fee_usd, app_count,
       {share('app_count', '(SELECT count(*) FROM gap)')} AS pct_of_total_gap,
       {big('sum(app_count) OVER (PARTITION BY status)')} AS total_by_status,
       {share('app_count', 'sum(app_count) OVER (PARTITION BY status)')} AS pct_within_status FROM g""",
    "approved_payment_breakdown": f"""
WITH per AS (SELECT a.application_id, count(*) AS joined, count(p.payment_id) AS n, {n_if('p.is_successful')} AS ok
             FROM silver_applications a LEFT JOIN silver_payments p ON p.application_id = a.application_id
             WHERE a.status = 'Approved' GROUP BY 1)
SELECT CASE WHEN n = 0 THEN 'No payment record' WHEN ok = 0 THEN 'Failed payment attempts only' ELSE 'Has successful payment' END AS payment_category,
       {big('sum(joined)')} AS app_count, count(*) AS applications FROM per GROUP BY 1""",
    "application_funnel": _dates("gold_funnel", "application_date", "travel_date", "completed_date", "application_date_str"),
    "payment_reconciliation": _dates("gold_recon", "approved_at", "application_date", money=("expected_fee", "estimated_revenue_loss")),
    "revenue_metrics": f"SELECT * REPLACE ({_MONEY_REVENUE}) FROM gold_revenue",
    "user_cohorts": _dates("gold_cohorts", "signup_date", "first_application_date", "last_application_date", money=("total_spent",)),
    "operational_metrics": _dates("gold_operations", "application_week"),
    "operational_metrics_rollup": _dates("gold_operations_once", "application_week"),
    "abandoned_carts": _dates("gold_carts", "application_date", "travel_date", money=("potential_revenue",)),
    "document_friction": "SELECT * FROM gold_friction",
    "ticket_impact": _dates("gold_tickets", "application_date"),
    "application_funnel_bucketed": _dates("gold_funnel", "application_date", "travel_date", "completed_date", "application_date_str"),
    "funnel_overview": f"""
SELECT count(*) AS total_applications, count(DISTINCT user_id) AS unique_users, count(DISTINCT country_id) AS countries_covered,
       {n_if('has_payment')} AS apps_with_payment, {n_if('NOT has_payment')} AS apps_without_payment,
       {r('avg(processing_days_actual)')} AS avg_processing_days, {n_if('is_late_completion')} AS late_completions,
       {share(n_if('is_late_completion'), 'count(*)')} AS late_completion_pct FROM gold_funnel""",
    "stage_dropoff": f"""
SELECT stage_reached, count(*) AS applications, {share('count(*)', '(SELECT count(*) FROM gold_funnel)')} AS pct_of_total,
       {r('avg(processing_days_actual)')} AS avg_processing_days, {n_if('is_late_completion')} AS late_count
FROM gold_funnel GROUP BY stage_reached""",
    "reconciliation_overview": f"""
SELECT count(*) AS total_unreconciled_apps, {dbl('sum(estimated_revenue_loss)')} AS total_revenue_at_risk,
       {money_avg('sum(expected_fee)', 'count(expected_fee)')} AS avg_expected_fee,
       count(DISTINCT country_id) AS countries_affected, count(DISTINCT visa_type_id) AS visa_types_affected,
       {n_if("reconciliation_priority = 'Critical'")} AS critical_priority_count,
       {n_if("reconciliation_priority = 'High'")} AS high_priority_count,
       {r('avg(days_since_approval)')} AS avg_days_since_approval FROM gold_recon""",
    "gap_by_country_top10": f"""
SELECT country_name, count(*) AS unreconciled_count, {share('count(*)', '(SELECT count(*) FROM gold_recon)')} AS pct_of_gap,
       {dbl('sum(estimated_revenue_loss)')} AS revenue_at_risk, {r('avg(days_since_approval)')} AS avg_days_since_approval,
       count(DISTINCT visa_type_name) AS visa_types_affected
FROM gold_recon GROUP BY country_name ORDER BY unreconciled_count DESC, country_name LIMIT 10""",
    "grain_density": f"""
WITH d AS (SELECT count(*) AS total_rows, count(DISTINCT country_id) AS distinct_countries, count(DISTINCT visa_type_id) AS distinct_visa_types,
           count(DISTINCT payment_method) AS distinct_payment_methods, count(DISTINCT payment_gateway) AS distinct_payment_gateways,
           count(DISTINCT payment_year * 100 + payment_month) AS distinct_year_months FROM gold_revenue)
SELECT *, distinct_countries * distinct_visa_types * distinct_payment_methods * distinct_payment_gateways * distinct_year_months AS possible_rows,
       {share('total_rows', 'distinct_countries * distinct_visa_types * distinct_payment_methods * distinct_payment_gateways * distinct_year_months', 1)} AS density_pct
FROM d""",
    "validation_report": f"""
WITH per AS (SELECT a.application_id, count(*) AS joined, count(p.payment_id) AS n, {n_if('p.is_successful')} AS ok
             FROM silver_applications a LEFT JOIN silver_payments p ON p.application_id = a.application_id
             WHERE a.status = 'Approved' GROUP BY 1),
d AS (SELECT count(*) AS n, count(DISTINCT country_id) AS c, count(DISTINCT visa_type_id) AS v, count(DISTINCT payment_method) AS m,
             count(DISTINCT payment_gateway) AS g, count(DISTINCT payment_year * 100 + payment_month) AS t FROM gold_revenue)
SELECT 'Payment Gap Breakdown' AS validation_check,
       CASE WHEN n = 0 THEN 'No payment record' WHEN ok = 0 THEN 'Failed payment attempts only' ELSE 'Has successful payment' END AS metric,
       CAST(sum(joined) AS VARCHAR) || ' approved apps' AS value FROM per GROUP BY 2
UNION ALL SELECT 'Revenue Metrics Grain', 'Dimensions',
       format('{{}} countries × {{}} visa types × {{}} methods × {{}} gateways × {{}} months', c, v, m, g, t) FROM d
UNION ALL SELECT 'Revenue Metrics Grain', 'Data density',
       format('{{}} rows / {{}} possible = {{}}% (sparse as expected)', n, c * v * m * g * t,
              {txt(share('n', '(c * v * m * g * t)', 1))}) FROM d""",
    "operational_weekly": f"""
SELECT {txt("CAST(date_trunc('week', application_date) AS DATE)")} AS application_week, country_name, visa_type_name,
       count(*) AS total_applications, {r('avg(processing_days_actual)')} AS avg_processing_days,
       {share(n_if('is_late_completion'), 'count(*)')} AS avg_late_pct, {n_if("status IN ('Approved', 'Rejected')")} AS completed_count
FROM silver_applications JOIN silver_countries USING (country_id) JOIN silver_visa_types USING (visa_type_id) GROUP BY 1, 2, 3""",
    "operational_slice": f"""
SELECT * REPLACE ({txt('application_week')} AS application_week) FROM (
SELECT application_week, country_name, visa_type_name, total_applications, late_completion_pct FROM gold_operations
WHERE application_week >= DATE '1997-01-01'
ORDER BY application_week DESC, country_name, visa_type_name, total_applications, late_completion_pct LIMIT 10)""",
    "revenue_slice": f"""
SELECT payment_month, country_name, visa_type_name, payment_method, payment_gateway, {dbl('total_revenue')} AS total_revenue,
       successful_payments FROM gold_revenue WHERE payment_year = 1997 AND country_name IN ('NATION_3', 'NATION_7', 'NATION_12')""",
    "last_event_per_application": """
SELECT application_id, event_time, event_type FROM silver_application_events
QUALIFY row_number() OVER (PARTITION BY application_id ORDER BY event_time DESC, event_id DESC) = 1""",
    "first_payment_per_application": f"""
SELECT a.application_id, a.status, p.payment_id, {dbl('p.amount')} AS amount, p.payment_time
FROM silver_applications a LEFT JOIN silver_payments p ON p.application_id = a.application_id
QUALIFY row_number() OVER (PARTITION BY a.application_id ORDER BY p.payment_time, p.payment_id) = 1""",
    "abandoned_rollup": f"""
SELECT last_stage_reached, recovery_opportunity, count(*) AS total_abandoned, {dbl('sum(potential_revenue)')} AS total_potential_revenue,
       {r('avg(days_since_last_activity)')} AS avg_days_since_abandonment FROM gold_unfinished GROUP BY 1, 2""",
    "recovery_tier": f"""
WITH staged AS (SELECT *, CASE WHEN payment_status = 'Has Payment' THEN 'Payment Initiated' ELSE last_stage_reached END AS stage FROM gold_carts)
SELECT CASE stage WHEN 'Payment Initiated' THEN 'High' WHEN 'Documents Submitted' THEN 'Medium' ELSE 'Low' END AS recovery_tier,
       stage AS recovery_stage, count(*) AS carts, count(DISTINCT application_id) AS applications,
       {dbl('sum(potential_revenue)')} AS potential_revenue FROM staged GROUP BY 1, 2""",
    "kpi_overview": f"""
SELECT count(*) AS total_applications, {dbl('(SELECT sum(amount) FROM silver_payments WHERE is_successful)')} AS total_revenue,
       {share(n_if('is_late_completion'), 'count(*)')} AS late_completion_rate, {r('avg(processing_days_actual)')} AS avg_processing_days
FROM silver_applications""",
    "metric_view_month_country": f"""
SELECT {txt('make_date(payment_year, payment_month, 1)')} AS payment_month_date, country_name, {dbl('sum(total_revenue)')} AS total_revenue,
       {big('sum(total_transactions)')} AS total_transactions, {big(_OK)} AS successful_payments, {big(_BAD)} AS failed_payments,
       {r('avg(avg_transaction_value)', 4)} AS avg_transaction_value,
       {money_avg('sum(total_revenue)', 'sum(total_transactions)')} AS weighted_avg_value,
       {share(_OK, f'({_OK} + {_BAD})')} AS payment_success_rate
FROM gold_revenue WHERE payment_year = 1997 GROUP BY 1, 2""",
    "payment_success_rate": f"""
SELECT {n_if('is_successful')} AS successful_payments, {n_if('NOT is_successful')} AS failed_payments,
       {share(n_if('is_successful'), 'count(*)')} AS payment_success_rate FROM silver_payments""",
    "late_completion_rate": f"""
SELECT count(*) AS applications, {share(n_if('is_late_completion'), 'count(*)')} AS late_completion_rate,
       {share(n_if('late_by_days'), 'count(*)')} AS late_by_days_rate FROM silver_applications""",
    "abandonment_rate": f"""
SELECT count(*) AS applications, {n_if("status IN ('Pending', 'Cancelled')")} AS abandoned,
       {share(n_if("status IN ('Pending', 'Cancelled')"), 'count(*)')} AS abandonment_rate FROM silver_applications""",
    "revenue_at_risk": f"""
SELECT count(*) AS applications, {n_if("status IN ('Pending', 'Cancelled')")} AS abandoned,
       {dbl("sum(CASE WHEN status IN ('Pending', 'Cancelled') THEN visa_fee_usd ELSE 0 END)")} AS revenue_at_risk
FROM silver_applications JOIN silver_countries USING (country_id)""",
    "revenue_by_country_top5_other": f"""
WITH sums AS (SELECT country_name, sum(successful_revenue) AS s FROM gold_revenue GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (ORDER BY s DESC, country_name) AS nth FROM sums)
SELECT CASE WHEN nth <= 5 THEN country_name ELSE 'Other' END AS country_name, {dbl('sum(s)')} AS successful_revenue,
       {share('sum(s)', '(SELECT sum(s) FROM sums)')} AS revenue_pct FROM ranked GROUP BY 1""",
    "revenue_by_method": f"""
SELECT payment_method, {dbl('sum(successful_revenue)')} AS revenue, {big('sum(total_transactions)')} AS transactions,
       {share('sum(successful_revenue)', '(SELECT sum(successful_revenue) FROM gold_revenue)')} AS revenue_pct FROM gold_revenue GROUP BY 1""",
    "revenue_by_month": f"""
SELECT {txt('make_date(payment_year, payment_month, 1)')} AS payment_month_date, {dbl('sum(successful_revenue)')} AS revenue,
       {big('sum(total_transactions)')} AS transactions,
       {share('sum(successful_revenue)', '(SELECT sum(successful_revenue) FROM gold_revenue)')} AS revenue_pct FROM gold_revenue GROUP BY 1""",
    "trend_weekly": _trend(txt("CAST(date_trunc('week', application_date) AS DATE)") + " AS application_week"),
    "trend_by_status": _trend("status"),
    "threshold_status": f"""
WITH t AS ({_trend('country_id')}), h AS (SELECT *, {r('100 - late_pct')} AS on_time_pct FROM t)
SELECT *, CASE WHEN late_pct > 60 THEN 'red' ELSE 'ok' END AS late_status,
       CASE WHEN avg_processing_days > 20 THEN 'escalate' ELSE 'ok' END AS processing_status,
       CASE WHEN on_time_pct >= 90 THEN 'green' WHEN on_time_pct >= 75 THEN 'amber' ELSE 'red' END AS health_status FROM h""",
    "row_filter_region": f"""
SELECT country_name, count(*) AS cells, {dbl('sum(total_revenue)')} AS total_revenue FROM gold_revenue WHERE continent = 'ASIA' GROUP BY 1""",
    "abandonment_by_country": _abandonment("country_id", "silver_applications", "status"),
    "abandonment_by_stage": _abandonment("stage_reached", "gold_funnel", "final_status"),
    "stage_durations": "WITH steps AS ("
    + " UNION ALL ".join(
        _duration(*step)
        for step in _STEPS
    )
    + f""")
SELECT visa_type_id, step, count(h) AS applications, {r('avg(h)')} AS avg_hours, quantile_disc(h, 0.5) AS median_hours, min(h) AS min_hours, max(h) AS max_hours
FROM steps WHERE h IS NOT NULL GROUP BY 1, 2""",
    "approval_trend": f"""
SELECT {txt("CAST(date_trunc('month', application_date) AS DATE)")} AS application_month_date, count(*) AS applications,
       {_APPROVED} AS approved, {_REJECTED} AS rejected, {_PENDING} AS in_progress,
       {share(_APPROVED, f'({_APPROVED} + {_REJECTED})')} AS approval_rate FROM silver_applications GROUP BY 1""",
    "pending_ageing": f"""
SELECT aging_priority, count(*) AS applications, {_PENDING} AS pending, {n_if("status = 'Cancelled'")} AS cancelled,
       {share(n_if("status = 'Cancelled'"), 'count(*)')} AS cancelled_pct,
       {share('count(*)', '(SELECT count(*) FROM gold_unfinished)')} AS pct_of_total FROM gold_unfinished GROUP BY 1""",
    "cohort_summary": f"""
SELECT acquisition_channel, count(*) AS members, {n_if('is_repeat_applicant')} AS repeat_applicants,
       {share(n_if('is_repeat_applicant'), 'count(*)')} AS repeat_pct, {n_if('is_power_user')} AS power_users,
       {n_if('is_expatriate')} AS expatriates, {big('sum(total_applications)')} AS applications, {dbl('sum(total_spent)')} AS total_spent,
       {r('avg(days_to_first_application)')} AS avg_days_to_first_application FROM gold_cohorts GROUP BY 1""",
    "payment_health": f"""
SELECT payment_gateway, payment_method, {big(_OK)} AS successful_payments, {big(_BAD)} AS failed_payments,
       {share(_OK, f'({_OK} + {_BAD})')} AS success_rate, {money_avg('sum(total_revenue)', 'sum(total_transactions)')} AS avg_value,
       {dbl('sum(revenue_lost_to_failed_payments)')} AS revenue_lost FROM gold_revenue GROUP BY 1, 2""",
    "ops_kpis": f"""
WITH m AS (SELECT sum(amount) AS s FROM silver_payments WHERE is_successful), a AS (SELECT count(*) AS n, {_PENDING} AS p FROM silver_applications)
SELECT a.n AS applications, a.p AS in_progress, {dbl('m.s')} AS revenue, {money_avg('m.s', 'a.n')} AS revenue_per_application FROM m, a""",
    "recovery_targets": f"""
WITH waiting AS (SELECT *, date_sub('hour', coalesce(time_of_last_activity, CAST(application_date AS TIMESTAMP)), {AS_OF}) AS idle_hours
                 FROM gold_unfinished WHERE potential_revenue > 150)
SELECT application_id, user_id, country_name, {dbl('potential_revenue')} AS potential_revenue, last_stage_reached, idle_hours,
       CASE WHEN idle_hours >= 168 THEN '7d' WHEN idle_hours >= 72 THEN '72h' WHEN idle_hours >= 24 THEN '24h' ELSE 'not due' END AS reminder_due
FROM waiting""",
    "retry_due": f"""
SELECT payment_id, application_id, {dbl('amount')} AS amount, payment_method, payment_gateway, payment_time,
       date_sub('hour', payment_time, {AS_OF}) AS hours_since_failure
FROM silver_payments f
WHERE NOT is_successful AND date_sub('hour', payment_time, {AS_OF}) >= 24
  AND NOT EXISTS (SELECT 1 FROM silver_payments s WHERE s.application_id = f.application_id AND s.is_successful
                  AND s.payment_time > f.payment_time)""",
}


def _needed(text: str, chosen: list[str]) -> None:
    """Named parts used by ``text``, each after the parts it uses itself."""
    for name in PARTS:
        if name not in chosen and re.search(rf"\b{name}\b", text):
            _needed(PARTS[name], chosen)
            if name not in chosen:
                chosen.append(name)


def oracles() -> dict[str, str]:
    result = {}
    for name, body in QUERIES.items():
        chosen: list[str] = []
        _needed(body, chosen)
        optional = ", ".join(f"{dbl(c)} AS {c}" for c in OPTIONAL_NUMBERS.get(name, ()))
        columns = f"* REPLACE ({optional})" if optional else "*"
        head = ",\n".join(f"{part} AS ({PARTS[part]})" for part in chosen)
        result[name] = f"{f'WITH {head}' if head else ''}\nSELECT {columns} FROM ({body})".strip()
    return result
