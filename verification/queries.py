"""Registered queries: each maps (spark, sf_dir) to a DataFrame over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.functions import month_start, week_start
from strataflow.operators import (
    cast_columns,
    change_from_previous,
    dedup_any,
    dedup_latest,
    dedup_report,
    fill_defaults,
    join_first,
    last_event,
    preview,
    quarantine,
    reject_counts,
    row_filter,
    slice_rows,
    standardise_labels,
    union_reports,
)
from strataflow.plans import gold, kpis, quality, silver
from strataflow.plans.lakehouse import GOLD_TABLES, Lakehouse
from strataflow.schemas import KEYS, RAW_SCHEMAS, TABLES
from strataflow.session import shared_folder, store, tune
from strataflow.sources import catalog
from strataflow.sources.bronze import ingest_all
from strataflow.sources.catalog import add_source_file, layer_summary, manifest
from strataflow.sources.fixtures import PAYMENT_ORDER, Fixtures
from strataflow.streaming import CurrentRows, ingest_incremental, new_rows, refresh_partitions

from .columns import OPTIONAL_NUMBERS

AS_OF = datetime(2001, 8, 7)

_LAKES: dict[tuple[str, str], Lakehouse] = {}


def lake(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """The lakehouse of a session and data folder."""
    tune(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        _LAKES[key] = Lakehouse(spark, Fixtures(spark, sf_dir).raw, AS_OF, PAYMENT_ORDER)
    return _LAKES[key]


def plain(df: DataFrame, as_double: Sequence[str] = ()) -> DataFrame:
    """Columns in types that two engines show alike: decimals as double, dates as text."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType) or field.name in as_double:
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string").alias(field.name)
        columns.append(column)
    return df.select(*columns)


_QUERIES: dict[str, Callable[[Lakehouse], DataFrame]] = {}


def query(name: str):
    def register(build: Callable[[Lakehouse], DataFrame]):
        _QUERIES[name] = build
        return build

    return register


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(name: str, build: Callable[[Lakehouse], DataFrame]):
        as_double = OPTIONAL_NUMBERS.get(name, ())
        return lambda spark, sf_dir: plain(build(lake(spark, sf_dir)), as_double)

    return {name: bind(name, build) for name, build in _QUERIES.items()}


# --- bronze -------------------------------------------------------------------------------


@query("bronze_ingest")
def _(l: Lakehouse) -> DataFrame:
    sources = {t: l.raw(t).select(*RAW_SCHEMAS[t].names) for t in TABLES}
    folder = shared_folder(l.spark, "bronze")
    schema = f"bronze_{uuid.uuid4().hex}"  # of its own: a query replaces no table of the user
    l.spark.sql(f"CREATE SCHEMA {schema}")
    try:
        return ingest_all(l.spark, sources=sources, folder=folder, schema=schema).select("table", "success", "rows")
    finally:
        l.spark.sql(f"DROP SCHEMA {schema} CASCADE")


@query("bronze_source_files")
def _(l: Lakehouse) -> DataFrame:
    per_file = [
        add_source_file(l.spark.read.parquet(f"{_sf_dir(l)}/{t}.parquet"))
        .groupBy("source_file")
        .agg(F.count(F.lit(1)).alias("rows"))
        for t in ("region", "nation", "customer", "supplier", "orders", "lineitem", "events", "documents", "labels")
    ]
    name = F.regexp_extract("source_file", r"([a-z]+)\.parquet", 1).alias("source_table")
    return union_reports(*per_file).groupBy(name).agg(F.sum("rows").alias("rows"))


@query("incremental_batch")
def _(l: Lakehouse) -> DataFrame:
    """A third of the events are loaded; the rest, late and tied ones too, comes in a second load."""
    events = l.spark.read.parquet(f"{_sf_dir(l)}/events.parquet")
    loaded = events.where("event_id % 3 = 0")
    whole = loaded.unionByName(new_rows(events, loaded, ["event_id"]))
    return whole.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("event_id").alias("event_ids"))


@query("incremental_load")
def _(l: Lakehouse) -> DataFrame:
    folder = shared_folder(l.spark, "incremental")
    source = l.spark.read.parquet(f"{_sf_dir(l)}/events.parquet")
    for _run in range(2):  # the second run finds nothing new
        ingest_incremental(
            l.spark, f"{_sf_dir(l)}/events*.parquet", f"{folder}/bronze_events", f"{folder}/checkpoint",
            source.schema, source_name="raw.raw_events",
        )
    loaded = l.spark.read.parquet(f"{folder}/bronze_events")
    return loaded.groupBy("event_type", "bronze_source_table").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("event_ids")
    )


def _sf_dir(l: Lakehouse) -> str:
    return l.raw.__self__.sf_dir


# --- silver -------------------------------------------------------------------------------

for _name, _key in (("tickets", "support_tickets"), ("events", "application_events")) + tuple(
    (t, t) for t in TABLES if t not in ("support_tickets", "application_events")
):
    query(f"silver_{_name}")(lambda l, table=_key: l.clean(table))


@query("dedup_latest_payments")
def _(l: Lakehouse) -> DataFrame:
    return dedup_latest(l.raw("payments"), "payment_id", PAYMENT_ORDER).select(
        "payment_id", "application_id", "amount", "status", "payment_time"
    )


@query("dedup_report")
def _(l: Lakehouse) -> DataFrame:
    return union_reports(*[dedup_report(l.raw(t), KEYS[t], t) for t in TABLES])


@query("payment_retry_flag")
def _(l: Lakehouse) -> DataFrame:
    return silver.flag_payment_retry(l.silver("payments")).select(
        "payment_id", "application_id", "status", "attempt_is_retry", "retry_after_failure"
    )


@query("label_standardise")
def _(l: Lakehouse) -> DataFrame:
    methods = {"paypal": "Digital Wallet", "apple pay": "Digital Wallet", "google pay": "Digital Wallet"}
    gateways = {"GW0": "Gateway A", "gw1": "Gateway B"}
    labelled = standardise_labels(l.silver("payments"), "payment_method", methods)
    labelled = standardise_labels(labelled, "payment_gateway", gateways)
    return labelled.groupBy("payment_method", "payment_gateway").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("amount").alias("amount")
    )


@query("fill_defaults")
def _(l: Lakehouse) -> DataFrame:
    filled = fill_defaults(
        l.raw("applications").select("application_id", "user_id", "application_date", "completed_date"),
        {"user_id": -1, "application_date": datetime(1900, 1, 1).date(), "completed_date": datetime(9999, 12, 31).date()},
    )
    return filled.groupBy(
        (F.col("user_id") == -1).alias("no_user"),
        F.year("application_date").alias("application_year"),
        (F.year("completed_date") == 9999).alias("still_open"),
    ).agg(F.count(F.lit(1)).alias("applications"))


@query("cast_reject_counts")
def _(l: Lakehouse) -> DataFrame:
    k = F.col("application_id")
    text = l.raw("applications").select(
        k,
        F.when(k % 300 == 0, "n/a").otherwise(F.col("travel_date").cast("string")).alias("travel_date"),
        F.when(k % 450 == 0, "").otherwise(F.col("country_id").cast("string")).alias("country_id"),
        F.col("passport_id").cast("string").alias("passport_id"),
    )
    types = {"travel_date": "date", "country_id": "int", "passport_id": "bigint"}
    return reject_counts(cast_columns(text, types), list(types))


@query("silver_rates")
def _(l: Lakehouse) -> DataFrame:
    return silver.silver_rates(l.silver("documents"), l.silver("support_tickets"))


@query("preview_users")
def _(l: Lakehouse) -> DataFrame:
    columns = [
        "user_id", "full_name", "email", "country", "age", "age_group", "days_since_signup",
        "verification_status", "device_type", "acquisition_channel",
    ]
    return preview(l.silver("users"), columns)


@query("layer_manifest")
def _(l: Lakehouse) -> DataFrame:
    l.all_silver()
    return l.manifest("silver", TABLES)  # counted while they were written


@query("gold_manifest")
def _(l: Lakehouse) -> DataFrame:
    l.all_gold()
    return l.manifest("gold", GOLD_TABLES)


@query("layer_summary")
def _(l: Lakehouse) -> DataFrame:
    return layer_summary(manifest({f"silver_{t}": df for t, df in l.all_silver().items()}), "silver")


# --- catalog tables, each in a schema of its own -------------------------------------------


@contextmanager
def own_schema(l: Lakehouse) -> Iterator[str]:
    """A schema that no table of the user is in, dropped in the end."""
    schema = f"own_{uuid.uuid4().hex}"
    place = shared_folder(l.spark, schema)
    catalog.ensure_schema(l.spark, schema, location=place)
    try:
        yield schema
    finally:
        l.spark.sql(f"DROP SCHEMA {schema} CASCADE")


def _kept(df: DataFrame) -> DataFrame:
    """A report, written before the tables it was read from are dropped."""
    return store(df, shared_folder(df.sparkSession, "report"))


@query("catalog_scan")
def _(l: Lakehouse) -> DataFrame:
    """A table by its name in the catalog, another by its three-part name in SQL."""
    with own_schema(l) as schema:
        catalog.build_silver("applications", l.silver("applications"), schema=schema, bucket_by=(8, "application_id"))
        catalog.build_silver("countries", l.silver("countries"), schema=schema)
        by_name = catalog.read_table(l.spark, f"{schema}.silver_applications").groupBy(F.col("status").alias("name")).agg(
            F.count(F.lit(1)).alias("rows")
        )
        by_sql = l.spark.sql(
            f"SELECT continent AS name, count(*) AS rows FROM spark_catalog.{schema}.silver_countries GROUP BY continent"
        )
        return _kept(
            by_name.select(F.lit("name").alias("scanned_by"), "*").unionByName(by_sql.select(F.lit("sql").alias("scanned_by"), "*"))
        )


@query("catalog_namespace")
def _(l: Lakehouse) -> DataFrame:
    """A tagged schema, its properties, its tables and their sizes."""
    with own_schema(l) as schema:
        catalog.tag_schema(l.spark, schema, {"description": "Cleaned data", "layer": "silver"})
        for t in TABLES:
            catalog.write_table(l.silver(t), f"{schema}.silver_{t}")
        tags = [("property", k, v) for k, v in catalog.schema_properties(l.spark, schema).items() if k in ("description", "layer")]
        listed = [("table", t, "listed") for t in catalog.list_tables(l.spark, schema)]
        known = [("schema", "own schema", str(schema in catalog.list_schemas(l.spark)).lower())]
        sizes = catalog.layer_manifest(l.spark, schema).select(
            F.lit("rows").alias("kind"), F.col("table_name").alias("name"), F.col("row_count").cast("string").alias("value")
        )
        facts = l.spark.createDataFrame(tags + listed + known, "kind string, name string, value string")
        return _kept(facts.unionByName(sizes))


@query("append_by_status")
def _(l: Lakehouse) -> DataFrame:
    """A table that grows by appends, partitioned by year."""
    apps = l.silver("applications").select("application_id", "status", "application_year")
    with own_schema(l) as schema:
        name = f"{schema}.applications"
        for k, status in enumerate(("Approved", "Pending", "Rejected", "Cancelled")):
            some = apps.where(F.col("status") == status)
            catalog.write_table(some, name, "append" if k else "overwrite", partition_by=["application_year"])
        counted = catalog.layer_manifest(l.spark, schema).first()["row_count"]
        return _kept(l.spark.table(name).groupBy("application_year").agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct("status").alias("statuses"),
            F.lit(counted).cast("bigint").alias("rows_of_table"),
        ))


@query("table_replace")
def _(l: Lakehouse) -> DataFrame:
    """Full refreshes of a table that reads itself, with new columns: silver first, then a gold table over it."""
    users = l.silver("users").select("user_id", "country", "is_verified")
    with own_schema(l) as schema:
        name = f"{schema}.users"
        catalog.write_table(users.where("is_verified"), name)
        catalog.write_table(users, name)
        catalog.write_table(l.spark.table(name).withColumn("half", F.col("user_id") % 2), name)
        for columns in (["country"], ["country", "half"]):
            grouped = l.spark.table(name).groupBy(*columns).agg(
                F.count(F.lit(1)).alias("users"), F.count_if("is_verified").alias("verified")
            )
            catalog.build_gold("users_by_country", grouped, schema=schema)
        return _kept(l.spark.table(f"{schema}.gold_users_by_country").drop("gold_created_timestamp"))


@query("table_comments")
def _(l: Lakehouse) -> DataFrame:
    """Comments on a table and its columns, kept by its next version, and a bounded look at it."""
    with own_schema(l) as schema:
        name = f"{schema}.visa_countries"
        catalog.write_table(l.silver("countries"), name)
        catalog.comment_table(l.spark, name, "Destinations", {"country_id": "the key", "visa_fee_usd": "fee in dollars"})
        catalog.write_table(l.silver("countries").where("country_id >= 0"), name)
        described = catalog.describe(l.spark, name).where("comment is not null and comment <> ''").select(
            "col_name", "data_type", "comment"
        )
        about = catalog.describe(l.spark, name).where("col_name = 'Comment'").select(
            F.lit("(table)").alias("col_name"), F.lit("table").alias("data_type"), F.col("data_type").alias("comment")
        )
        seen = catalog.bounded_read(l.spark, name, 7).agg(
            F.lit("(bounded read)").alias("col_name"), F.lit("rows").alias("data_type"), F.count(F.lit(1)).cast("string").alias("comment")
        )
        return _kept(described.unionByName(about).unionByName(seen))


@query("bronze_audit")
def _(l: Lakehouse) -> DataFrame:
    per_table = [
        catalog.add_audit(l.raw(t).select(*RAW_SCHEMAS[t].names), "bronze", f"raw.raw_{t}", AS_OF)
        .groupBy("bronze_source_table", F.date_format("bronze_ingestion_timestamp", "yyyy-MM-dd HH:mm:ss").alias("ingested_at"))
        .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(KEYS[t]).alias("keys"))
        for t in TABLES
    ]
    return union_reports(*per_table)


@query("dedup_any_applications")
def _(l: Lakehouse) -> DataFrame:
    """Every 200th application arrives twice, alike: any copy will do."""
    return dedup_any(l.raw("applications"), "application_id").select("application_id", "user_id", "status", "completed_date")


# --- versions and increments --------------------------------------------------------------

# A text column of each table that later and earlier versions of a row differ in.
_VERSIONED = {
    "countries": "currency", "visa_types": "visa_type_name", "airports": "airport_name", "users": "city",
    "passports": "issuing_country", "applications": "platform", "payments": "currency", "documents": "document_type",
    "application_events": "event_type", "reviews": "review_text", "support_tickets": "category",
}


@query("silver_versions")
def _(l: Lakehouse) -> DataFrame:
    """All eleven tables with real versions: a third of the keys is corrected later, a fifth had been different before."""

    def versions(table: str) -> DataFrame:
        key, column = F.col(KEYS[table]), _VERSIONED[table]
        extra = PAYMENT_ORDER if table == "payments" else ()
        raw = l.raw(table).select(*RAW_SCHEMAS[table].names, *extra)

        def at(rows: DataFrame, day: str) -> DataFrame:
            return rows.withColumn(silver.ARRIVAL, F.lit(f"{day} 00:00:00").cast("timestamp"))

        late = at(raw.where(key % 3 == 0).withColumn(column, F.lit("new")), "2001-02-01")
        early = at(raw.where(key % 5 == 0).withColumn(column, F.lit("old")), "2000-12-01")
        return late.unionByName(at(raw, "2001-01-01")).unionByName(early)

    return union_reports(*[
        silver.clean_table(t, versions(t), AS_OF, PAYMENT_ORDER).select(
            F.lit(t).alias("table_name"), F.col(KEYS[t]).cast("bigint").alias("key"), F.col(_VERSIONED[t]).alias("value")
        )
        for t in TABLES
    ])


def _payments_in_three_loads(l: Lakehouse) -> tuple[CurrentRows, str]:
    """Payments that arrive in three loads, versions out of order and a tenth of the first load once more, merged by key as
    they come; the revenue cube is refreshed after each load where it is touched."""
    folder = shared_folder(l.spark, "increments")
    raw = l.raw("payments").select(*RAW_SCHEMAS["payments"].names, *PAYMENT_ORDER)
    load = F.pmod(F.xxhash64(*PAYMENT_ORDER, "payment_id"), F.lit(3))
    cube, bronze = f"{folder}/revenue", f"{folder}/bronze"
    current = CurrentRows(l.spark, "payments", f"{folder}/payments", PAYMENT_ORDER, range_keys=200_000)
    month = ["payment_year", "payment_month"]

    def refresh(batch: int) -> None:
        touched = silver.enrich_payments(current.changes(batch))
        refresh_partitions(
            touched, month, lambda wanted: gold.revenue_metrics(
                current.silver().where(wanted), l.silver("applications"), l.silver("countries"), l.silver("visa_types")
            ), cube,
        )

    for number in range(3):
        came = raw.where(load == number)
        if number:
            came = came.unionByName(raw.where((load == 0) & (F.col("payment_id") % 10 == 0)))
        came.write.mode("append").parquet(bronze)
        current.follow(bronze, raw.schema, f"{folder}/checkpoint", refresh)
    return current, cube


_INCREMENTS: dict[int, tuple[CurrentRows, str]] = {}


def _increments(l: Lakehouse) -> tuple[CurrentRows, str]:
    if id(l) not in _INCREMENTS:
        _INCREMENTS[id(l)] = _payments_in_three_loads(l)
    return _INCREMENTS[id(l)]


@query("silver_incremental")
def _(l: Lakehouse) -> DataFrame:
    return _increments(l)[0].silver(AS_OF)


@query("gold_incremental")
def _(l: Lakehouse) -> DataFrame:
    """The revenue cube, kept up to date month by month."""
    _, cube = _increments(l)
    whole = l.plan("revenue_metrics")
    return l.spark.read.schema(whole.schema).parquet(cube).select(*whole.columns)


# --- quality ------------------------------------------------------------------------------


@query("null_report")
def _(l: Lakehouse) -> DataFrame:
    return quality.null_report(
        {
            "raw_users": (l.raw("users"), ["user_id", "email", "dob", "country"]),
            "raw_applications": (l.raw("applications"), ["application_id", "user_id", "application_date", "status"]),
            "raw_payments": (l.raw("payments"), ["payment_id", "payment_time"]),
            "raw_support_tickets": (l.raw("support_tickets"), ["application_id", "resolved_at"]),
        }
    )


@query("key_null_report")
def _(l: Lakehouse) -> DataFrame:
    return quality.key_null_report(l.silver("users"), l.silver("applications"))


@query("fk_report")
def _(l: Lakehouse) -> DataFrame:
    return quality.fk_report(l.all_silver())


@query("dq_score")
def _(l: Lakehouse) -> DataFrame:
    s = l.silver
    return quality.dq_score(s("users"), s("applications"), s("application_events"), s("payments"))


@query("dq_log")
def _(l: Lakehouse) -> DataFrame:
    return l.plan("data_quality_log")


@query("expectation_report")
def _(l: Lakehouse) -> DataFrame:
    raw_apps, apps, pay = l.raw("applications"), l.silver("applications"), l.raw("payments")
    return quality.expectation_report(
        quality.expect_unique(raw_apps, "application_id"),
        quality.expect_unique(apps, "passport_id"),
        quality.expect_between(apps, "processing_days_actual", 0, 20),
        quality.expect_between(pay, "amount", 1, 100_000),
        quality.expect_in(apps, "status", ["Approved", "Rejected", "Pending"]),
        quality.expect_in_set(l.silver("reviews"), "application_id", apps),
        quality.expect_date_range(apps, "application_date", "1993-01-01", AS_OF),
    )


@query("gold_contract")
def _(l: Lakehouse) -> DataFrame:
    return quality.gold_contract(
        l.gold("operational_metrics"),
        ["country_id", "visa_type_id", "application_year", "application_month", "application_week"],
        ["total_applications", "approval_rate", "document_verification_rate"],
    )


@query("schema_drift")
def _(l: Lakehouse) -> DataFrame:
    arrived = l.raw("support_tickets").select(
        "*",
        F.lit("email").alias("channel"),
        F.col("resolution_time_hours").cast("string").alias("hours_text"),
    ).drop("resolution_time_hours", "category").withColumnRenamed("hours_text", "resolution_time_hours")
    return quality.schema_drift(arrived, RAW_SCHEMAS["support_tickets"])


@query("quarantine_report")
def _(l: Lakehouse) -> DataFrame:
    """Applications, as they came, and payments: rows that break a rule set apart and counted in the pass that writes the others."""
    day = F.col("application_date")
    k = F.col("application_id")
    typed = cast_columns(
        l.raw("applications").withColumn("travel_date", F.when(k % 300 == 0, "n/a").otherwise(F.col("travel_date").cast("string"))),
        {"travel_date": "date"},
    )
    rules = {
        "applications": (typed, {
            "types": F.size("rejected_columns") == 0,
            "user known": F.col("user_id").isNotNull(),
            "date known": day.isNotNull(),
            "date in range": day.between(F.lit("1993-01-01").cast("date"), F.lit("1997-12-31").cast("date")),
            "completed after application": F.col("completed_date") >= day,
            "status known": F.col("status").isin("Approved", "Rejected", "Pending"),
        }),
        "payments": (l.raw("payments"), {
            "amount positive": F.col("amount") > 0,
            "amount plausible": F.col("amount").between(1, 450),
            "time known": F.col("payment_time").isNotNull(),
        }),
    }
    reports = []
    for table, (rows, checks) in rules.items():
        split = quarantine(rows, checks, shared_folder(l.spark, f"quarantine-{table}"))
        stored = split.good.select(F.lit("good rows stored").alias("check_name")).unionAll(
            split.rejected.select(F.lit("rejected rows stored"))
        ).groupBy("check_name").agg(F.count(F.lit(1)).alias("rows"))
        reports.append(split.report().unionByName(stored).select(F.lit(table).alias("table_name"), "check_name", "rows"))
    return union_reports(*reports)


@query("dq_history")
def _(l: Lakehouse) -> DataFrame:
    """Two runs of the quality log, of the tables up to 1996 and of all, and what changed between them."""
    history = shared_folder(l.spark, "dq-history")
    s = l.silver
    before = F.col("application_date") < F.lit("1997-01-01").cast("date")
    runs = (
        (s("users"), s("applications").where(before), s("payments").where("payment_year < 1997"), datetime(1997, 1, 1)),
        (s("users"), s("applications"), s("payments"), AS_OF),
    )
    for users, apps, payments, moment in runs:
        recorded = quality.record_run(quality.dq_log(users, apps, payments, moment), history)
    return quality.dq_changes(recorded)


@query("row_count_delta")
def _(l: Lakehouse) -> DataFrame:
    log = l.silver("application_events").groupBy(
        F.col("event_type").alias("table_name"), F.trunc("event_time", "month").alias("run_date")
    ).agg(F.count(F.lit(1)).alias("rows"))
    return change_from_previous(log, "table_name", "run_date", "rows")


# --- payment gap and funnel ---------------------------------------------------------------


@query("payment_gap_by_status")
def _(l: Lakehouse) -> DataFrame:
    return gold.payment_gap_by_status(
        l.silver("applications"), l.silver("payments"), l.gold("unpaid_applications")
    )


@query("payment_gap_by_visa_type")
def _(l: Lakehouse) -> DataFrame:
    s = l.silver
    return gold.payment_gap_by_visa_type(
        s("applications"), s("payments"), s("countries"), s("visa_types"), l.gold("unpaid_applications")
    )


@query("approved_payment_breakdown")
def _(l: Lakehouse) -> DataFrame:
    return gold.approved_payment_breakdown(l.silver("applications"), l.silver("payments"))


for _name, _table in (
    ("application_funnel", "application_funnel"),
    ("payment_reconciliation", "payment_reconciliation"),
    ("revenue_metrics", "revenue_metrics"),
    ("user_cohorts", "user_cohorts"),
    ("operational_metrics", "operational_metrics"),
    ("abandoned_carts", "abandoned_cart_analysis"),
    ("document_friction", "document_friction"),
    ("ticket_impact", "support_ticket_impact"),
):
    query(_name)(lambda l, table=_table: l.plan(table))


@query("application_funnel_bucketed")
def _(l: Lakehouse) -> DataFrame:
    """The funnel over a stored table bucketed by its key: applications are joined where they lie."""
    with own_schema(l) as schema:
        buckets = int(l.spark.conf.get("spark.sql.shuffle.partitions"))
        catalog.build_silver("applications", l.silver("applications"), schema=schema, bucket_by=(buckets, "application_id"))
        apps = l.spark.table(f"{schema}.silver_applications")
        return _kept(gold.application_funnel(apps, l.silver("application_events"), l.silver("payments")))


@query("funnel_overview")
def _(l: Lakehouse) -> DataFrame:
    return gold.funnel_overview(l.gold("application_funnel"))


@query("stage_dropoff")
def _(l: Lakehouse) -> DataFrame:
    return gold.stage_dropoff(l.gold("application_funnel"))


@query("reconciliation_overview")
def _(l: Lakehouse) -> DataFrame:
    return gold.reconciliation_overview(l.gold("payment_reconciliation"))


@query("gap_by_country_top10")
def _(l: Lakehouse) -> DataFrame:
    return gold.gap_by_country(l.gold("payment_reconciliation"))


@query("grain_density")
def _(l: Lakehouse) -> DataFrame:
    return gold.grain_density(l.gold("revenue_metrics"))


@query("validation_report")
def _(l: Lakehouse) -> DataFrame:
    return gold.validation_report(
        gold.approved_payment_breakdown(l.silver("applications"), l.silver("payments")),
        gold.grain_density(l.gold("revenue_metrics")),
    )


@query("operational_metrics_rollup")
def _(l: Lakehouse) -> DataFrame:
    s = l.silver
    return gold.operational_metrics(
        s("applications"), s("documents"), s("support_tickets"), s("countries"), s("visa_types"), rollup=True
    )


@query("operational_weekly")
def _(l: Lakehouse) -> DataFrame:
    return gold.operational_weekly(l.silver("applications"), l.silver("countries"), l.silver("visa_types"))


@query("operational_slice")
def _(l: Lakehouse) -> DataFrame:
    columns = ["application_week", "country_name", "visa_type_name", "total_applications", "late_completion_pct"]
    return slice_rows(
        l.gold("operational_metrics"),
        # the year says nothing new, but the table is partitioned by it
        (F.col("application_week") >= F.lit("1997-01-01").cast("date")) & (F.col("application_year") >= 1997),
        columns,
        [F.desc("application_week"), "country_name", "visa_type_name", "total_applications", "late_completion_pct"],
        10,
    )


@query("revenue_slice")
def _(l: Lakehouse) -> DataFrame:
    columns = [
        "payment_month", "country_name", "visa_type_name", "payment_method", "payment_gateway",
        "total_revenue", "successful_payments",
    ]
    where = (F.col("payment_year") == 1997) & F.col("country_name").isin("NATION_3", "NATION_7", "NATION_12")
    return slice_rows(l.gold("revenue_metrics"), where, columns, ["payment_month", "country_name"])


@query("last_event_per_application")
def _(l: Lakehouse) -> DataFrame:
    return last_event(l.silver("application_events"), "application_id", "event_time", "event_id", ["event_type"])


@query("first_payment_per_application")
def _(l: Lakehouse) -> DataFrame:
    payments = l.silver("payments").select("application_id", "payment_id", "amount", "payment_time")
    apps = l.silver("applications").select("application_id", "status")
    return join_first(apps, payments, "application_id", [F.asc("payment_time"), F.asc("payment_id")])


@query("abandoned_rollup")
def _(l: Lakehouse) -> DataFrame:
    return gold.abandoned_rollup(l.gold("abandoned_applications"))


@query("recovery_tier")
def _(l: Lakehouse) -> DataFrame:
    return (
        gold.recovery_tier(l.gold("abandoned_cart_analysis"))
        .groupBy("recovery_tier", "recovery_stage")
        .agg(
            F.count(F.lit(1)).alias("carts"),
            F.count_distinct("application_id").alias("applications"),
            F.sum("potential_revenue").alias("potential_revenue"),
        )
    )


# --- metrics ------------------------------------------------------------------------------


@query("kpi_overview")
def _(l: Lakehouse) -> DataFrame:
    return gold.kpi_overview(l.silver("applications"), l.silver("payments"))


@query("metric_view_month_country")
def _(l: Lakehouse) -> DataFrame:
    return kpis.revenue_view(l.gold("revenue_metrics")).query(
        by=["payment_month_date", "country_name"], where=F.col("payment_year") == 1997
    )


@query("payment_success_rate")
def _(l: Lakehouse) -> DataFrame:
    return kpis.payment_success_rate(l.silver("payments"))


@query("late_completion_rate")
def _(l: Lakehouse) -> DataFrame:
    return kpis.late_completion_rate(l.silver("applications"))


@query("abandonment_rate")
def _(l: Lakehouse) -> DataFrame:
    return kpis.abandonment_rate(l.silver("applications"))


@query("revenue_at_risk")
def _(l: Lakehouse) -> DataFrame:
    return kpis.revenue_at_risk(l.silver("applications"), l.silver("countries"))


@query("revenue_by_country_top5_other")
def _(l: Lakehouse) -> DataFrame:
    return kpis.revenue_top(l.gold("revenue_metrics"), "country_name")


@query("revenue_by_method")
def _(l: Lakehouse) -> DataFrame:
    return kpis.revenue_breakdown(l.gold("revenue_metrics"), ["payment_method"])


@query("revenue_by_month")
def _(l: Lakehouse) -> DataFrame:
    month = month_start("payment_year", "payment_month").alias("payment_month_date")
    return kpis.revenue_breakdown(l.gold("revenue_metrics"), [month])


@query("applicants_by_period")
def _(l: Lakehouse) -> DataFrame:
    """Distinct applicants by month, quarter, year and in all, from one stored state of bitmaps."""
    state = l.state("applicants", lambda: kpis.applicant_state(l.silver("applications")))

    def period(grain: str) -> DataFrame:
        parts = kpis.PERIODS[grain]
        label = F.concat_ws("-", *[F.col(c).cast("string") for c in parts]) if parts else F.lit("")
        return kpis.applicants(state, grain).select(F.lit(grain).alias("period"), label.alias("label"), "applicants")

    return union_reports(*[period(grain) for grain in kpis.PERIODS])


@query("applicants_by_country")
def _(l: Lakehouse) -> DataFrame:
    """The same stored state by country and year."""
    state = l.state("applicants", lambda: kpis.applicant_state(l.silver("applications")))
    return kpis.applicants(state, "year", ["country_id"])


@query("stage_medians")
def _(l: Lakehouse) -> DataFrame:
    """Median hours of each step by country and in all, from one stored state."""
    hours = l.state("stage_hours", lambda: kpis.stage_hours(l.gold("application_funnel")))
    by_country = kpis.stage_medians(hours, ["country_id"])
    return by_country.unionByName(kpis.stage_medians(hours).withColumn("country_id", F.lit(-1)))


@query("abandonment_by_visa_type")
def _(l: Lakehouse) -> DataFrame:
    return kpis.abandonment_by(l.silver("applications"), ["visa_type_id"])


@query("abandonment_by_month")
def _(l: Lakehouse) -> DataFrame:
    return kpis.abandonment_by(l.silver("applications"), ["application_year", "application_month"])


@query("trend_by_visa_type")
def _(l: Lakehouse) -> DataFrame:
    return kpis.application_trend(l.silver("applications"), ["visa_type_id"])


@query("payment_health_by_visa_type")
def _(l: Lakehouse) -> DataFrame:
    return kpis.payment_health(l.gold("revenue_metrics"), ["visa_type_name", "payment_method"])


@query("trend_weekly")
def _(l: Lakehouse) -> DataFrame:
    return kpis.application_trend(l.silver("applications"), [week_start("application_date").alias("application_week")])


@query("trend_by_status")
def _(l: Lakehouse) -> DataFrame:
    return kpis.application_trend(l.silver("applications"), ["status"])


@query("threshold_status")
def _(l: Lakehouse) -> DataFrame:
    by_country = kpis.application_trend(l.silver("applications"), ["country_id"])
    health = by_country.withColumn("on_time_pct", F.round(100 - F.col("late_pct"), 2))
    return kpis.kpi_status(health, "late_pct", "avg_processing_days", "on_time_pct")


@query("row_filter_region")
def _(l: Lakehouse) -> DataFrame:
    allowed = l.silver("countries").where(F.col("continent") == "ASIA").select("country_id")
    return row_filter(l.gold("revenue_metrics"), "country_id", allowed).groupBy("country_name").agg(
        F.count(F.lit(1)).alias("cells"), F.sum("total_revenue").alias("total_revenue")
    )


@query("abandonment_by_country")
def _(l: Lakehouse) -> DataFrame:
    return kpis.abandonment_by(l.silver("applications"), ["country_id"])


@query("abandonment_by_stage")
def _(l: Lakehouse) -> DataFrame:
    funnel = l.gold("application_funnel").withColumnRenamed("final_status", "status")
    return kpis.abandonment_by(funnel, ["stage_reached"])


@query("stage_durations")
def _(l: Lakehouse) -> DataFrame:
    return kpis.stage_durations(l.gold("application_funnel"), ["visa_type_id"])


@query("approval_trend")
def _(l: Lakehouse) -> DataFrame:
    return kpis.approval_trend(l.silver("applications"), F.trunc("application_date", "month").alias("application_month_date"))


@query("pending_ageing")
def _(l: Lakehouse) -> DataFrame:
    return kpis.pending_ageing(l.gold("abandoned_applications"))


@query("cohort_summary")
def _(l: Lakehouse) -> DataFrame:
    return kpis.cohort_summary(l.gold("user_cohorts"), "acquisition_channel")


@query("payment_health")
def _(l: Lakehouse) -> DataFrame:
    return kpis.payment_health(l.gold("revenue_metrics"), ["payment_gateway", "payment_method"])


@query("ops_kpis")
def _(l: Lakehouse) -> DataFrame:
    return kpis.ops_kpis(l.silver("applications"), l.silver("payments"))


@query("recovery_targets")
def _(l: Lakehouse) -> DataFrame:
    return kpis.recovery_targets(l.gold("abandoned_applications"), 150, AS_OF)


@query("retry_due")
def _(l: Lakehouse) -> DataFrame:
    return kpis.retry_due(l.silver("payments"), AS_OF)
