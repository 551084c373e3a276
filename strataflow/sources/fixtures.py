"""The eleven raw tables derived from the generic test tables (see FIXTURES.md).

Each builder scans its inputs once and is a plain projection, filter or equi-join, so the test
inputs grow with the given data.  Faults (NULLs, duplicates, orphans, bad e-mails) are injected
by arithmetic on the keys.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Columns that give the source rows of one payment a total order; dropped after cleaning.
PAYMENT_ORDER = ("source_date", "source_part", "source_supplier")


class Fixtures:
    """Raw tables over one folder of test parquet files."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def raw(self, name: str) -> DataFrame:
        return _BUILDERS[name](self)

    # dimensions
    def _countries(self) -> DataFrame:
        n = F.col("n_nationkey")
        nations = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return nations.select(
            n.alias("country_id"),
            F.col("n_name").alias("country_name"),
            F.col("r_name").alias("continent"),
            (20 + (n * 7) % 166).cast("decimal(10,2)").alias("visa_fee_usd"),
            F.lit("USD").alias("currency"),
            (3 + n % 20).cast("int").alias("processing_days"),
            ((40 + (n % 12) * 5).cast("decimal(6,2)") / F.lit(100)).cast("decimal(4,2)").alias("approval_rate"),
        )

    def _visa_types(self) -> DataFrame:
        p = F.col("o_orderpriority")
        return (
            self.table("orders")
            .select(_visa_type_id(p).alias("visa_type_id"), F.substring(p, 3, 100).alias("visa_type_name"))
            .distinct()
        )

    def _airports(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("airport_id"),
            F.col("s_name").alias("airport_name"),
            F.col("s_nationkey").alias("country_id"),
        )

    def _users(self) -> DataFrame:
        k = F.col("c_custkey")
        key = k.cast("string")
        customers = self.table("customer").join(
            self.table("nation").select("n_nationkey", "n_name"),
            F.col("c_nationkey") == F.col("n_nationkey"),
        )
        return customers.select(
            k.alias("user_id"),
            F.concat(F.lit(" "), F.substring("c_name", 1, 8), F.lit(" ")).alias("first_name"),
            F.substring("c_name", 10, 100).alias("last_name"),
            F.when(k % 50 == 0, F.concat(F.lit("bad-"), key))
            .otherwise(F.concat(F.lit(" User"), key, F.lit("@Example.com ")))
            .alias("email"),
            F.concat(F.lit("+1"), key).alias("phone"),
            F.when(k % 2 == 0, "F").otherwise("M").alias("gender"),
            F.when(k % 211 != 0, F.date_add(F.lit("1945-01-01").cast("date"), ((k * 37) % 18000).cast("int"))).alias("dob"),
            F.date_add(F.lit("1994-01-01").cast("date"), ((k * 11) % 2500).cast("int")).alias("signup_date"),
            F.col("n_name").alias("country"),
            F.concat(F.lit("City"), (k % 40).cast("string")).alias("city"),
            F.when(k % 2 == 0, "Mobile").otherwise("Desktop").alias("device_type"),
            _pick(k % 3, "iOS", "Android", "Windows").alias("os"),
            F.col("c_mktsegment").alias("acquisition_channel"),
            (k % 3 != 0).alias("is_verified"),
        )

    def _passports(self) -> DataFrame:
        k = F.col("c_custkey")
        second = (k % 25 == 0).cast("int")
        shift = F.when(F.col("nth") == 1, 2).when(k % 10 == 0, 1).otherwise(0)
        issued = self.table("customer").select(
            k, "c_nationkey", F.explode(F.sequence(F.lit(0), second)).alias("nth")
        ).select(
            (k + F.col("nth") * 1_000_000).cast("long").alias("passport_id"),
            k.alias("user_id"),
            ((F.col("c_nationkey") + shift) % 25).alias("_nation"),
        )
        nations = self.table("nation").select(
            F.col("n_nationkey").alias("_nation"), F.col("n_name").alias("issuing_country")
        )
        return issued.join(nations, "_nation").drop("_nation")

    # facts
    def _applications(self) -> DataFrame:
        k, c = F.col("o_orderkey"), F.col("o_custkey")
        day = F.col("o_orderdate").cast("date")
        state, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
        customers = self.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
        # every 200th application arrives twice
        arrivals = F.explode(F.sequence(F.lit(0), (k % 200 == 0).cast("int"))).alias("_copy")
        orders = self.table("orders").join(customers, "o_custkey").select("*", arrivals)
        return orders.select(
            k.alias("application_id"),
            F.when(k % 500 != 499, c).alias("user_id"),
            F.col("c_nationkey").alias("country_id"),
            _visa_type_id(priority).alias("visa_type_id"),
            c.alias("passport_id"),
            F.when(k % 997 != 996, day).alias("application_date"),
            F.date_add(day, (20 + k % 90).cast("int")).alias("travel_date"),
            F.when(state == "F", "Approved")
            .when(state == "O", "Pending")
            .when(priority.isin("1-URGENT", "2-HIGH"), "Rejected")
            .otherwise("Cancelled")
            .alias("status"),
            F.date_add(day, (5 + c % 15).cast("int")).alias("expected_completion"),
            F.when(state != "O", F.date_add(day, ((k * 7) % 31).cast("int"))).alias("completed_date"),
            _pick(k % 3, "web", "app", "agent").alias("source"),
            _pick(c % 3, "iOS", "Android", "Web").alias("platform"),
        )

    def _payments(self) -> DataFrame:
        part, supplier = F.col("l_partkey"), F.col("l_suppkey")
        # remainder of the price in whole cents; converting the double itself to decimal is slow
        cents = F.floor(F.col("l_extendedprice") * 100 + 0.5) % 50_000
        amount = (cents.cast("decimal(10,0)") * F.lit(Decimal("0.01"))).cast("decimal(10,2)")
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("payment_id"),
            F.col("l_orderkey").alias("application_id"),
            F.when(part % 400 == 0, F.lit(-1).cast("decimal(10,2)"))
            .otherwise(amount)
            .alias("amount"),
            F.lit("USD").alias("currency"),
            _pick(
                supplier % 6,
                "Credit Card", "Debit Card", "PayPal", "Bank Transfer", "Apple Pay", "Google Pay",
            ).alias("payment_method"),
            F.concat(F.lit("gw"), (part % 5).cast("string")).alias("payment_gateway"),
            F.when(F.col("l_returnflag") == "R", "Failed").otherwise("Completed").alias("status"),
            F.when(part % 777 != 0, _plus_seconds("l_shipdate", supplier % 24 * 3600)).alias("payment_time"),
            F.col("l_shipdate").alias(PAYMENT_ORDER[0]),
            part.alias(PAYMENT_ORDER[1]),
            supplier.alias(PAYMENT_ORDER[2]),
        )

    def _event_orders(self) -> DataFrame:
        """Events with the application they belong to."""
        events = self.table("events").withColumn("o_orderkey", F.col("user_id") * 100 + F.dayofmonth("ts"))
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        offset = (F.col("event_id") % 5) * 86400 + F.hour("ts") * 3600 + F.minute("ts") * 60
        return (
            events.drop("user_id")
            .join(orders, "o_orderkey")
            .withColumn("event_time", _plus_seconds("o_orderdate", offset))
            .withColumn("k", F.regexp_extract("props", "([0-9]+)", 1).cast("int"))
        )

    def _application_events(self) -> DataFrame:
        kind = F.col("event_type")
        return self._event_orders().select(
            "event_id",
            F.col("o_orderkey").alias("application_id"),
            F.when(kind == "view", "Application Created")
            .when(kind == "click", "Documents Submitted")
            .when(kind == "signup", "Verification Started")
            .when(kind == "purchase", "Approved")
            .when(F.col("event_id") % 2 == 0, "Rejected")
            .otherwise("Cancelled")
            .alias("event_type"),
            "event_time",
        )

    def _support_tickets(self) -> DataFrame:
        k, solved = F.col("k"), F.col("k") < 65
        return self._event_orders().where("event_type = 'error'").select(
            F.col("event_id").alias("ticket_id"),
            F.col("o_custkey").alias("user_id"),
            F.when(F.col("event_id") % 7 != 0, F.col("o_orderkey")).alias("application_id"),
            _pick(k % 4, "Payment", "Documents", "Status", "Technical").alias("category"),
            _pick(k % 3, "High", "Medium", "Low").alias("priority"),
            F.when(solved, "Resolved").otherwise("Open").alias("status"),
            F.col("event_time").alias("created_at"),
            F.when(solved, _plus_seconds("event_time", F.floor(F.col("value") * 3600))).alias("resolved_at"),
            F.when(solved, F.col("value")).alias("resolution_time_hours"),
        )

    def _reviews(self) -> DataFrame:
        e = F.col("event_id")
        return self._event_orders().where("event_type = 'purchase'").select(
            e.alias("review_id"),
            F.when(e % 50 == 0, -1 - e).otherwise(F.col("o_orderkey")).alias("application_id"),
            F.col("o_custkey").alias("user_id"),
            (1 + F.col("k") % 5).cast("int").alias("rating"),
            F.concat(F.lit("review "), F.col("k").cast("string")).alias("review_text"),
        )

    def _documents(self) -> DataFrame:
        documents = self.table("documents").select(
            "doc_id", "lang", "n_chars", F.floor(F.col("doc_id") / 2).cast("long").alias("o_orderkey")
        )
        orders = self.table("orders").select("o_orderkey", "o_orderdate")
        doc, labelled = F.col("doc_id"), F.col("quality").isNotNull()
        checked = doc % 48 + F.col("n_chars") % 120
        return (
            documents.join(self.table("labels").select("doc_id", "quality"), "doc_id", "left")
            .join(orders, "o_orderkey")
            .select(
                doc.alias("document_id"),
                F.col("o_orderkey").alias("application_id"),
                F.col("lang").alias("document_type"),
                F.coalesce(F.col("quality") == 1, F.lit(False)).alias("verified"),
                _plus_seconds("o_orderdate", doc % 48 * 3600).alias("upload_time"),
                F.when(labelled, _plus_seconds("o_orderdate", checked * 3600)).alias("verification_time"),
            )
        )


def _visa_type_id(priority: Column) -> Column:
    return F.substring(priority, 1, 1).cast("int")


def _pick(index: Column, *labels: str) -> Column:
    chain = F
    for position, label in enumerate(labels[:-1]):
        chain = chain.when(index == position, label)
    return chain.otherwise(labels[-1])


def _plus_seconds(moment: str, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("int"), F.col(moment)).cast("timestamp_ntz")


_BUILDERS: dict[str, Callable[[Fixtures], DataFrame]] = {
    "countries": Fixtures._countries,
    "visa_types": Fixtures._visa_types,
    "airports": Fixtures._airports,
    "users": Fixtures._users,
    "passports": Fixtures._passports,
    "applications": Fixtures._applications,
    "payments": Fixtures._payments,
    "documents": Fixtures._documents,
    "application_events": Fixtures._application_events,
    "reviews": Fixtures._reviews,
    "support_tickets": Fixtures._support_tickets,
}
