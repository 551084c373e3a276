"""Silver and gold tables of one set of raw tables, written once and shared by all queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TABLES
from ..session import shared_folder, store_counted
from . import gold
from .quality import dq_log
from .silver import clean_table

#: What a stored table is partitioned by: columns of few values that readers filter on.
PARTITIONS = {"gold_revenue_metrics": ("payment_year",), "gold_operational_metrics": ("application_year",)}

RUN_SCHEMA = "table_name string, row_count long, location string"

# The gold tables users read.
GOLD_TABLES = (
    "application_funnel",
    "payment_reconciliation",
    "revenue_metrics",
    "user_cohorts",
    "operational_metrics",
    "abandoned_cart_analysis",
    "document_friction",
    "support_ticket_impact",
    "data_quality_log",
)


def gold_plan(
    name: str,
    silver: Callable[[str], DataFrame],
    as_of=None,
    unpaid: Callable[[], DataFrame | None] = lambda: None,
    counts: Callable[[], DataFrame | None] = lambda: None,
) -> DataFrame:
    """A gold table over silver tables given by name.

    ``unpaid`` and ``counts`` supply stored forms of ``unpaid_applications`` and ``gap_counts``, if there are any."""
    s = silver
    plans: dict[str, Callable[[], DataFrame]] = {
        "application_funnel": lambda: gold.application_funnel(
            s("applications"), s("application_events"), s("payments")
        ),
        "unpaid_applications": lambda: gold.unpaid_applications(
            s("applications").select(*gold.UNPAID_COLUMNS), s("payments")
        ),
        "gap_counts": lambda: gold.gap_counts(
            gold.unpaid_applications(s("applications"), s("payments")) if unpaid() is None else unpaid()
        ),
        "payment_reconciliation": lambda: gold.payment_reconciliation(
            s("applications"), s("payments"), s("countries"), s("visa_types"), as_of, unpaid(), counts()
        ),
        "revenue_metrics": lambda: gold.revenue_metrics(
            s("payments"), s("applications"), s("countries"), s("visa_types")
        ),
        "user_cohorts": lambda: gold.user_cohorts(
            s("users"), s("passports"), s("applications"), s("payments")
        ),
        "operational_metrics": lambda: gold.operational_metrics(
            s("applications"), s("documents"), s("support_tickets"), s("countries"), s("visa_types")
        ),
        "abandoned_cart_analysis": lambda: gold.abandoned_carts(
            s("applications"), s("application_events"), s("payments"), s("countries"), s("visa_types"), as_of
        ),
        "abandoned_applications": lambda: gold.abandoned_applications(
            s("applications"), s("application_events"), s("countries"), s("visa_types"), as_of
        ),
        "document_friction": lambda: gold.document_friction(
            s("applications"), s("documents"), s("countries"), s("visa_types")
        ),
        "support_ticket_impact": lambda: gold.ticket_impact(
            s("support_tickets"), s("applications"), s("users"), s("reviews"), as_of
        ),
        "data_quality_log": lambda: dq_log(s("users"), s("applications"), s("payments"), as_of),
    }
    return plans[name]()


class Lakehouse:
    """Lazy access to silver and gold.

    Deduplicating a fact table shuffles all of it.  Doing so inside every query would repeat the
    dearest step of the pipeline, so the first use of a silver table writes it to the shared
    folder of the session and later uses scan the columns they need.  The written files also give
    Spark true sizes to choose joins by.  Executors may be lost at any time: files stay.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: Callable[[str], DataFrame],
        as_of=None,
        payment_order: Sequence[str] = ("payment_time",),
        folder: str | None = None,
    ):
        self.spark = spark
        self.raw = raw
        self.as_of = as_of
        self.payment_order = payment_order
        self._folder = folder
        self._written: dict[str, DataFrame] = {}
        self._locks: dict[str, Lock] = {}

    @property
    def folder(self) -> str:
        with self._locks.setdefault("folder", Lock()):
            if self._folder is None:
                self._folder = shared_folder(self.spark, "lakehouse")
            return self._folder

    def clean(self, name: str) -> DataFrame:
        """The silver form of a table as a lazy plan over its raw table."""
        return clean_table(name, self.raw(name), self.as_of, self.payment_order)

    def _stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        with self._locks.setdefault(name, Lock()):
            if name not in self._written:
                path = f"{self.folder}/{name}"
                self._written[name], rows = store_counted(build(), path, PARTITIONS.get(name, ()))
                run = self.spark.createDataFrame([(name, rows, path)], RUN_SCHEMA)
                run.write.mode("overwrite").parquet(f"{self.folder}/_runs/table={name}")
            return self._written[name]

    def manifest(self, layer: str, tables: Sequence[str]) -> DataFrame:
        """Row count of stored tables, as counted while they were written: only the run table is read, no data."""
        runs = self.spark.read.schema(RUN_SCHEMA).parquet(f"{self.folder}/_runs")
        names = [f"{layer}_{t}" for t in tables]
        return runs.where(F.col("table_name").isin(names)).select("table_name", "row_count").orderBy("table_name")

    def _each(self, names: Sequence[str], get: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
        """Several tables at a time, so the tail of one is filled by the next."""
        with ThreadPoolExecutor(4) as pool:
            return dict(zip(names, pool.map(get, names)))

    def silver(self, name: str) -> DataFrame:
        return self._stored(f"silver_{name}", lambda: self.clean(name))

    def state(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A mergeable state that several questions are answered from, written on first use."""
        return self._stored(f"state_{name}", build)

    def all_silver(self) -> dict[str, DataFrame]:
        return self._each(TABLES, self.silver)

    def plan(self, name: str) -> DataFrame:
        """A gold table as a lazy plan over silver."""
        return gold_plan(
            name, self.silver, self.as_of, lambda: self.gold("unpaid_applications"), lambda: self.gold("gap_counts")
        )

    def gold(self, name: str) -> DataFrame:
        """A gold table, written on first use."""
        return self._stored(f"gold_{name}", lambda: self.plan(name))

    def all_gold(self) -> dict[str, DataFrame]:
        self.all_silver()
        return self._each(GOLD_TABLES, self.gold)
