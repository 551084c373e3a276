"""Data-quality reports, scores and expectations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import as_time, count_where, email_ok, flag, pct
from ..operators.joins import without_match
from ..operators.shaping import long_form, union_reports
from ..schemas import FOREIGN_KEYS

# Weights of the four criteria.
WEIGHTS = {"completeness": 30, "uniqueness": 25, "validity": 25, "consistency": 20}


def _rows():
    return F.count(F.lit(1))


def null_counts(df: DataFrame, table_name: str, columns: Sequence[str]) -> DataFrame:
    """One row per column: table, column, rows, NULLs.  One pass over the table."""
    counted = df.agg(
        F.lit(table_name).alias("table_name"),
        _rows().alias("total_rows"),
        *[count_where(F.col(c).isNull()).alias(c) for c in columns],
    )
    return long_form(counted, columns, "column_name", "null_rows", keep=["table_name", "total_rows"])


def null_report(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """NULLs per key column of several tables, one row per column."""
    return union_reports(*[null_counts(df, name, columns) for name, (df, columns) in tables.items()])


def key_null_report(users: DataFrame, apps: DataFrame) -> DataFrame:
    """The same figures side by side, one row per table.  The second table follows the column
    order of the first, so its three counts are id, user and status."""
    names = ("null_user_ids", "null_emails", "null_countries")

    def row(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
        return df.agg(
            F.lit(table).alias("table_name"),
            _rows().alias("total_rows"),
            *[count_where(F.col(c).isNull()).alias(n) for c, n in zip(columns, names)],
        )

    return union_reports(
        row(users, "silver_users", ("user_id", "email", "country")),
        row(apps, "silver_applications", ("application_id", "user_id", "status")),
    )


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str, nulls: bool = True) -> DataFrame:
    """One row with ``orphaned_records``: child rows whose key is not in the parent.

    Child rows are counted per key before the join, so a hot key is one row there.  ``nulls``
    says whether a missing key is an orphan."""
    per_key = child.groupBy(F.col(key).alias("_key")).agg(_rows().alias("n"))
    if not nulls:
        per_key = per_key.where(F.col("_key").isNotNull())
    lost = per_key.join(parent.select(F.col(parent_key).alias("_key")), "_key", "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphaned_records"))


def fk_report(tables: Mapping[str, DataFrame], relations=FOREIGN_KEYS) -> DataFrame:
    """Orphans of every foreign key: table, orphaned records, key.

    Each child is read once for all its keys.  Its keys are stacked with the number of their relation and counted
    before any join, so a hot key is one row; then the stack meets each parent once, whatever the number of its children."""
    stacked = []
    for child in dict.fromkeys(r[0] for r in relations):
        entries = [
            F.struct(F.lit(k).alias("relation"), F.lit(parent).alias("parent"), F.col(key).cast("bigint").alias("key"))
            for k, (of, key, parent, _) in enumerate(relations)
            if of == child
        ]
        stacked.append(tables[child].select(F.explode(F.array(*entries)).alias("e")).select("e.*"))
    optional = [k for k, relation in enumerate(relations) if not relation[3]]
    counted = union_reports(*stacked).groupBy("relation", "parent", "key").agg(_rows().alias("n"))
    counted = counted.where(F.col("key").isNotNull() | ~F.col("relation").isin(optional))
    parent_key = {parent: key for _, key, parent, _ in relations}
    known = union_reports(
        *[
            tables[p].select(F.lit(p).alias("parent"), F.col(k).cast("bigint").alias("key"), F.lit(True).alias("known"))
            for p, k in parent_key.items()
        ]
    )
    # an anti join would be pushed below the stack, and each parent read for each child
    lost = counted.join(known, ["parent", "key"], "left").where(F.col("known").isNull()).select("relation", "n")
    names = [
        F.struct(F.lit(k).alias("relation"), F.lit(child).alias("table_name"), F.lit(key).alias("foreign_key"))
        for k, (child, key, _, _) in enumerate(relations)
    ]
    every = lost.sparkSession.range(1).select(F.explode(F.array(*names)).alias("r")).select("r.*")
    found = lost.groupBy("relation").agg(F.sum("n").alias("n"))
    return every.join(found, "relation", "left").select(
        "table_name", F.coalesce("n", F.lit(0).cast("bigint")).alias("orphaned_records"), "foreign_key"
    )


# --- score --------------------------------------------------------------------------------
# Each criterion is one row: good, checked.


def _null_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = F.lit(0).cast("bigint")
    for c in columns:
        missing = missing + count_where(F.col(c).isNull())
    checked = _rows() * len(columns)
    return df.agg((checked - missing).alias("good"), checked.alias("checked"))


def _sum_parts(*parts: DataFrame) -> DataFrame:
    return union_reports(*parts).agg(F.sum("good").alias("good"), F.sum("checked").alias("checked"))


def completeness(tables: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Filled cells among the critical columns."""
    return _sum_parts(*[_null_cells(df, columns) for df, columns in tables])


def uniqueness(tables: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Distinct keys among the rows."""
    return _sum_parts(
        *[
            df.agg(F.count_distinct(key).alias("good"), _rows().alias("checked"))
            for df, key in tables
        ]
    )


def validity(df: DataFrame, email: str = "email") -> DataFrame:
    """Rows with a well-formed e-mail."""
    return df.agg(count_where(email_ok(email)).alias("good"), _rows().alias("checked"))


def consistency(children: Sequence[tuple[DataFrame, str]], parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct child keys that exist in the parent, over several child tables."""
    known = parent.select(F.col(parent_key).alias("_key"), F.lit(True).alias("_known"))

    def part(df: DataFrame, key: str) -> DataFrame:
        keys = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_key")).distinct()
        return keys.join(known, "_key", "left").agg(
            F.count("_known").alias("good"), _rows().alias("checked")
        )

    return _sum_parts(*[part(df, key) for df, key in children])


def dq_score(users: DataFrame, apps: DataFrame, events: DataFrame, payments: DataFrame) -> DataFrame:
    """Score per criterion with its weight and points, and the weighted total ("final")."""
    criteria = {
        "completeness": completeness(
            [(users, ["user_id", "email", "country"]), (apps, ["application_id", "user_id", "status"])]
        ),
        "uniqueness": uniqueness([(users, "user_id"), (apps, "application_id")]),
        "validity": validity(users),
        "consistency": consistency(
            [(events, "application_id"), (payments, "application_id")], apps, "application_id"
        ),
    }
    scored = union_reports(
        *[
            row.select(
                F.lit(name).alias("criterion"),
                F.lit(WEIGHTS[name]).alias("weight"),
                pct(F.col("good"), F.col("checked")).alias("score"),
            )
            for name, row in criteria.items()
        ]
    ).withColumn("points", F.round(F.col("score") * F.col("weight") / 100, 4))
    # grouping sets over four rows: the rows themselves and their total
    return scored.rollup("criterion").agg(
        F.sum("weight").cast("int").alias("weight"),
        F.when(F.grouping("criterion") == 0, F.max("score")).alias("score"),
        F.round(F.sum("points"), 4).alias("points"),
    ).select(F.coalesce("criterion", F.lit("final")).alias("criterion"), "weight", "score", "points")


def dq_log(users: DataFrame, apps: DataFrame, payments: DataFrame, checked_at=None) -> DataFrame:
    """Five checks with issue count, rates, weight, contribution and the moment of the check (default: now).

    The status follows from the result: "Passed" without issues, "Failed" with them;
    "Documented" marks the check that reports a known business gap."""
    n = _rows()
    users_row = users.agg(
        (n * 3).alias("cells"),
        (
            count_where(F.col("user_id").isNull())
            + count_where(F.col("email").isNull())
            + count_where(F.col("country").isNull())
        ).alias("nulls"),
        n.alias("rows"),
        count_where(flag(~email_ok("email"))).alias("bad_emails"),
    )
    keys_row = apps.agg(
        F.lit("silver_applications").alias("table_affected"),
        (n - F.count_distinct("application_id")).alias("issue_count"),
        n.alias("total_checks"),
    )
    payment_rows = payments.agg(n).scalar()
    orphan_row = orphans(payments, "application_id", apps, "application_id").select(
        F.lit("silver_payments").alias("table_affected"),
        F.col("orphaned_records").alias("issue_count"),
        payment_rows.alias("total_checks"),
    )
    approved = apps.where(F.col("status") == "Approved").select("application_id")
    paid = payments.select("application_id", F.lit(1).alias("_paid")).distinct()
    gap_row = approved.join(paid, "application_id", "left").agg(
        F.lit("silver_applications").alias("table_affected"),
        count_where(F.col("_paid").isNull()).alias("issue_count"),
        n.alias("total_checks"),
    )
    # two checks from the one pass over users
    users_rows = users_row.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit("Completeness").alias("check_category"),
                    F.lit("Critical Columns Null Check").alias("check_name"),
                    F.lit("silver_users").alias("table_affected"),
                    F.col("nulls").alias("issue_count"),
                    F.col("cells").alias("total_checks"),
                    F.lit("High").alias("severity"),
                    F.lit(30.0).alias("rubric_score_weight"),
                ),
                F.struct(
                    F.lit("Validity").alias("check_category"),
                    F.lit("Email Format Validation").alias("check_name"),
                    F.lit("silver_users").alias("table_affected"),
                    F.col("bad_emails").alias("issue_count"),
                    F.col("rows").alias("total_checks"),
                    F.lit("Medium").alias("severity"),
                    F.lit(25.0).alias("rubric_score_weight"),
                ),
            )
        ).alias("r")
    ).select("r.*")

    def named(df: DataFrame, category: str, name: str, severity: str, weight: float) -> DataFrame:
        return df.select(
            F.lit(category).alias("check_category"),
            F.lit(name).alias("check_name"),
            "table_affected", "issue_count", "total_checks",
            F.lit(severity).alias("severity"),
            F.lit(weight).alias("rubric_score_weight"),
        )

    checks = union_reports(
        users_rows,
        named(keys_row, "Uniqueness", "Primary Key Duplication", "High", 25.0),
        named(orphan_row, "Consistency", "Orphaned Payment Records", "Critical", 20.0),
        named(gap_row, "Business Rule", "Approved Without Payment", "Medium", 0.0),
    )
    issues, total, weight = F.col("issue_count"), F.col("total_checks"), F.col("rubric_score_weight")
    status = (
        F.when(F.col("check_category") == "Business Rule", "Documented")
        .when(issues == 0, "Passed")
        .otherwise("Failed")
    )
    return checks.select(
        "check_category", "check_name", "table_affected", "issue_count", "total_checks",
        pct(issues, total).alias("issue_pct"),
        pct(total - issues, total).alias("pass_rate"),
        "severity", status.alias("resolution_status"), "rubric_score_weight",
        F.round(F.try_divide((total - issues) * weight, total), 2).alias("weighted_score_contribution"),
        as_time(checked_at).alias("checked_at"),
    )


def record_run(log: DataFrame, history: str) -> DataFrame:
    """Append a run of ``dq_log`` to the history at the path ``history`` and return the whole history.

    Runs are only ever added: each is a write of its own, named by its moment, and one that is repeated replaces itself alone."""
    run = log.withColumn("run", F.date_format("checked_at", "yyyyMMdd'T'HHmmss"))
    run.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("run").parquet(history)
    kinds = run.schema
    return log.sparkSession.read.schema(kinds).parquet(history).select(*log.columns)


def dq_changes(history: DataFrame) -> DataFrame:
    """Each check of each run with its change against the run before: new issues, change of the pass rate, and whether it got worse.

    A run is a handful of rows; a check has as many as there were runs."""
    before = Window.partitionBy("check_category", "check_name", "table_affected").orderBy("checked_at")
    return history.withColumns({
        "previous_issue_count": F.lag("issue_count").over(before),
        "previous_pass_rate": F.lag("pass_rate").over(before),
    }).select(
        "checked_at", "check_category", "check_name", "table_affected", "issue_count", "total_checks", "pass_rate",
        "resolution_status", "previous_issue_count",
        (F.col("issue_count") - F.col("previous_issue_count")).alias("new_issues"),
        F.round(F.col("pass_rate") - F.col("previous_pass_rate"), 2).alias("pass_rate_change"),
        flag(F.col("pass_rate") < F.col("previous_pass_rate")).alias("is_worse"),
    )


# --- expectations -------------------------------------------------------------------------
# Each expectation is one row: expectation, column_name, checked_rows, failed_rows, success.


def _result(df: DataFrame, kind: str, column: str) -> DataFrame:
    """``df`` is one row with checked_rows and failed_rows."""
    return df.select(
        F.lit(kind).alias("expectation"),
        F.lit(column).alias("column_name"),
        "checked_rows",
        "failed_rows",
        (F.col("failed_rows") == 0).alias("success"),
    )


def _expect_rows(df: DataFrame, kind: str, column: str, ok) -> DataFrame:
    """NULLs are not judged by a row rule."""
    return _result(
        df.agg(F.count(column).alias("checked_rows"), count_where(~ok).alias("failed_rows")), kind, column
    )


def expect_unique(df: DataFrame, column: str) -> DataFrame:
    """Rows that share their value with another row fail."""
    per_value = df.groupBy(column).agg(F.count(column).alias("n"))
    return _result(
        per_value.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("checked_rows"),
            F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("failed_rows"),
        ),
        "unique",
        column,
    )


def expect_between(df: DataFrame, column: str, low, high) -> DataFrame:
    return _expect_rows(df, "between", column, F.col(column).between(low, high))


def expect_in(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    return _expect_rows(df, "in", column, F.col(column).isin(*values))


def expect_in_set(df: DataFrame, column: str, reference: DataFrame, reference_column: str | None = None) -> DataFrame:
    """Values must occur in another table's column; values are counted before the join."""
    per_value = df.where(F.col(column).isNotNull()).groupBy(column).agg(_rows().alias("n"))
    known = reference.select(
        F.col(reference_column or column).alias(column), F.lit(1).alias("_known")
    ).distinct()
    return _result(
        per_value.join(known, column, "left").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("checked_rows"),
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("failed_rows"),
        ),
        "in_set",
        column,
    )


def expect_date_range(df: DataFrame, column: str, low, as_of) -> DataFrame:
    """Dates from ``low`` to the reference date; a future date fails."""
    low, high = F.lit(str(low)).cast("date"), F.lit(str(as_of)).cast("timestamp_ntz").cast("date")
    return _expect_rows(df, "date_range", column, F.col(column).cast("date").between(low, high))


def expectation_report(*results: DataFrame) -> DataFrame:
    return union_reports(*results)


def schema_drift(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Columns that are missing, unexpected or of another type, with the rows they affect.

    A missing column affects every row; otherwise the rows with a value are counted."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in expected}
    drift = [
        (name, "missing" if name not in actual else "unexpected" if name not in wanted else "type changed",
         wanted.get(name), actual.get(name))
        for name in sorted({*actual, *wanted})
        if actual.get(name) != wanted.get(name)
    ]
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("kind"),
            F.lit(want).cast("string").alias("expected_type"),
            F.lit(got).cast("string").alias("actual_type"),
            (_rows() if kind == "missing" else F.count(name)).alias("affected_rows"),
        )
        for name, kind, want, got in drift
    ]
    if not entries:
        none = F.array().cast(
            "array<struct<column_name:string,kind:string,expected_type:string,actual_type:string,affected_rows:bigint>>"
        )
        return df.limit(0).agg(F.count(F.lit(1))).select(F.explode(none).alias("d")).select("d.*")
    return df.agg(F.array(*entries).alias("d")).select(F.explode("d").alias("d")).select("d.*")


def gold_contract(df: DataFrame, dims: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """A gold table has no NULL measure and one row per combination of its dimensions."""
    per_cell = df.groupBy(*dims).agg(
        _rows().alias("_n"), *[count_where(F.col(m).isNull()).alias(m) for m in measures]
    )
    totals = per_cell.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("checked_rows"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("unique dimensions"),
        *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures],
    )
    return long_form(
        totals, ["unique dimensions", *measures], "rule", "failed_rows", keep=["checked_rows"]
    ).select("rule", "checked_rows", "failed_rows", (F.col("failed_rows") == 0).alias("success"))


def missing_parent_rows(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """The orphan rows themselves, for inspection."""
    return without_match(child, parent, key)
