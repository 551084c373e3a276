"""Compare registered queries with their SQL oracles.

    python -m verification.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    return None if value is None else value


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both sides hold the same rows under the same column names, else what differs."""
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    order = sorted(names)
    kinds = {d[0]: str(d[1]) for d in answer.description}
    want = Counter(tuple(row[names.index(c)] for c in order) for row in answer.fetchall())
    rows = df.select(*[f"`{c}`" for c in order]).collect()
    got = Counter(tuple(row) for row in rows)
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"rows: spark {sum(got.values())}, sql {sum(want.values())}; only in spark {sum(extra.values())}, "
            f"only in sql {sum(missing.values())}\n  columns {order}\n  spark {next(iter(extra), None)}\n  sql   {next(iter(missing), None)}"
        )
    for row in rows:
        for name, value in zip(order, row):
            if isinstance(value, float) and kinds[name] not in ("DOUBLE", "FLOAT"):
                return f"type of {name}: spark double, sql {kinds[name]}"
            if isinstance(value, int) and not isinstance(value, bool) and kinds[name] not in ("INTEGER", "BIGINT"):
                return f"type of {name}: spark integer, sql {kinds[name]}"
    return None


def main(argv: list[str]) -> int:
    root = str(Path(__file__).resolve().parent.parent)
    if root not in sys.path:
        sys.path.insert(0, root)
    from strataflow.session import local_session

    from .oracle import oracles
    from .queries import registered

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    queries, sql = registered(), oracles()
    names = argv[1:] or list(queries)
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = differences(queries[name](spark, sf_dir), con, sql[name]) if name in sql else "no oracle"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal; without query: {sorted(set(sql) - set(queries))}")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
