"""Time the registered queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all) choose data and cores.
``silver_build`` is the one-time cost of writing the eleven silver tables that the later queries
share; it is part of the total.  BENCH_QUERIES limits the run to some names (comma separated).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strataflow.session import local_session  # noqa: E402
from verification.queries import lake, registered  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cpus, "bench")
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # start the engine

    timings: dict[str, float] = {}
    start = time.perf_counter()
    lake(spark, sf_dir).all_silver()
    timings["silver_build"] = round(time.perf_counter() - start, 3)
    errors = {}
    for name, build in registered().items():
        if chosen and name not in chosen:
            continue
        start = time.perf_counter()
        try:
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as error:  # a failing query must not hide the others
            errors[name] = f"{type(error).__name__}: {str(error)[:200]}"
        timings[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total wall time of all registered queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": cpus,
    }
    if errors:
        result["errors"] = errors
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
