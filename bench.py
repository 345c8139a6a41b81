"""Time the registered queries: one JSON line with seconds per query.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores,
``BENCH_QUERIES`` (comma-separated) picks queries.
"""

from __future__ import annotations

import json
import os
import time

from taxaweave.plans import QUERIES
from taxaweave.session import build_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = build_session("taxaweave-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/region.parquet").collect()
    seconds, failed = {}, {}
    for name in chosen:
        start = time.perf_counter()
        try:
            # Every row and column is computed; nothing is collected.
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        except Exception as error:  # noqa: BLE001
            failed[name] = str(error)[:200]
    result = {
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }
    if failed:
        result["failed"] = failed
    print(json.dumps(result))


if __name__ == "__main__":
    main()
