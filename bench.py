"""Times the named queries: one line of JSON on standard output.

Every query runs twice in one session. The first pass pays for landing the shared tables and for
compiling code; the second is the figure reported per query. ``BENCH_QUERIES`` picks some by name.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roadpulse.plans.queries import all_queries  # noqa: E402
from roadpulse.session import create_session  # noqa: E402


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = create_session(
        f"local[{cpus}]",
        "bench",
        log_level="ERROR",
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    queries = all_queries()
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(queries)
    cold = {name: timed(queries[name], spark, sf_dir) for name in chosen}
    warm = {name: timed(queries[name], spark, sf_dir) for name in chosen}
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "first_pass": round(sum(cold.values()), 3),
                "first_pass_queries": cold,  # lands and compiles; of land_* it is the landing
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
