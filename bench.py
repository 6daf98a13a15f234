"""Time every named query: seconds from building the plan to the last result row.

Prints one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores;
``BENCH_QUERIES`` (comma separated) limits the run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from suarakit.catalog import QUERIES  # noqa: E402
from suarakit.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(QUERIES)
    spark = local_session(cpus, **{"spark.sql.shuffle.partitions": cpus})

    def run(name: str) -> float:
        start = time.perf_counter()
        # noop computes every column of every row and writes nothing.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # Start the JVM's compiler and the Python workers before the clock.
    run(names[0])
    if "page_links" in names:
        run("page_links")
    times = {name: round(run(name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            }
        )
    )


if __name__ == "__main__":
    main()
