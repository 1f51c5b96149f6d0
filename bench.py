"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: folder of the tables (default /root/testdata/sf0.1); BENCH_CPUS: local cores (default 8).
Each query runs once, with all its rows and columns produced into a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from cityweave.plans.queries import REGISTRY
from cityweave.session import local_session


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or list(REGISTRY)
    spark = local_session(cores, shuffle_partitions=int(cores), memory="16g")
    spark.sparkContext.setLogLevel("ERROR")

    def produce(name: str) -> None:
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()

    produce("row_count")  # start-up work that belongs to no query
    seconds = {name: timed(lambda name=name: produce(name)) for name in only}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
