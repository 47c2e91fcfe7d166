"""Time the headline queries; prints one JSON line.

Every query writes its whole result to Spark's ``noop`` sink. The time of a
query is the median of ``BENCH_RUNS`` runs after one warm-up and includes the
writes a query makes itself.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tableferry.session import build_session
from verification.queries import QUERIES

# Every table query; the training-data queries have a check tool of their own.
HEADLINE = list(QUERIES)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    scratch = os.environ.get("BENCH_SCRATCH", "/tmp/bench-scratch")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else None,
        extra={"spark.driver.memory": "8g", "spark.checkpoint.dir": scratch},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        print(f"{name:24s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
