"""Time the queries of the lake on the given tables; prints one JSON line.

Every query runs once to warm up and then $BENCH_RUNS times (default 3); the median counts.
Results go to Spark's noop sink, so all rows and columns are produced and none collected. A query that
fails is named under "failed" and has no time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickwell.session import local_session  # noqa: E402


# These spend their time on writing a small file per object for the scan that follows.
OBJECTS = {"metadata_objects", "files_report"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, "bench", shuffle_partitions=cores)
    from tickwell.queries import QUERIES as registered

    def once(name: str) -> float:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds, failed = {}, {}
    for name in sorted(set(registered) - OBJECTS):
        try:
            once(name)
            seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        except Exception as error:  # reported below; the other queries go on
            failed[name] = str(error).split("\n")[0][:200]
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "all_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                **({"failed": failed} if failed else {}),
            }
        )
    )


if __name__ == "__main__":
    main()
