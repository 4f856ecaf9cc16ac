"""Times of the lakehouse queries, as one JSON line.

Every query runs to the end of its plan (a `noop` write), so nothing is pruned that a
real sink would need and nothing passes through the driver. The first run warms the JVM
and the page cache; the time is the better of the two after it, of a slow query the next, and of
a very slow one its own.
"""

import json
import os
import time

from lakeops.plans.queries import QUERIES
from lakeops.session import local_session

HEADLINE = tuple(QUERIES)


def seconds(spark, sf_dir, name, runs=3, slow=10):
    """Order lines span seven years, and some queries write a folder for each day: the slowest
    run once, as the JVM is warm by then."""
    times = []
    while len(times) < runs and not (times and times[-1] > (2 * slow if len(times) == 1 else slow)):
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times[1:] or times), 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: seconds(spark, sf_dir, name) for name in HEADLINE}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
