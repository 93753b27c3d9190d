"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from regfacts import queries as catalog
from regfacts.session import get_spark

HEADLINE = (
    "silver_facts", "distinct_facts", "validate_records", "upsert_ignore", "ffill_then_bfill",
    "normalize_lei", "flatten_responses", "coverage_gaps",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = get_spark(
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": str(max(int(cpus), 1)), "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's readers and compiler once, outside the measurement
    catalog.duplicate_count(spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
