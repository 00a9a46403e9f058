"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed to completion with the ``noop`` sink (all rows
produced, nothing collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from agora.plans.analogs import QUERIES  # noqa: E402
from agora.session import get_spark  # noqa: E402

HEADLINE = [
    "clean_double", "wide_clean", "union_filter_count", "pivot_indicators", "participation_ratios",
    "share_of_partition", "surrogate_key", "dim_snapshot", "fact_results", "fact_economy",
    "qc_suite", "ingest_manifest", "feature_mart", "predict_ranking",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", app="agora-bench", shuffle_partitions=cpus,
                      extra={"spark.driver.memory": "16g"})
    # warm-up: JVM, code paths, file listing
    QUERIES["clean_int"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
