"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS the
local cores. Every query runs once to warm up, then three times; the median
counts. A run includes building the query and computing all its rows.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from goldkeel.session import get_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINES = [
    "c02_provider_locations",
    "c03_qualifying_charts",
    "c05_chart_count_matrix",
    "c06_classify_retrieval",
    "c07_retrieval_summary",
    "c08_appointment_counts",
    "c11_merge_report",
    "c12_location_master",
    "c13_chase_list",
    "c13_chase_list_by_provider",
    "c14_accumulate_chase_list",
    "c18_master_projects",
    "c19_load_npi_registry",
    "c22_provider_registry_view",
    "c24_status_summary",
    "c26_repeated_npis_by_projects",
]
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = get_session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINES:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    report = {
        "metric": "total_seconds_of_headline_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
