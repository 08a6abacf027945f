"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then three times; the median counts. Results go to the no-op sink,
so every row is computed and none is collected.
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from casemill.plans import catalog  # noqa: E402
from casemill.session import local_session  # noqa: E402

HEADLINES = [
    "role_performance",
    "rejection_waste",
    "run_metrics",
    "coverage_entropy",
    "stage_timeline",
    "first_seen",
    "routing_decisions",
    "deterministic_verdicts",
    "schema_rules",
    "text_hygiene",
    "answer_leaks",
    "passage_leaks",
    "design_partition",
    "supplier_exposure",
    "region_customers",
    "paired_variants",
    "scan_grades",
    "decision_grades",
    "revised_files",
    "token_slots",
    "novel_vectors",
    "board_status",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, "casemill-bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINES:
        laps = []
        for _ in range(RUNS + 1):
            began = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            laps.append(time.perf_counter() - began)
        times[name] = round(statistics.median(laps[1:]), 3)
        print(name, times[name], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "median of three warm runs, summed over queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
