"""Time the headline queries on one machine and print one JSON line.

Each query runs once to warm up and three times timed, writing its whole
result to the no-op sink; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from dockhand.plans.registry import QUERIES  # noqa: E402
from dockhand.session import build_session  # noqa: E402

HEADLINE = [
    "process_documents",
    "sanitize_documents",
    "dedup_by_hash",
    "product_part_quantity",
    "product_parts",
    "inverted_index",
    "detect_language",
    "extract_html_text",
    "monitor_current",
    "retry_schedule",
    "metric_samples",
    "parts_audit",
    "effective_revision",
    "bom_explosion",
    "dq_report",
]
TIMED_RUNS = 3


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    spark = build_session(
        "dockhand-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in only:
        seconds(spark, name, folder)
        times[name] = round(statistics.median(seconds(spark, name, folder) for _ in range(TIMED_RUNS)), 3)
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
