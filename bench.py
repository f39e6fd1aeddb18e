"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR  folder of the tables   (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores            (default 8)
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "validate_rows",
    "error_rows",
    "error_code_counts",
    "staging_rows",
    "import_summary",
    "dedup_latest",
    "dedup_latest_events",
    "upsert_records",
    "reconcile_counts",
    "csv_records",
    "csv_errors",
    "file_gate",
    "decode_staged_events",
    "claim_decisions",
    "ledger_complete",
    "partitioned_layout",
    "stream_ingest",
    "stream_merge",
    "stream_dedup",
)


def main() -> None:
    from rowgate.plans.queries import REGISTRY
    from rowgate.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "rowgate-bench",
        master=f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in wanted:
        began = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
