"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the local threads. Each query runs once to warm up and
is then timed ``BENCH_RUNS`` times; the best counts. Results go to a sink that drops the rows.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "request_view", "request_count", "enrich_requests", "allocate_requests", "allocate_stock_only", "dedup_requests",
    "dead_letter_split", "replay_from_offsets", "group_total_lag", "lag_alerts", "insert_with_constraints",
    "update_by_id", "apply_credits", "sequence_gaps", "state_checksum", "snapshot_compare", "field_rule_violations",
    "compact_latest", "gen_requests", "publish_requests", "stream_upper", "process_run",
]


def main() -> None:
    from orderweave.plans.catalog import QUERIES
    from orderweave.session import build_session

    cpus = os.environ.get("BENCH_CPUS", "8")
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    conf = {"spark__sql__shuffle__partitions": cpus, "spark__driver__memory": "16g"}
    if "BENCH_CHECKPOINT_DIR" in os.environ:
        conf["spark__checkpoint__dir"] = os.environ["BENCH_CHECKPOINT_DIR"]
    else:
        conf["spark__checkpoint__dir"] = tempfile.mkdtemp(prefix="orderweave-bench-")
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        def once() -> float:
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

        once()
        times[name] = round(min(once() for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline queries, total of best times", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
