"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs once to warm up and then BENCH_RUNS times (default 1); the
whole result is computed and thrown away, so nothing is pruned or limited.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from flowloom.plans.queries import QUERIES  # noqa: E402
from flowloom.session import local_session  # noqa: E402

HEADLINE = [
    "classify_gmm", "classify_normal", "success_ratio", "packet_gaps", "flow_gap_list", "flow_means",
    "total_stats", "rate", "flow_gen", "flow_stats", "flow_totals", "packet_count", "count_up_src_ip",
    "top_n_bytes", "popularity", "adjacency", "tcp_summary", "word_count", "path_adjacency",
    "flowstats", "flowstats_portingress", "scan", "spoof", "active_ip_count", "heavy_users",
    "detect_rules", "detect_patterns", "task_durations", "netflow_decode", "flow_print",
    "pcap_roundtrip", "stream_flowstats", "stream_rate", "stream_detect", "flowtools_decode", "flow_partitions",
    "spoof_large", "detect_all_returned", "fit_logit", "fit_gmm",
    "tcp_quality", "capture_range_files", "distinct_sketches", "period_join", "report_tables",
]


def run(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, sf_dir, name)
        seconds[name] = round(min(run(spark, sf_dir, name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline queries, warm", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
