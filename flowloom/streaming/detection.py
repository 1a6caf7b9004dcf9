"""Rule detection in event time, in the state of the streaming engine.

Two windowed aggregations follow each other in append mode: flows of a bin are summed
per rule, key and sort key, and these per rule and key, so distinct sort keys are exact.
The watermark closes a bin: its groups are reported once, and their state is released.
Rules are taken by the length of their bins, each length with windows of its own over the
same stream. Flows that come after their bin was closed are dropped; Spark counts
them, and ``late_rows`` tells how many.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from flowloom.operators import rules as rule_ops
from flowloom.session import settings

# Each bin length sees the matching flows of one and the same stream, so the farthest watermark is that of all.
POLICY = {"spark.sql.streaming.multipleWatermarkPolicy": "max"}


def detect_stream(flows: DataFrame, rules: list[rule_ops.Rule] | None = None, watermark: str = "10 minutes") -> DataFrame:
    """The reports of ``rules.detect`` over a stream of flows, each when its bin is closed; for append mode."""
    rules = rule_ops.load_rules() if rules is None else rules
    timed = flows.withColumn("time", F.timestamp_micros("first_us")).withWatermark("time", watermark)
    parts = []
    for size in sorted({r.bin_s for r in rules}):
        chosen = [r for r in rules if r.bin_s == size]
        hits = rule_ops.matched(timed, chosen, keep=("time",))
        names = [c for c in hits.columns if c not in ("pkts", "bytes", "time")]
        groups = hits.groupBy(F.window("time", f"{size} seconds"), *names).agg(
            F.count("*").alias("n"), F.sum("pkts").alias("pkts"), F.sum("bytes").alias("bytes"))
        parts.append(rule_ops.final_groups(groups, chosen, ("window",)))
    keys = list(dict.fromkeys(k for r in rules for k in r.group_by))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return every.select("rule", "bin_start", *[F.col(k).cast("bigint").alias(k) for k in keys], "flows", "pkts", "bytes")


def start_event_time_detection(flows: DataFrame, root: str, rules: list[rule_ops.Rule] | None = None,
                               watermark: str = "10 minutes", trigger: dict | None = None):
    """Starts detection over a stream of flows; reports are appended below ``root``."""
    with settings(flows.sparkSession, POLICY):
        return (
            detect_stream(flows, rules, watermark).writeStream.outputMode("append").format("parquet")
            .option("path", f"{root}/out").option("checkpointLocation", f"{root}/_checkpoint")
            .trigger(**(trigger or {"processingTime": "5 minutes"})).start()
        )


def late_rows(progress: list) -> int:
    """Flows, or groups of them, that came after their bin was closed, in the progress reports of a query."""
    return sum(operator["numRowsDroppedByWatermark"] for report in progress for operator in report["stateOperators"])


def most_state(progress: list) -> int:
    """The most rows of state that were held after any batch."""
    return max((sum(operator["numRowsTotal"] for operator in report["stateOperators"]) for report in progress), default=0)
