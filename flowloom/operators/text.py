"""Jobs over text lines: word counts, traceroute paths, job histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Fixed value: the characters that separate words.
WORD_BREAK = r"[ \t\n\r\f]"

# Positions in a traceroute line.
TRACE_FIELDS, TRACE_FROM, TRACE_HOP, TRACE_TO, TRACE_RTT = 15, 4, 10, 12, 14
NULL_HOPS = ("0.0.0.0", "0")


def word_count(texts: DataFrame, column: str = "text") -> DataFrame:
    """Occurrences of each word, over whole texts."""
    words = texts.select(F.explode(F.split(column, WORD_BREAK)).alias("word"))
    return words.where(F.col("word") != "").groupBy("word").agg(F.count("*").alias("n"))


def path_adjacency(lines: DataFrame, column: str = "line") -> DataFrame:
    """Per pair of neighbouring nodes: traces and rounded mean round-trip time.

    Lines without fifteen fields, with a null hop, or without a number as the
    time are dropped.
    """
    parts = F.split(column, r"\|")
    rtt = parts[TRACE_RTT].try_cast("double")
    return (
        lines.where(F.size(parts) == TRACE_FIELDS)
        .select(parts[TRACE_FROM].alias("from_node"), parts[TRACE_HOP].alias("hop"),
                parts[TRACE_TO].alias("to_node"), rtt.alias("rtt"))
        .where(~F.col("hop").isin(*NULL_HOPS) & F.col("rtt").isNotNull())
        .groupBy("from_node", "to_node")
        .agg(F.count("*").alias("n"), F.floor(F.avg("rtt") + 0.5).cast("bigint").alias("avg_rtt"))
    )


def task_durations(events: DataFrame) -> DataFrame:
    """Start, finish and duration of each task attempt that has both events.

    Both events of an attempt meet in one aggregation, so there is no join.
    """
    started = F.col("type") == "MAP_ATTEMPT_STARTED"
    finished = F.col("type") == "MAP_ATTEMPT_FINISHED"
    return (
        events.where(started | finished).groupBy("attempt")
        .agg(F.min(F.when(started, F.col("time_ms"))).alias("start_ms"),
             F.min(F.when(started, F.col("locality"))).alias("locality"),
             F.min(F.when(finished, F.col("time_ms"))).alias("finish_ms"),
             F.min(F.when(finished, F.col("host"))).alias("host"),
             F.min(F.when(finished, F.try_element_at(F.split("state", " "), F.lit(5)))).alias("file"))
        .where(F.col("start_ms").isNotNull() & F.col("finish_ms").isNotNull())
        .select("attempt", "start_ms", "locality", "finish_ms",
                (F.col("finish_ms") - F.col("start_ms")).alias("duration_ms"), "host", "file")
    )
