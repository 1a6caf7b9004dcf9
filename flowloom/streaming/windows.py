"""Event-time windows over packet streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowloom.functions.net import FIVE_TUPLE
from flowloom.operators.packets import family, ipv4


def rate_stream(packets: DataFrame, interval: int = 60, watermark: str = "10 minutes") -> DataFrame:
    """Bytes, packets and both per second, per tumbling window and protocol family.

    State is one row per open window and family; the watermark closes windows.
    """
    fam = family(packets)
    return (
        packets.select(F.timestamp_micros("ts_us").alias("time"), fam.alias("family"),
                       F.when(fam == "non-IP", 0).otherwise(F.col("ip_len")).alias("len"))
        .withWatermark("time", watermark)
        .groupBy(F.window("time", f"{interval} seconds"), "family")
        .agg(F.sum("len").cast("bigint").alias("bytes"), F.count("*").alias("packets"))
        .select(F.unix_seconds("window.start").alias("bucket"), "family", "bytes", "packets",
                (F.col("bytes") / F.lit(float(interval))).alias("bytes_per_s"),
                (F.col("packets") / F.lit(float(interval))).alias("packets_per_s"))
    )


def flow_stats_stream(packets: DataFrame, interval: int = 60, watermark: str = "10 minutes") -> DataFrame:
    """Bytes, packets, flows and rates per tumbling window of IPv4 packets, for append mode.

    Two aggregations in a row: one row per flow and window, then one per window.
    """
    per_second = F.lit(float(interval))
    flows = (
        ipv4(packets).select(F.timestamp_micros("ts_us").alias("time"), *FIVE_TUPLE, "ip_len")
        .withWatermark("time", watermark)
        .groupBy(F.window("time", f"{interval} seconds"), *FIVE_TUPLE)
        .agg(F.sum("ip_len").cast("bigint").alias("bytes"), F.count("*").alias("packets"))
    )
    return (
        flows.groupBy("window")
        .agg(F.sum("bytes").alias("bytes"), F.sum("packets").alias("packets"), F.count("*").alias("flows"))
        .select(F.unix_seconds("window.start").alias("bucket"), "bytes", "packets", "flows",
                F.col("flows").alias("endpoints"), (F.col("bytes") / per_second).alias("bytes_per_s"),
                (F.col("packets") / per_second).alias("packets_per_s"),
                (F.col("flows") / per_second).alias("flows_per_s"))
    )


def usage_stream(samples: DataFrame, interval: int = 15, watermark: str = "1 minute") -> DataFrame:
    """Mean used capacity and containers per tumbling window of samples."""
    return (
        samples.withColumn("time", F.timestamp_seconds("ts_s")).withWatermark("time", watermark)
        .groupBy(F.window("time", f"{interval} seconds"))
        .agg(F.count("*").alias("readings"), F.avg("capacity").alias("avg_capacity"),
             F.avg("containers").alias("avg_containers"))
        .select(F.unix_seconds("window.start").alias("bucket"), "readings", "avg_capacity", "avg_containers")
    )
