"""Counts, rates, flows and neighbourhoods over packet rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowloom.functions.net import (
    ETH_IPV4, ETH_IPV6, FIVE_TUPLE, FLAG_ACK, FLAG_FIN, FLAG_RST, FLAG_SYN, ICMP, TCP, UDP,
    bucket_s, has_flag, in_network,
)
from flowloom.plans.gaps import CHUNK_US, HOT_ROWS, with_gaps

# Fixed value: an HTTP request line inside a payload.
HTTP_GET = r"GET /.* HTTP/\d.\d"

COUNT_KEYS = {
    "srcIP": "src_addr", "dstIP": "dst_addr", "srcPort": "src_port", "dstPort": "dst_port",
    "proto": "proto",
}


def family(packets: DataFrame) -> Column:
    """``IPv4``, ``IPv6`` or ``non-IP``, by EtherType and, where decoded, the version nibble."""
    eth = F.col("eth_type")
    if "ip_version" not in packets.columns:
        return F.when(eth == ETH_IPV4, "IPv4").when(eth == ETH_IPV6, "IPv6").otherwise("non-IP")
    version = F.col("ip_version")
    return (
        F.when((eth == ETH_IPV4) & (version == 4), "IPv4")
        .when((eth == ETH_IPV6) | ((eth == ETH_IPV4) & (version == 6)), "IPv6")
        .otherwise("non-IP")
    )


def ipv4(packets: DataFrame) -> DataFrame:
    """IPv4 packets only."""
    rows = packets.where(F.col("eth_type") == ETH_IPV4)
    return rows.where(F.col("ip_version") == 4) if "ip_version" in packets.columns else rows


def filter_packets(packets: DataFrame, net: str | None = None, port: int | None = None,
                   proto: int | None = None, dst_port: int | None = None) -> DataFrame:
    """Packets with an end point in ``net``, a ``port`` on either side, a protocol, a ``dst_port``."""
    rows = ipv4(packets)
    if net is not None:
        rows = rows.where(in_network(F.col("src_addr"), net) | in_network(F.col("dst_addr"), net))
    if port is not None:
        rows = rows.where((F.col("src_port") == port) | (F.col("dst_port") == port))
    if proto is not None:
        rows = rows.where(F.col("proto") == proto)
    if dst_port is not None:
        rows = rows.where(F.col("dst_port") == dst_port)
    return rows


def capture_filter(packets: DataFrame, dst_port: int | None = None) -> DataFrame:
    """The capture filter of a flow collector: IP and UDP, optionally to one port."""
    return filter_packets(packets, proto=UDP, dst_port=dst_port)


def capture_range(packets: DataFrame, begin_us: int, end_us: int) -> DataFrame:
    """Packets captured between two times, one day of slack on both sides."""
    day = 86_400_000_000
    return packets.where(F.col("ts_us").between(begin_us - day, end_us + day))


def count_up(packets: DataFrame, key: str) -> DataFrame:
    """Bytes and packets of IPv4 traffic per ``srcIP dstIP srcPort dstPort`` or ``proto``."""
    column = COUNT_KEYS[key]
    return (
        ipv4(packets).groupBy(column)
        .agg(F.sum("ip_len").cast("bigint").alias("bytes"), F.count("*").alias("packets"))
    )


def top_n(counts: DataFrame, n: int, measure: str = "bytes") -> DataFrame:
    """The ``n`` rows with the largest ``measure``; ties by the remaining columns."""
    rest = [c for c in counts.columns if c not in ("bytes", "packets")]
    return counts.orderBy(F.desc(measure), *rest).limit(n)


def total_stats(packets: DataFrame, interval: int = 60, approx: bool = False) -> DataFrame:
    """The fifteen totals of a capture as (metric, value) rows.

    Packets are first summed into flows per time bucket; the distinct counts
    then see flows, not packets.  ``approx`` counts distinct values by sketch.
    """
    fam = family(packets)
    ipv6_bytes = F.col("ipv6_len") if "ipv6_len" in packets.columns else F.col("ip_len")
    flows = (
        packets.withColumn("family", fam)
        .select(
            "family", F.when(fam == "non-IP", F.col("eth_type")).alias("other_type"),
            *[F.when(fam == "IPv4", F.col(c)).alias(c) for c in FIVE_TUPLE],
            F.when(fam == "IPv4", bucket_s(F.col("ts_us"), interval)).alias("bucket"),
            F.when(fam == "IPv4", F.col("ip_len")).when(fam == "IPv6", ipv6_bytes).alias("len"),
        )
        .groupBy("family", "other_type", *FIVE_TUPLE, "bucket")
        .agg(F.sum("len").alias("bytes"), F.count("*").alias("packets"))
    )

    # Every flow adds an item or an amount to each total it concerns; one aggregation for all.
    proto = F.col("proto")
    v4, v6, other = (F.col("family") == name for name in ("IPv4", "IPv6", "non-IP"))
    items = [
        ("IPv4 addr", v4, "src_addr"), ("IPv4 addr", v4, "dst_addr"),
        ("IPv4 srcaddr", v4, "src_addr"), ("IPv4 dstaddr", v4, "dst_addr"),
        ("ICMP type/codes", v4 & (proto == ICMP), "src_port"),
        ("IPv4 tcp srcPort", v4 & (proto == TCP), "src_port"),
        ("IPv4 tcp dstPort", v4 & (proto == TCP), "dst_port"),
        ("IPv4 udp srcPort", v4 & (proto == UDP), "src_port"),
        ("IPv4 udp dstPort", v4 & (proto == UDP), "dst_port"),
        ("non-IP protocols", other, "other_type"),
    ]
    amounts = [
        ("IPv4 bc", v4, F.col("bytes")), ("IPv4 pc", v4, F.col("packets")), ("IPv4 flows", v4, F.lit(1)),
        ("IPv6 bc", v6, F.col("bytes")), ("IPv6 pc", v6, F.col("packets")), ("non-IP pc", other, F.col("packets")),
    ]
    nothing = F.lit(None).cast("bigint")
    cells = []
    for metric, condition, column in items:
        cells += [F.when(condition, F.lit(TOTAL_METRICS.index(metric))), F.col(column).cast("bigint"), nothing]
    for metric, condition, amount in amounts:
        cells += [F.when(condition, F.lit(TOTAL_METRICS.index(metric))), nothing, amount.cast("bigint")]
    count = F.approx_count_distinct if approx else F.count_distinct
    totals = (
        flows.select(F.stack(F.lit(len(items) + len(amounts)), *cells).alias("id", "item", "amount"))
        .where(F.col("id").isNotNull())
        .groupBy("id").agg(count("item").alias("items"), F.sum("amount").alias("amount"))
    )
    listed = F.posexplode(F.array(*[F.lit(m) for m in TOTAL_METRICS])).alias("id", "metric")
    names = packets.sparkSession.range(1, numPartitions=1).select(listed)
    return names.join(F.broadcast(totals), "id", "left").select(
        "metric", F.coalesce("amount", "items", F.lit(0)).cast("bigint").alias("value"))


# Names of the totals.
TOTAL_METRICS = (
    "IPv4 bc", "IPv4 pc", "IPv4 addr", "IPv4 srcaddr", "IPv4 dstaddr", "ICMP type/codes",
    "IPv4 tcp srcPort", "IPv4 tcp dstPort", "IPv4 udp srcPort", "IPv4 udp dstPort", "IPv4 flows",
    "IPv6 bc", "IPv6 pc", "non-IP protocols", "non-IP pc",
)


def rate(packets: DataFrame, interval: int = 60) -> DataFrame:
    """Bytes and packets, and both per second, per time bucket and protocol family."""
    fam = family(packets)
    return (
        packets.select(bucket_s(F.col("ts_us"), interval).alias("bucket"), fam.alias("family"),
                       F.when(fam == "non-IP", 0).otherwise(F.col("ip_len")).alias("len"))
        .groupBy("bucket", "family")
        .agg(F.sum("len").cast("bigint").alias("bytes"), F.count("*").alias("packets"))
        .withColumn("bytes_per_s", F.col("bytes") / F.lit(float(interval)))
        .withColumn("packets_per_s", F.col("packets") / F.lit(float(interval)))
    )


def flow_gen(packets: DataFrame, interval: int = 60) -> DataFrame:
    """Packet-derived flows: bytes and packets per 5-tuple and time bucket, each one flow."""
    return (
        ipv4(packets)
        .groupBy(*FIVE_TUPLE, bucket_s(F.col("ts_us"), interval).alias("bucket"))
        .agg(F.sum("ip_len").cast("bigint").alias("bytes"), F.count("*").alias("packets"))
        .withColumn("flows", F.lit(1).cast("bigint"))
    )


def flow_stats(packets: DataFrame, interval: int = 60) -> DataFrame:
    """Per time bucket: bytes, packets, flows, distinct end-point tuples, and rates.

    A bucket holds one row per 5-tuple after ``flow_gen``, so the number of
    tuples is the number of those rows: no distinct count is needed.
    """
    per_second = F.lit(float(interval))
    return (
        flow_gen(packets, interval).groupBy("bucket")
        .agg(F.sum("bytes").alias("bytes"), F.sum("packets").alias("packets"),
             F.sum("flows").alias("flows"), F.count("*").alias("endpoints"))
        .withColumn("bytes_per_s", F.col("bytes") / per_second)
        .withColumn("packets_per_s", F.col("packets") / per_second)
        .withColumn("flows_per_s", F.col("flows") / per_second)
    )


def is_http_get() -> Column:
    """Whether a TCP payload holds an HTTP GET request line."""
    return ((F.col("proto") == TCP) & (F.col("payload_len") > 0)
            & F.col("payload").cast("string").rlike(HTTP_GET))


def http_requests(packets: DataFrame) -> DataFrame:
    """Packets that carry an HTTP GET request."""
    return ipv4(packets).where(is_http_get())


def packet_count(packets: DataFrame) -> DataFrame:
    """Packets per port, counting both ports of a packet, and ``HTTP2`` for HTTP GETs."""
    has_ports = F.col("proto").isin(TCP, UDP)
    keys = F.array(
        F.when(has_ports, F.col("src_port").cast("string")),
        F.when(has_ports, F.col("dst_port").cast("string")),
        F.when(is_http_get(), F.lit("HTTP2")),
    )
    return (
        ipv4(packets).select(F.explode(F.array_compact(keys)).alias("key"))
        .groupBy("key").agg(F.count("*").alias("n"))
    )


def flow_totals(packets: DataFrame) -> DataFrame:
    """Bytes and packets per 5-tuple."""
    return (
        ipv4(packets).groupBy(*FIVE_TUPLE)
        .agg(F.sum("ip_len").cast("bigint").alias("bytes"), F.count("*").alias("packets"))
    )


def bidir_flows(packets: DataFrame) -> DataFrame:
    """Conversations: both directions of a 5-tuple as one row, with packets each way."""
    here = F.struct(F.col("src_addr").alias("addr"), F.col("src_port").alias("port"))
    there = F.struct(F.col("dst_addr").alias("addr"), F.col("dst_port").alias("port"))
    sides = ipv4(packets).select(
        "proto", "ip_len", (here <= there).alias("forward"),
        F.least(here, there).alias("a"), F.greatest(here, there).alias("b"),
    )
    return (
        sides.groupBy("proto", F.col("a.addr").alias("a_addr"), F.col("a.port").alias("a_port"),
                      F.col("b.addr").alias("b_addr"), F.col("b.port").alias("b_port"))
        .agg(F.sum(F.when(F.col("forward"), 1).otherwise(0)).alias("packets_ab"),
             F.sum(F.when(F.col("forward"), 0).otherwise(1)).alias("packets_ba"),
             F.sum("ip_len").cast("bigint").alias("bytes"))
    )


def packets_per_source(packets: DataFrame) -> DataFrame:
    """Packets per source address."""
    return ipv4(packets).groupBy("src_addr").agg(F.count("*").alias("n"))


def packet_total(packets: DataFrame) -> DataFrame:
    """Number of packets, of any kind."""
    return packets.agg(F.count("*").alias("n"))


def popularity(packets: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct sources per destination."""
    count = F.approx_count_distinct if approx else F.count_distinct
    return ipv4(packets).groupBy("dst_addr").agg(count("src_addr").alias("n"))


def adjacency(packets: DataFrame, block_bits: int = 16) -> DataFrame:
    """Destinations of each source, as sorted lists, one per source and destination block.

    Pairs are deduplicated before they are collected, and a list covers one
    block of ``2 ** (32 - block_bits)`` addresses, which bounds its length: a
    source that scans everything gives many bounded rows, not one huge one.
    """
    size = 1 << (32 - block_bits)
    return (
        ipv4(packets).select("src_addr", "dst_addr").distinct()
        .groupBy("src_addr", (F.col("dst_addr") - F.pmod("dst_addr", F.lit(size))).alias("dst_block"))
        .agg(F.sort_array(F.collect_list("dst_addr")).alias("neighbours"))
    )


def packet_gaps(packets: DataFrame, chunk_us: int = CHUNK_US, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Each packet with the microseconds since the packet before it in its flow."""
    columns = [*FIVE_TUPLE, "ts_us", "ip_len", *[c for c in ("file", "pkt_id") if c in packets.columns]]
    return with_gaps(ipv4(packets).select(*columns), FIVE_TUPLE, chunk_us, hot_rows)


def flow_gap_list(packets: DataFrame, page: int = 1000, chunk_us: int = CHUNK_US,
                  hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Gaps of each flow in time order, as lists of at most ``page`` gaps.

    Page ``p`` holds the gaps of packets ``p * page`` to ``(p + 1) * page - 1``,
    so the pages of a flow laid end to end are its whole list.
    """
    return (
        packet_gaps(packets, chunk_us, hot_rows).where(F.col("gap_us").isNotNull())
        .groupBy(*FIVE_TUPLE, F.expr(f"seq DIV {page}").alias("page"))
        .agg(F.sort_array(F.collect_list(F.struct("seq", "gap_us"))).alias("pairs"))
        .select(*FIVE_TUPLE, "page", F.col("pairs.gap_us").alias("gaps"))
    )


def flow_means(packets: DataFrame) -> DataFrame:
    """Mean packet size and mean gap in seconds per flow.

    The gaps of a flow add up to last time minus first time, so neither an
    order nor a window is needed.
    """
    gaps = F.count("*") - 1
    return (
        ipv4(packets).groupBy(*FIVE_TUPLE)
        .agg(F.count("*").alias("packets"), F.avg("ip_len").alias("mean_size"),
             F.when(gaps > 0, (F.max("ts_us") - F.min("ts_us")) / gaps / 1e6)
             .otherwise(F.lit(0.0)).alias("mean_gap_s"))
    )


def tcp_summary(packets: DataFrame) -> DataFrame:
    """Per TCP flow: packets, data packets and bytes, first and last time, size range.

    Where flags, window and TTL are decoded, also the flag counts, pure ACKs,
    window range, zero windows and TTL range.
    """
    has_data = F.col("payload_len") > 0
    columns = [
        F.count("*").alias("packets"),
        F.count(F.when(has_data, 1)).alias("data_packets"),
        F.coalesce(F.sum(F.when(has_data, F.col("payload_len"))), F.lit(0)).cast("bigint").alias("data_bytes"),
        F.min("ts_us").alias("first_us"), F.max("ts_us").alias("last_us"),
        F.min("ip_len").alias("min_size"), F.max("ip_len").alias("max_size"),
    ]
    if "tcp_flags" in packets.columns:
        flags = F.col("tcp_flags")
        only_ack = (flags == FLAG_ACK) & (F.col("payload_len") == 0)
        columns += [F.sum(has_flag(flags, bit)).alias(name) for name, bit in
                    (("syn", FLAG_SYN), ("fin", FLAG_FIN), ("rst", FLAG_RST), ("ack", FLAG_ACK))]
        columns.append(F.count(F.when(only_ack, 1)).alias("pure_ack"))
    if "window" in packets.columns:
        columns += [F.min("window").alias("win_min"), F.max("window").alias("win_max"),
                    F.count(F.when(F.col("window") == 0, 1)).alias("cnt_zerowin")]
    if "ttl" in packets.columns:
        columns += [F.min("ttl").alias("ttl_min"), F.max("ttl").alias("ttl_max")]
    return ipv4(packets).where(F.col("proto") == TCP).groupBy(*FIVE_TUPLE).agg(*columns)
