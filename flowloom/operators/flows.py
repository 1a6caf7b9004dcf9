"""Statistics over flow rows, web logs and usage samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowloom.functions.net import bucket, date_label, in_network, ip_text, subnet
from flowloom.functions.fields import FLOW_FIELDS, flow_field

DAY_US = 86_400_000_000

# Type of a statistics row -> field it is grouped by.
STAT_TYPES = {
    "srcPort": "sport",
    "dstPort": "dport",
    "srcSubnet": "ssubnet",
    "dstSubnet": "dsubnet",
    "srcAs": "sas",
    "dstAs": "das",
    "totalProtocol": "prot",
    "totalVolume": None,
}

# Report table -> (type of its rows, name of its key column).
FAN_OUT = {
    "totalvolume": ("totalVolume", None),
    "totalprotocol": ("totalProtocol", "protocol"),
    "portegress": ("srcPort", "port"),
    "portingress": ("dstPort", "port"),
    "subnetegress": ("srcSubnet", "subnet"),
    "subnetingress": ("dstSubnet", "subnet"),
    "asegress": ("srcAs", "asn"),
    "asingress": ("dstAs", "asn"),
}


def _sums() -> list[Column]:
    return [F.sum("doctets").alias("octets"), F.sum("dpkts").alias("pkts"),
            F.count("*").alias("flows")]


def flowstats(flows: DataFrame, by: list[str] | None = None, types: list[str] | None = None) -> DataFrame:
    """Octets, packets and flows for each type of key, as (type, aggr_key, …) rows.

    One scan: the groupings are grouping sets, so sums are combined before the
    shuffle and each hot key leaves a task as one row.  ``by`` adds columns
    (such as a time stamp) to every grouping.
    """
    by = by or []
    types = types or list(STAT_TYPES)
    keyed = [t for t in types if STAT_TYPES[t] is not None]
    columns = {t: flow_field(STAT_TYPES[t]).alias(f"key_{t}") for t in keyed}
    base = flows.select(*by, "doctets", "dpkts", *columns.values())
    sets = [[*by, f"key_{t}"] for t in keyed] + ([by] if "totalVolume" in types else [])
    every = [*by, *[f"key_{t}" for t in keyed]]
    grouped = base.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in every]).agg(
        *_sums(), *[F.grouping(f"key_{t}").alias(f"out_{t}") for t in keyed])
    chain_type, chain_key = F, F
    for t in keyed:
        used = F.col(f"out_{t}") == 0
        key = F.col(f"key_{t}")
        chain_type = chain_type.when(used, t)
        chain_key = chain_key.when(used, ip_text(key) if "Subnet" in t else key.cast("string"))
    if not keyed:
        row_type, row_key = F.lit("totalVolume"), F.lit("all")
    else:
        row_type, row_key = chain_type.otherwise("totalVolume"), chain_key.otherwise("all")
    rows = grouped.select(*by, row_type.alias("type"), row_key.alias("aggr_key"), "octets", "pkts", "flows")
    # A grouping without columns has one row even over no input; such a row counts no flow.
    return rows.where("flows > 0")


def fan_out(stats: DataFrame, report: str, by: list[str] | None = None) -> DataFrame:
    """Rows of one report table out of the statistics."""
    stat_type, key = FAN_OUT[report]
    keys = [F.col("aggr_key").alias(key)] if key else []
    return stats.where(F.col("type") == stat_type).select(*(by or []), *keys, "octets", "pkts", "flows")


def flow_report(flows: DataFrame, report: str, by: list[str] | None = None) -> DataFrame:
    """One report table straight from flows, computing only its own grouping."""
    return fan_out(flowstats(flows, by, [FAN_OUT[report][0]]), report, by)


def scan(flows: DataFrame, threshold: int = 10, by: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of hosts with more than ``threshold`` distinct destination ports, and their first time.

    ``by`` columns (such as a period) are looked at separately.
    """
    return (
        flows.groupBy(*by, "src_addr", "dst_addr")
        .agg(F.count_distinct("dst_port").alias("cnt"), F.min("first_us").alias("first_us"))
        .where(F.col("cnt") > threshold)
    )


def _end_points(flows: DataFrame, *carried: str) -> DataFrame:
    """Each flow's two addresses as rows, in one scan."""
    return flows.select(*carried, F.explode(F.array("src_addr", "dst_addr")).alias("addr"))


def active_ips(flows: DataFrame, net: str = "0.0.0.0/0") -> DataFrame:
    """Distinct addresses seen on either side, below a prefix."""
    return _end_points(flows).where(in_network(F.col("addr"), net)).distinct()


def active_ip_count(flows: DataFrame, net: str = "0.0.0.0/0", by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct addresses per day, and per ``by`` column (such as an area)."""
    days = _end_points(flows, "first_us", *by).where(in_network(F.col("addr"), net)).select(
        *by, "addr", bucket(F.col("first_us"), DAY_US).alias("day_us"))
    # Days are counted as numbers; their text is made once per day, not once per flow.
    return days.groupBy(*by, "day_us").agg(F.count_distinct("addr").alias("cnt")).select(
        *by, date_label(F.col("day_us"), "yyyy-MM-dd").alias("ds"), "cnt")


def aggregate_by(flows: DataFrame, names: list[str]) -> DataFrame:
    """Octets, packets and flows per combination of short field names (a key list)."""
    return flows.groupBy(*[flow_field(n).alias(n) for n in names]).agg(*_sums())


def active_subnets(flows: DataFrame, net: str = "0.0.0.0/0", mask_bits: int = 24) -> DataFrame:
    """Distinct networks of the addresses seen on either side, below a prefix."""
    return (
        _end_points(flows).where(in_network(F.col("addr"), net))
        .select(subnet(F.col("addr"), mask_bits).alias("subnet")).distinct()
    )


def heavy_users(flows: DataFrame) -> DataFrame:
    """Octets per address over both sides, largest first."""
    return (
        _end_points(flows, "doctets").groupBy("addr").agg(F.sum("doctets").alias("octets"))
        .orderBy(F.desc("octets"), "addr")
    )


PRINT_ORDER = ("src_addr", "src_port", "prot", "first_us", "dst_addr", "dst_port")


def flow_print(flows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """All flow fields in the order of flow key, then start time, within each ``by`` group.

    The range partitioning includes the start time, so a key with many flows
    is spread over several partitions and the order still holds across them.
    """
    names = [*by, *FLOW_FIELDS.values(), "sys_uptime", "timestamp_us"]
    known = [c for c in dict.fromkeys(names) if c in flows.columns]
    flags = [flow_field(n).cast("int").alias(n) for n in ("syn", "ack", "fin")]
    subnets = [flow_field(n).alias(c) for n, c in (("ssubnet", "src_subnet"), ("dsubnet", "dst_subnet"))]
    return flows.select(*known, *flags, *subnets).orderBy(*by, *PRINT_ORDER)


def url_users_views(http_log: DataFrame) -> DataFrame:
    """Distinct users and views per URL."""
    return http_log.groupBy("url").agg(
        F.count_distinct("src_addr").alias("users"), F.count("*").alias("views"))


def user_urls(http_log: DataFrame) -> DataFrame:
    """URLs of each user, one row per pair, so that a user's set may be of any size."""
    return http_log.select("src_addr", "url").distinct()


def usage_avg(samples: DataFrame, interval: int = 15) -> DataFrame:
    """Mean used capacity and containers per interval of samples."""
    return (
        samples.groupBy((F.col("ts_s") - F.pmod("ts_s", F.lit(interval))).alias("bucket"))
        .agg(F.count("*").alias("readings"), F.avg("capacity").alias("avg_capacity"),
             F.avg("containers").alias("avg_containers"))
    )


def upload_stats(uploads: DataFrame) -> DataFrame:
    """Uploads per site: files, megabytes, mean duration and mean speed; with ``start_s`` and ``end_s`` also when
    the first began and the last ended."""
    times = [F.min("start_s").alias("first_start_s"), F.max("end_s").alias("last_end_s")] if {
        "start_s", "end_s"} <= set(uploads.columns) else []
    return (
        uploads.groupBy("site")
        .agg(F.count("*").alias("files"), F.sum("size_mb").alias("size_mb"),
             F.sum("duration_s").alias("duration_s"), F.avg("duration_s").alias("avg_duration_s"), *times)
        .withColumn("mb_per_s", F.col("size_mb") / F.col("duration_s"))
    )
