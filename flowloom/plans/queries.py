"""Every registered query: name -> function of (session, data directory)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowloom.functions.net import FIVE_TUPLE, date_label, ip_text
from flowloom.operators import anomaly, classify, flows, packets, rules, sketches, tcp, text
from flowloom.plans.lineage import as_table, scratch_path
from flowloom.plans.views import VIEWS, table, view, view_over
from flowloom.sources import capture_index, netflow, tables
from flowloom.sources.decode import decode_packets, encode_frames
from flowloom.sources.pcap import read_pcap, read_pcap_stream, write_pcap
from flowloom.sources.tables import read_partitions, write_partitions
from flowloom.sources.text import job_history, read_delimited, write_text
from flowloom.streaming import detection, monitor, windows

Query = Callable[[SparkSession, str], DataFrame]

RANGE = (1704067260000000 + 86_400_000_000, 1704067380000000 - 86_400_000_000)
SCAN_PORTS = 5
CLIENT_NET = "10.0.0.0/26"
HOUR_US = 1704110400000000
ROWS_A_FILE = 500_000

# Rules whose fields and thresholds occur in the given tables.
PORT_SCAN_RULES = "port_scan;2592000;prot=6;sip;dport;unique;flows=4-;sip"
SYNFLOOD_RULES = "synflood;2592000;prot=6,syn=1,ack=0,fin=0;sip,dip;sport,dport;count;flows=2-;sip,dip"
PATTERN_RULES = """
big_packets;300;prot=6|17,bytes/pkts=1500-;sip;dip;count;null;sip
sum_of_ports;300;sport+dport=1100-1200;dip,prot;sip;unique;flows=1-;dip
port_gap;300;dport-sport=900-1000,smask=24|25|27;sport,dport;sip;count;pkts=20-;sport
same_as;300;sas*das=0;sas,das;dip;unique;bytes=1000-90000;sas
by_subnet;86400;prot=1;ssubnet;dip,dport;unique;flows=2-;ssubnet
"""
RETURNING_RULE = "synflood;2592000;prot=6,syn=1,ack=0,fin=0;sip,dip;sport,dport;count;flows=2-;sip,sport,dip,dport"
RETURNING_RULES = RETURNING_RULE + "\nbig;300;bytes=1000-;dip;sip;unique;flows=2-;dip,prot,flows"
KEY_LIST = "prot;ack\ndas\n"
LEGACY_RULES = """
web;proto=6,dstport=80|445,octets=1000-50000
games;proto=17,dstport=13500|4662
pings;proto=1,pkts=1-10
"""


def _over(name: str, operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    """Query that applies an operator to one view."""
    return lambda spark, sf: operator(view(spark, sf, name), *args, **kwargs)


def _with_text(df: DataFrame, *columns: str) -> DataFrame:
    """Addresses as dotted text."""
    return df.withColumns({c: ip_text(F.col(c)) for c in columns})


def _count_up(key: str) -> Query:
    column = packets.COUNT_KEYS[key]

    def run(spark, sf):
        counts = packets.count_up(view(spark, sf, "packets"), key)
        return _with_text(counts, column) if key.endswith("IP") else counts
    return run


def _top(measure: str) -> Query:
    return lambda spark, sf: packets.top_n(packets.count_up(view(spark, sf, "packets"), "srcIP"), 10, measure)


def _adjacency(spark, sf):
    rows = packets.adjacency(view(spark, sf, "packets"))
    return rows.select("src_addr", "dst_block", F.array_join(
        F.transform("neighbours", ip_text), " ").alias("neighbours"))


def _gap_list(spark, sf):
    rows = packets.flow_gap_list(view(spark, sf, "packets"))
    return rows.select(*FIVE_TUPLE, "page", F.array_join(F.transform(
        "gaps", lambda g: g.cast("string")), " ").alias("gaps"))


def _pcap_roundtrip(spark, sf):
    """Packets as frames, written as capture files, read back in small splits, decoded."""
    path = scratch_path(spark, "capture")
    write_pcap(encode_frames(view(spark, sf, "packets")), path, roll_s=60)
    decoded = decode_packets(read_pcap(spark, path, split_bytes=1 << 18))
    return decoded.select("ts_us", "eth_type", "ip_len", "proto", "src_addr", "dst_addr", "src_port", "dst_port")


def _range_of_captures(spark, sf):
    """A range of times out of rolled capture files, by their time index."""
    path = scratch_path(spark, "capture")
    write_pcap(encode_frames(view(spark, sf, "packets")), path, roll_s=10)
    index = capture_index.build_index(spark, path, zone_bytes=1 << 16)
    decoded = decode_packets(capture_index.read_range(spark, path, *RANGE, index))
    return decoded.select("ts_us", "eth_type", "ip_len", "proto", "src_addr", "dst_addr", "src_port", "dst_port")


def _as_records(df: DataFrame) -> DataFrame:
    """All fields of decoded records but the times of the export packet, which depend on the grouping."""
    return df.select(*[c for c in df.columns if c not in ("sys_uptime", "timestamp_us")])


def _as_flow_rows(df: DataFrame) -> DataFrame:
    names = ["src_addr", "dst_addr", "src_port", "dst_port", "prot", "dpkts", "doctets", "tcp_flags",
             "src_as", "dst_as", "src_mask", "dst_mask", "first_us", "syn", "ack", "fin"]
    return df.select(*names, "src_subnet")


def _netflow(spark, sf):
    """Flows as export packets, one per order and month (an order has few lines), then decoded."""
    rows = view_over(table(spark, sf, "lineitem"), "flows", keep=("l_orderkey",))
    keyed = rows.withColumn("month", F.expr("first_us DIV 2592000000000"))
    return _as_records(netflow.netflow_v5(netflow.encode_netflow_v5(keyed, ["l_orderkey", "month"])))


def _flowtools(spark, sf):
    """Flows as files of records, read back in small splits."""
    path = scratch_path(spark, "flowtools")
    netflow.write_flowtools(netflow.encode_flowtools(view(spark, sf, "flows")), path)
    return _as_records(netflow.read_flowtools(spark, path, split_bytes=1 << 18))


def _flow_print(spark, sf):
    return _as_flow_rows(flows.flow_print(view(spark, sf, "flows")))


def _flow_partitions(spark, sf):
    """Flows loaded into area and month partitions, then summed from the loaded table."""
    path = scratch_path(spark, "daily_flows")
    month = date_label(F.col("first_us"), "yyyy-MM")
    rows = view(spark, sf, "flows").withColumn("month", month)
    write_partitions(rows, path, spread=("first_us", "src_addr", "src_port"), area="backbone", month=None)
    return read_partitions(spark, path, area="string", month="string").groupBy("area", "month").agg(
        F.count("*").alias("flows"), F.sum("doctets").alias("octets"), F.sum("dpkts").alias("pkts"))


def _spoof(registry: str, **options) -> Query:
    return lambda spark, sf: anomaly.spoofs(view(spark, sf, "flows"), view(spark, sf, registry), **options)


def _flow_periods(spark, sf):
    """Flows loaded by area, day and period, once and then again for one period, and summed."""
    path = scratch_path(spark, "daily_flows")
    rows = monitor.with_period(_busy_hour(spark, sf))
    for part in (rows, rows.where("ts = '1200'")):
        write_partitions(part, path, spread=("first_us", "src_addr"), area="backbone", ds=None, ts=None)
    loaded = read_partitions(spark, path, rows.schema, area="string", ds="string", ts="string")
    return loaded.groupBy("area", "ds", "ts").agg(
        F.count("*").alias("flows"), F.sum("doctets").alias("octets"), F.sum("dpkts").alias("pkts"))


def _new_database(spark, name: str) -> str:
    db = f"{name}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, db)}'")
    return db


def _report_tables(spark, sf):
    """The eight reports of two periods, the first of which is loaded twice."""
    db = _new_database(spark, "reports")
    tables.create_report_views(spark, db)
    day = F.expr("first_us DIV 86400000000")
    timed = view(spark, sf, "flows").withColumn("ts", F.when(F.pmod(day, F.lit(2)) == 0, "0000").otherwise("0005"))
    stats = flows.flowstats(timed, by=["ts"])
    for ts in ("0000", "0005", "0000"):
        tables.load_reports(stats.where(F.col("ts") == ts).drop("ts"), db, "backbone", "2024-01-01", ts)
    loaded = [spark.table(f"{db}.{report}").select(
        F.lit(report).alias("report"), "ds", "ts", (F.col(key) if key else F.lit(None).cast("string")).alias("key"),
        "octets", "pkts", "flows") for report, (_, key) in flows.FAN_OUT.items()]
    return reduce(DataFrame.unionByName, loaded)


def _period_join(spark, sf):
    """Octets of every source in two periods, each a bucketed table of flows."""
    db, rows = _new_database(spark, "periods"), view(spark, sf, "flows")
    sides = []
    for name, odd in (("before", 0), ("after", 1)):
        of_period = rows.where(F.pmod(F.expr("first_us DIV 86400000000"), F.lit(2)) == odd)
        tables.write_bucketed(of_period.select("src_addr", "doctets"), f"{db}.{name}", ["src_addr"], 8)
        sides.append(spark.table(f"{db}.{name}").groupBy("src_addr").agg(F.sum("doctets").alias(name)))
    return tables.join_bucketed(*sides, ["src_addr"])


def _text_roundtrip(spark, sf):
    """Printed flows as delimited text files, scanned again."""
    path = scratch_path(spark, "flow-text")
    printed = _flow_print(spark, sf)
    write_text(printed, path, "|")
    return read_delimited(spark, path, "|", ", ".join(f"{name} {kind}" for name, kind in printed.dtypes))


def _detect(source) -> Query:
    return lambda spark, sf: rules.detect(view(spark, sf, "flows"), rules.load_rules(source))


def _returned(spark, sf):
    (rule,) = rules.load_rules(RETURNING_RULE)
    return rules.returned_rows(view(spark, sf, "flows"), rule)


def _all_returned(spark, sf):
    return rules.detect_returned(view(spark, sf, "flows"), rules.load_rules(RETURNING_RULES))


def _through_frames(spark, sf, name: str) -> DataFrame:
    """Packets as frames that were decoded. The frames are written first, as a capture is: in one expression with
    their decoding they take five times as long."""
    return decode_packets(as_table(encode_frames(view(spark, sf, name)), "frames"))


def _tcp_decoded(spark, sf):
    """TCP summaries of packets that went through frames, with the counters only frames carry."""
    return packets.tcp_summary(_through_frames(spark, sf, "packets"))


def _segments(spark, sf):
    """TCP packets of connections, as frames that were decoded."""
    return _through_frames(spark, sf, "segments")


def _legacy(spark, sf):
    return rules.legacy_matches(view(spark, sf, "flows"), rules.load_legacy_rules(LEGACY_RULES))


def _task_durations(spark, sf):
    events = job_history(view(spark, sf, "history"))
    return text.task_durations(events).select("attempt", "start_ms", "finish_ms", "duration_ms")


def _proto_mix(spark, sf):
    rows = packets.ipv4(view(spark, sf, "packets"))
    return rows.groupBy("proto").agg(F.count("*").alias("n"), F.sum("ip_len").alias("bytes"))


def _training(spark, sf):
    return classify.training_rows(view(spark, sf, "packets"))


def _fit_normal(spark, sf):
    fitted = classify.fit_normal(_training(spark, sf))
    return fitted.select("label", "n", *[F.round(c, 6).alias(c) for c in fitted.columns[2:]])


def _fit_logit(spark, sf):
    return classify.fit_logit(_training(spark, sf)).select(
        "term", F.round("estimate", 8).alias("estimate"), F.round("std_error", 8).alias("std_error"),
        F.round("p_value", 5).alias("p_value"))


def _fit_gmm(spark, sf):
    fitted = classify.fit_gmm(_training(spark, sf))
    return fitted.select("label", F.round("weight", 5).alias("weight"), *[F.round(c, 3).alias(c) for c in fitted.columns[2:]])


def _success(spark, sf):
    return classify.success_ratio(classify.classify_gmm(view(spark, sf, "packets")))


def _in_pieces(spark: SparkSession, df: DataFrame, name: str, pieces: int = 3, rows_a_file: int = ROWS_A_FILE) -> DataFrame:
    """A stream of the rows of ``df``, which come in several micro-batches. Each is of as many files as its rows need,
    so that more rows are written and read by more tasks."""
    path = scratch_path(spark, name)
    files = max(1, -(-df.count() // (pieces * rows_a_file)))
    df.repartition(pieces * files).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def _busy_hour(spark, sf):
    """The flows, their days laid over the five-minute periods of an hour."""
    day = F.expr("first_us DIV 86400000000")
    return view(spark, sf, "flows").withColumn("first_us", F.lit(HOUR_US) + F.pmod(day, F.lit(24)) * 150_000_000)


def _monitored(spark, sf):
    root = scratch_path(spark, "monitor")
    monitor.start_monitor(_in_pieces(spark, _busy_hour(spark, sf), "flow-batches"), root, "backbone",
                          {"availableNow": True}, threshold=SCAN_PORTS).awaitTermination()
    return root


def _monitor_findings(spark, sf):
    """Port scans, spoofs and volumes by period, from the tables that the monitor wrote."""
    root, db = scratch_path(spark, "monitor"), _new_database(spark, "monitored")
    tables.create_report_views(spark, db)
    monitor.start_monitor(_in_pieces(spark, _busy_hour(spark, sf), "flow-batches"), root, "backbone",
                          {"availableNow": True}, threshold=SCAN_PORTS, registry=view(spark, sf, "registry"),
                          reports=db).awaitTermination()
    scans, spoofed = (read_partitions(spark, f"{root}/{name}", columns, **monitor.PERIOD_TYPES) for name, columns in (
        ("scan", "src_addr long, dst_addr long, cnt long"), ("spoofs", "src_addr long, dst_addr long")))
    nobody = F.lit(None).cast("bigint")
    return scans.select(F.lit("scan").alias("kind"), "ds", "ts", "src_addr", "dst_addr", F.col("cnt").alias("n")).unionByName(
        spoofed.groupBy(F.lit("spoof").alias("kind"), "ds", "ts", "src_addr", "dst_addr").agg(F.count("*").alias("n"))
    ).unionByName(spark.table(f"{db}.totalvolume").select(
        F.lit("volume").alias("kind"), "ds", "ts", nobody.alias("src_addr"), nobody.alias("dst_addr"), F.col("octets").alias("n")))


def _distinct_sketches(spark, sf):
    """Distinct counts over all periods but the first, from sketches written per period, beside the exact ones."""
    rows, path = view(spark, sf, "packets"), scratch_path(spark, "sketches")
    sketches.period_sketches(rows).write.parquet(path)
    periods = spark.read.parquet(path)
    begin = (periods.agg(F.min("bucket")).first()[0] or 0) + 60
    estimated = sketches.over_range(periods, begin)
    later = packets.ipv4(rows).where(F.col("ts_us") >= begin * 1_000_000)
    sides = later.select(F.explode(F.array("src_addr", "dst_addr")).alias("addr")).agg(F.count_distinct("addr").alias("x_addresses"))
    exact = later.agg(F.count_distinct("src_addr").alias("x_sources"), F.count_distinct("dst_addr").alias("x_destinations"),
                      F.count_distinct(*FIVE_TUPLE).alias("x_flows"))
    parts = estimated.unionByName(exact, allowMissingColumns=True).unionByName(sides, allowMissingColumns=True)
    both = parts.agg(*[F.max(c).alias(c) for c in parts.columns])
    return both.select("bytes", "packets", *[F.col(f"x_{c}").alias(c) for c in sketches.SKETCHES], *[
        (F.abs(F.col(c) - F.col(f"x_{c}")) <= 0.02 * F.col(f"x_{c}")).alias(f"{c}_close") for c in sketches.SKETCHES])


def _stream_flowstats(spark, sf):
    return monitor.monitored_stats(spark, _monitored(spark, sf))


def _stream_captures(spark, sf):
    """Flows as export packets in capture files, which a stream frames, decodes and hands to the monitor; then the
    first batch comes again."""
    path, root = scratch_path(spark, "exports"), scratch_path(spark, "monitor")
    keyed = view_over(table(spark, sf, "lineitem"), "flows", keep=("l_orderkey",)).withColumn(
        "month", F.expr("first_us DIV 2592000000000"))
    # Written first: to put them in order of time Spark samples them, which would encode all of them once more.
    exports = as_table(netflow.encode_netflow_v5(keyed, ["l_orderkey", "month"]), "export-packets")
    write_pcap(exports, path, roll_s=86_400 * 365)
    captured = netflow.netflow_v5(read_pcap_stream(spark, path))
    monitor.start_monitor(captured, root, "backbone", {"availableNow": True}, threshold=SCAN_PORTS,
                          ds_format="yyyy", ts_format="MM", period_s=86_400).awaitTermination()
    loaded = read_partitions(spark, f"{root}/daily_flows", **monitor.PERIOD_TYPES).where("batch = 0")
    again = as_table(loaded.drop("area", "ds", "ts", "batch"), "first-batch")
    monitor.load_period(root, "backbone", SCAN_PORTS, ds_format="yyyy", ts_format="MM", period_s=86_400)(again, 0)
    return monitor.monitored_stats(spark, root)


def _stream_periods(spark, sf):
    return monitor.monitored_stats(spark, _monitored(spark, sf), ["ds", "ts"])


def _appended(spark, sf, name: str, make, time: str, unit: int) -> DataFrame:
    """An aggregated stream over a view, in pieces that follow each other in time; its last row is a year
    after all windows and closes them."""
    rows = view(spark, sf, name)
    last = rows.agg(F.max(time)).first()[0]
    late = None if last is None else last + 366 * 86_400 * unit
    closing = spark.range(1).select(*[
        (F.lit(late) if f.name == time else F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema])
    return monitor.append_all(make, rows, closing, scratch_path(spark, name), time=time)


def _stream_rate(spark, sf):
    return _appended(spark, sf, "packets", windows.rate_stream, "ts_us", 1_000_000)


def _stream_usage(spark, sf):
    return _appended(spark, sf, "usage_samples", windows.usage_stream, "ts_s", 1)


def _stream_detect_state(spark, sf):
    """Detection in event time over the flows, a copy of a matching one a year later closing all bins."""
    chosen, flows_ = rules.load_rules(PATTERN_RULES), view(spark, sf, "flows")
    found = rules.matching(flows_, chosen).limit(1)
    later = (flows_.agg(F.max("first_us")).first()[0] or 0) + 366 * 86_400_000_000
    return monitor.append_all(lambda pieces: detection.detect_stream(pieces, chosen), flows_,
                              found.withColumn("first_us", F.lit(later)), scratch_path(spark, "detect-state"),
                              time="first_us", conf=detection.POLICY)


def _stream_detect(spark, sf):
    root = scratch_path(spark, "detect")
    chosen = rules.load_rules(PATTERN_RULES)
    monitor.start_detection(_in_pieces(spark, view(spark, sf, "flows"), "flow-batches"), root, chosen,
                            {"availableNow": True}, day_format="yyyy-MM").awaitTermination()
    return monitor.reported(spark, root, chosen)


QUERIES: dict[str, Query] = {
    # sources and sinks
    "pcap_roundtrip": _pcap_roundtrip,
    "capture_range": _over("packets", packets.capture_range, *RANGE),
    "capture_range_files": _range_of_captures,
    "netflow_decode": _netflow,
    "flowtools_decode": _flowtools,
    "flow_print": _flow_print,
    "flow_partitions": _flow_partitions,
    "flow_periods": _flow_periods,
    "report_tables": _report_tables,
    "period_join": _period_join,
    "text_roundtrip": _text_roundtrip,
    "task_durations": _task_durations,
    # filters
    "proto_mix": _proto_mix,
    "udp_port_filter": _over("packets", packets.capture_filter, dst_port=53),
    "packet_filter": _over("packets", packets.filter_packets, net=CLIENT_NET, port=443, proto=6),
    "http_requests": _over("packets", packets.http_requests),
    "legacy_rules": _legacy,
    # packets
    "count_up_src_ip": _count_up("srcIP"),
    "count_up_dst_ip": _count_up("dstIP"),
    "count_up_src_port": _count_up("srcPort"),
    "count_up_dst_port": _count_up("dstPort"),
    "count_up_proto": _count_up("proto"),
    "top_n_bytes": _top("bytes"),
    "top_n_packets": _top("packets"),
    "total_stats": _over("packets", packets.total_stats),
    "rate": _over("packets", packets.rate),
    "flow_gen": _over("packets", packets.flow_gen),
    "flow_stats": _over("packets", packets.flow_stats),
    "packet_count": _over("packets", packets.packet_count),
    "flow_totals": _over("packets", packets.flow_totals),
    "bidir_flows": _over("packets", packets.bidir_flows),
    "packets_per_src": _over("packets", packets.packets_per_source),
    "packet_total": _over("packets", packets.packet_total),
    "popularity": _over("packets", packets.popularity),
    "distinct_sketches": _distinct_sketches,
    "adjacency": _adjacency,
    "tcp_summary": _over("packets", packets.tcp_summary),
    "tcp_summary_decoded": _tcp_decoded,
    "tcp_summary_segments": lambda spark, sf: packets.tcp_summary(_segments(spark, sf)),
    "tcp_quality": lambda spark, sf: tcp.tcp_quality(_segments(spark, sf)),
    # text
    "word_count": lambda spark, sf: text.word_count(table(spark, sf, "documents")),
    "path_adjacency": _over("traceroute", text.path_adjacency),
    # flows
    "flowstats": _over("flows", flows.flowstats),
    **{f"flowstats_{report}": _over("flows", flows.flow_report, report) for report in flows.FAN_OUT},
    "scan": _over("flows", flows.scan, SCAN_PORTS),
    "spoof": _spoof("registry"),
    "spoof_masks": _spoof("mixed_registry"),
    "spoof_large": _spoof("mixed_registry", broadcast_rows=0),
    "active_ips": _over("flows", flows.active_ips, CLIENT_NET),
    "active_ip_count": _over("flows", flows.active_ip_count),
    "active_subnets": _over("flows", flows.active_subnets),
    "heavy_users": _over("flows", flows.heavy_users),
    "detect_rules": _detect(rules.SHIPPED_RULES),
    "detect_port_scan": _detect(PORT_SCAN_RULES),
    "detect_synflood": _detect(SYNFLOOD_RULES),
    "detect_patterns": _detect(PATTERN_RULES),
    "detect_returned": _returned,
    "detect_all_returned": _all_returned,
    "flow_key_list": lambda spark, sf: flows.aggregate_by(view(spark, sf, "flows"), rules.load_names(KEY_LIST)),
    "url_users_views": _over("http_log", flows.url_users_views),
    "user_urls": _over("http_log", flows.user_urls),
    "usage_avg": _over("usage_samples", flows.usage_avg),
    "upload_stats": _over("uploads", flows.upload_stats),
    # ordered gaps and classification
    "packet_gaps": _over("packets", packets.packet_gaps),
    "flow_gap_list": _gap_list,
    "flow_means": _over("packets", packets.flow_means),
    "classify_gmm": _over("packets", classify.classify_gmm),
    "classify_normal": _over("packets", classify.classify_normal),
    "success_ratio": _success,
    "fit_normal": _fit_normal,
    "fit_logit": _fit_logit,
    "fit_gmm": _fit_gmm,
    # streams
    "stream_flowstats": _stream_flowstats,
    "stream_periods": _stream_periods,
    "stream_captures": _stream_captures,
    "monitor_findings": _monitor_findings,
    "stream_rate": _stream_rate,
    "stream_usage": _stream_usage,
    "stream_detect": _stream_detect,
    "stream_detect_state": _stream_detect_state,
}
