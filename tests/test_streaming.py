"""Streams give what the batch operators give, also in pieces, out of order and after a restart."""

import random

import pytest
from pyspark.sql import functions as F

from flowloom.operators import packets as packet_ops
from flowloom.operators import rules
from flowloom.operators.flows import flowstats, usage_avg
from flowloom.plans import queries
from flowloom.plans.queries import QUERIES, _in_pieces
from flowloom.plans.views import view
from flowloom.sources.netflow import encode_netflow_v5, netflow_v5
from flowloom.sources.pcap import read_pcap_stream, write_pcap
from flowloom.sources.tables import create_report_views, read_partitions
from flowloom.streaming import detection, monitor, windows
from tests.conftest import flow_rows
from tests.test_packets import p
from tests.conftest import packet_rows

NOW = {"availableNow": True}
US = 1_000_000


def rows_of(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(sorted(df.columns)).collect())


def drip(spark, df, folder, pieces=3):
    """A stream over the rows of ``df`` in several files, one micro-batch each."""
    df.repartition(pieces).write.parquet(str(folder))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def some_flows(spark, n=300):
    rng = random.Random(4)
    return flow_rows(spark, [dict(
        src_addr=rng.choice([1, 1, 1, 2, 3]), dst_addr=rng.randrange(3), dst_port=rng.randrange(40),
        dpkts=rng.randrange(9), first_us=rng.randrange(900) * US) for _ in range(n)])


def test_monitor_equals_batch_and_survives_a_rerun(spark, tmp_path):
    df = some_flows(spark)
    stream = drip(spark, df, tmp_path / "in")
    root = str(tmp_path / "out")
    monitor.start_monitor(stream, root, "x", NOW).awaitTermination()
    assert rows_of(monitor.monitored_stats(spark, root)) == rows_of(flowstats(df))
    by_period = rows_of(monitor.monitored_stats(spark, root, ["ts"]))
    assert by_period == rows_of(flowstats(monitor.with_period(df), by=["ts"]))
    # A batch that runs again replaces its own output.
    printed = spark.read.parquet(f"{root}/daily_flows").where("batch = 0").select(df.columns)
    again = spark.createDataFrame(printed.collect(), df.schema)
    monitor.load_period(root, "x")(again, 0)
    assert rows_of(monitor.monitored_stats(spark, root)) == rows_of(flowstats(df))
    assert spark.read.parquet(f"{root}/daily_flows").count() == df.count()


def test_reports_come_from_the_sums_of_all_batches(spark, tmp_path, monkeypatch):
    df, db, calls = some_flows(spark), "reports_of_sums", []
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path / 'db'}'")
    create_report_views(spark, db)
    monkeypatch.setattr(monitor, "flowstats", lambda *args, **kwargs: calls.append(1) or flowstats(*args, **kwargs))
    monitor.start_monitor(drip(spark, df, tmp_path / "in"), str(tmp_path / "out"), "x", NOW, reports=db).awaitTermination()
    got = spark.table(f"{db}.portingress").select("ts", "port", "octets", "pkts", "flows")
    want = flowstats(monitor.with_period(df), by=["ts"]).where("type = 'dstPort'").withColumnRenamed("aggr_key", "port")
    assert rows_of(got) == rows_of(want.select(got.columns)) != []
    assert len(calls) == 3  # once a batch, over its own flows


def test_monitor_finds_scans_and_spoofs_per_period(spark, tmp_path):
    scan = [dict(src_addr=7, dst_port=i, first_us=10 * US) for i in range(4)]
    spread = [dict(src_addr=8, dst_port=i, first_us=i * 300 * US) for i in range(4)]
    df = flow_rows(spark, scan + spread)
    registry = spark.createDataFrame([("a", 1, 7, 32)], "organ string, asn int, prefix long, mask int")
    root = str(tmp_path / "out")
    monitor.start_monitor(drip(spark, df, tmp_path / "in", 3), root, "x", NOW, threshold=3,
                          registry=registry).awaitTermination()
    types = monitor.PERIOD_TYPES
    found = read_partitions(spark, f"{root}/scan", **types).collect()
    assert [(r.src_addr, r.cnt, r.ds, r.ts) for r in found] == [(7, 4, "1970-01-01", "0000")]
    spoofed = read_partitions(spark, f"{root}/spoofs", **types).collect()
    assert sorted((r.src_addr, r.ts) for r in spoofed) == [(8, f"00{m:02d}") for m in (0, 5, 10, 15)]


def test_batches_have_more_files_as_they_have_more_rows(spark):
    df = some_flows(spark)
    for rows_a_file, files in ((25, 4), (10**6, 1)):
        stream, seen = _in_pieces(spark, df, "pieces", rows_a_file=rows_a_file), []
        stream.writeStream.foreachBatch(lambda batch, _: seen.append(
            (batch.select(F.input_file_name()).distinct().count(), batch.count()))).trigger(
            **NOW).start().awaitTermination()
        assert [n for n, _ in seen] == [files] * 3 and sum(n for _, n in seen) == df.count()


def test_rate_stream_equals_batch_out_of_order(spark, tmp_path):
    rng = random.Random(6)
    rows = [p(i, rng.randrange(400) * US + i, eth=rng.choice([2048, 0x86DD, 0x0806])) for i in range(200)]
    df = packet_rows(spark, rows)
    closing = packet_rows(spark, [p(999, 10**6 * US)])
    got = monitor.append_all(windows.rate_stream, df, closing, str(tmp_path / "run"))
    assert rows_of(got) == rows_of(packet_ops.rate(df))


def test_watermark_closes_windows_in_append_mode(spark, tmp_path):
    df = packet_rows(spark, [p(1, 0), p(2, 30 * US), p(3, 3600 * US)])
    stream = windows.rate_stream(drip(spark, df, tmp_path / "in", pieces=1))
    out = str(tmp_path / "out")
    (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp"))
     .outputMode("append").trigger(**NOW).start().awaitTermination())
    assert [(r.bucket, r.packets) for r in spark.read.parquet(out).collect()] == [(0, 2)]


def test_flow_stats_stream_equals_batch(spark, tmp_path):
    rng = random.Random(8)
    rows = [p(i, rng.randrange(300) * US + i, sport=rng.randrange(5)) for i in range(150)]
    late = [p(999, 10**5 * US), p(1000, 2 * 10**5 * US)]  # closes every window before
    df = packet_rows(spark, rows)
    source = tmp_path / "in"
    for part in (rows, late):
        packet_rows(spark, part).coalesce(1).write.mode("append").parquet(str(source))
    stream = windows.flow_stats_stream(spark.readStream.schema(df.schema).parquet(str(source)))
    out = str(tmp_path / "out")
    (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp"))
     .outputMode("append").trigger(**NOW).start().awaitTermination())
    got = spark.read.parquet(out).where("bucket < 1000")
    assert rows_of(got) == rows_of(packet_ops.flow_stats(df))


def test_detection_stream_equals_batch(spark, tmp_path):
    df = some_flows(spark)
    chosen = rules.load_rules(
        "scan;300;prot=6;sip,dip;dport;unique;flows=9-;sip\nmany;300;prot=6;sip;dip;count;pkts=50-;sip")
    root = str(tmp_path / "out")
    monitor.start_detection(drip(spark, df, tmp_path / "in", 4), root, chosen, NOW).awaitTermination()
    want = rows_of(rules.detect(df, chosen))
    assert want and rows_of(monitor.reported(spark, root, chosen)) == want


def test_reports_change_with_late_flows_and_stand_once(spark, tmp_path):
    few = rules.load_rules("few;300;prot=6;sip;dip;count;flows=1-2;sip\nmany;300;prot=6;sip;dip;count;flows=3-;sip")
    write, root = monitor.detect_batch(str(tmp_path / "out"), few), str(tmp_path / "out")
    assert monitor.reported(spark, root, few).collect() == []
    parts = [flow_rows(spark, [dict(src_addr=a, first_us=t * US) for a, t in rows])
             for rows in ([(1, 0), (2, 0)], [], [(1, 5), (1, 9), (3, 900)], [(2, 7)])]
    udp = flow_rows(spark, [dict(prot=17)])
    for batch_id, part in enumerate([udp, *parts]):
        write(part, batch_id)
    write(parts[-1], 4)  # the last batch again
    every = flow_rows(spark, [dict(src_addr=a, first_us=t * US) for a, t in [
        (1, 0), (2, 0), (1, 5), (1, 9), (3, 900), (2, 7)]])
    want = rows_of(rules.detect(every, few))
    assert len(want) == 3 and rows_of(monitor.reported(spark, root, few)) == want


def test_batches_without_flows_do_nothing(spark, tmp_path):
    root, write = str(tmp_path / "out"), monitor.load_period(str(tmp_path / "out"), "x")
    write(flow_rows(spark, []), 0)
    assert monitor.monitored_stats(spark, root).collect() == []
    df = some_flows(spark, 50)
    write(df, 1)
    write(flow_rows(spark, []), 2)
    assert rows_of(monitor.monitored_stats(spark, root)) == rows_of(flowstats(df))
    printed = monitor.monitored_flows(spark, root, area="x")
    assert printed.count() == 50


def test_captured_exports_through_the_monitor(spark, tmp_path):
    df = some_flows(spark, 60)
    exported = encode_netflow_v5(df.withColumn("part", df.src_port * 0 + df.dst_port), ["part"])
    write_pcap(exported, str(tmp_path / "in"), files=2)
    flows = netflow_v5(read_pcap_stream(spark, str(tmp_path / "in"), tasks=2))
    root = str(tmp_path / "out")
    monitor.start_monitor(flows, root, "x", NOW).awaitTermination()
    assert rows_of(monitor.monitored_stats(spark, root)) == rows_of(flowstats(df))


def test_queries_keep_all_rows_of_events_that_span_years(spark, data, tmp_path):
    events = spark.read.parquet(f"{data}/events.parquet").limit(400)
    wide = events.withColumn("ts", F.expr("ts + make_dt_interval((event_id * 37) % 40000)"))
    wide.write.parquet(str(tmp_path / "wide/events.parquet"))
    events.limit(0).write.parquet(str(tmp_path / "empty/events.parquet"))
    for query, name, batch in (("stream_rate", "packets", packet_ops.rate), ("stream_usage", "usage_samples", usage_avg)):
        got = QUERIES[query](spark, str(tmp_path / "wide"))
        want = batch(view(spark, str(tmp_path / "wide"), name))
        assert rows_of(got) == rows_of(want.select(got.columns)) != []
        assert QUERIES[query](spark, str(tmp_path / "empty")).count() == 0


def test_detection_in_state_equals_batch(spark, tmp_path):
    chosen = rules.load_rules(
        "scan;300;prot=6;sip,dip;dport;unique;flows=3-;sip\nmany;600;prot=6;sip;dip;count;pkts=5-;sip\nnone;60;prot=99;sip;dip;count;null;sip")
    rng = random.Random(12)
    df = flow_rows(spark, [dict(src_addr=rng.randrange(3), dst_port=rng.randrange(6), prot=rng.choice([6, 6, 17]),
                                first_us=rng.randrange(7200) * US) for _ in range(400)])
    closing = flow_rows(spark, [dict(first_us=10**6 * US)])
    progress = []
    got = monitor.append_all(lambda s: detection.detect_stream(s, chosen, "1 minute"), df, closing, str(tmp_path / "run"),
                             files=6, time="first_us", progress=progress, conf=detection.POLICY)
    want = rules.detect(df, chosen)
    assert rows_of(got.select(want.columns)) == rows_of(want) != []
    assert detection.late_rows(progress) == 0
    partial = rules.partial_groups(rules.matched(df, chosen)).count()
    assert 0 < detection.most_state(progress) < partial / 2  # closed bins are released


def test_flows_after_their_bin_are_dropped_and_counted(spark, tmp_path):
    chosen = rules.load_rules("many;300;prot=6;sip;dip;count;null;sip")
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    progress = []
    for times in ([0, 10, 4000], [20, 3900], [10**5]):
        flow_rows(spark, [dict(first_us=t * US) for t in times]).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(flow_rows(spark, []).schema).parquet(source)
        query = detection.start_event_time_detection(stream, root, chosen, "10 minutes", NOW)
        query.awaitTermination()
        progress += query.recentProgress
    got = sorted((r.bin_start, r.flows) for r in spark.read.parquet(f"{root}/out").collect())
    assert got == [(0, 2), (3900, 2)]
    assert detection.late_rows(progress) == 1
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "min"


def test_windows_in_time_order_release_their_state(spark, tmp_path):
    samples = spark.range(4000).selectExpr("id * 7 AS ts_s", "id % 50 AS capacity", "id % 9 AS containers")
    closing = spark.createDataFrame([(10**9, 0, 0)], "ts_s long, capacity long, containers long")
    progress = []
    got = monitor.append_all(windows.usage_stream, samples, closing, str(tmp_path / "run"), files=8, time="ts_s",
                             progress=progress)
    assert rows_of(got.where("bucket < 100000")) == rows_of(usage_avg(samples))
    assert detection.late_rows(progress) == 0
    assert detection.most_state(progress) < usage_avg(samples).count() / 4


def test_exports_are_encoded_before_they_are_sampled(spark, data, monkeypatch):
    def seen(packets, *args, **kwargs):
        raise LookupError(packets._jdf.queryExecution().optimizedPlan().toString())
    monkeypatch.setattr(queries, "write_pcap", seen)
    with pytest.raises(LookupError) as found:
        QUERIES["stream_captures"](spark, data)
    assert "Relation" in str(found.value) and "Window" not in str(found.value)
