"""Flow operators, address checks and text jobs on small inputs."""

import random

from flowloom.functions.net import parse_ip
from flowloom.operators import anomaly, flows, text
from flowloom.sources.text import read_delimited, read_job_history, write_text
from tests.conftest import flow_rows

NET = parse_ip


def registry(spark, rows):
    return spark.createDataFrame(rows, "organ string, asn int, prefix long, mask int")


def spoofed(spark, flow_list, networks, **options):
    got = anomaly.spoofs(flow_rows(spark, flow_list), registry(spark, networks), **options)
    return sorted(r.first_us for r in got.collect())


def test_spoof_takes_the_longest_network(spark):
    networks = [("wide", 1, NET("10.0.0.0"), 8), ("narrow", 2, NET("10.1.0.0"), 16), ("two", 3, NET("11.0.0.0"), 8),
                ("two", 4, NET("11.0.0.0"), 8)]
    rows = [
        dict(src_addr=NET("10.9.9.9"), src_as=1, first_us=1),   # right
        dict(src_addr=NET("10.1.9.9"), src_as=1, first_us=2),   # right for the wide one only
        dict(src_addr=NET("10.1.9.9"), src_as=2, first_us=3),   # right
        dict(src_addr=NET("12.0.0.1"), src_as=1, first_us=4),   # not registered
        dict(src_addr=NET("11.0.0.1"), src_as=4, first_us=5),   # right: one of two registered
        dict(src_addr=NET("10.1.9.9"), src_as=1, first_us=6),   # as 2, once more
    ]
    assert spoofed(spark, rows, networks) == [2, 4, 6]
    assert spoofed(spark, rows, networks, broadcast_rows=0) == [2, 4, 6]
    assert spoofed(spark, rows, []) == [1, 2, 3, 4, 5, 6]


def test_spoof_gives_the_same_rows_either_way(spark):
    rng = random.Random(2)
    networks = [("x", rng.randrange(4), rng.randrange(256) << 24 | rng.randrange(4) << 16, rng.choice([8, 14, 16, 24, 32]))
                for _ in range(300)] + [("x", 1, None, 8), ("x", 1, 5, None), ("x", None, NET("9.0.0.0"), 8)]
    rows = [dict(src_addr=rng.choice([None, rng.randrange(256) << 24 | rng.randrange(4) << 16]),
                 src_as=rng.choice([None, 0, 1, 2, 3]), first_us=i) for i in range(400)]
    rows += [dict(src_addr=NET("10.0.0.1"), src_as=77, first_us=1000 + i) for i in range(300)]  # one busy source
    got = spoofed(spark, rows, networks)
    assert got == spoofed(spark, rows, networks, broadcast_rows=0) and 300 < len(got) < 700
    assert {i for i, r in enumerate(rows) if r["src_addr"] is None or r["src_as"] is None} <= set(got)


def test_scan_counts_distinct_ports_above_the_threshold(spark):
    rows = [dict(dst_port=i % 11, first_us=100 - i) for i in range(50)] + [dict(src_addr=5, dst_port=i) for i in range(10)]
    got = [tuple(r) for r in flows.scan(flow_rows(spark, rows)).collect()]
    assert got == [(1, 2, 11, 51)]


def test_flowstats_over_no_flows(spark):
    assert flows.flowstats(flow_rows(spark, [dict()]).where("false")).count() == 0


def test_flowstats_by_period(spark):
    df = flow_rows(spark, [dict(first_us=1), dict(first_us=2), dict(first_us=2)])
    got = {r.first_us: r.flows for r in flows.flowstats(df, by=["first_us"], types=["totalVolume"]).collect()}
    assert got == {1: 1, 2: 2}


def test_days_and_areas_of_active_addresses(spark):
    day = 86_400_000_000
    df = flow_rows(spark, [dict(), dict(first_us=5), dict(src_addr=9, first_us=day)])
    got = sorted(tuple(r) for r in flows.active_ip_count(df).collect())
    assert got == [("1970-01-01", 2), ("1970-01-02", 2)]
    by_area = flows.active_ip_count(df.selectExpr("'x' AS area", "*"), by=("area",)).collect()
    assert {r.area for r in by_area} == {"x"} and len(by_area) == 2


def test_key_lists_group_by_field_names(spark):
    df = flow_rows(spark, [dict(tcp_flags=2), dict(tcp_flags=18), dict(prot=17)])
    got = sorted(tuple(r) for r in flows.aggregate_by(df, ["prot", "ack"]).collect())
    assert got == [(6, 0, 100, 1, 1), (6, 1, 100, 1, 1), (17, 0, 100, 1, 1)]


def test_flow_print_is_in_key_then_time_order(spark):
    rows = [dict(src_addr=a, src_port=s, first_us=t) for a in (3, 1) for s in (9, 8) for t in (5, 4, 6)]
    got = [(r.src_addr, r.src_port, r.first_us) for r in flows.flow_print(flow_rows(spark, rows)).collect()]
    assert got == sorted(got)


def test_words_are_split_at_every_space_character(spark):
    df = spark.createDataFrame([(" a\tb\n\na b\r\fc ",), ("",), (None,), (" a",)], "text string")
    assert {r.word: r.n for r in text.word_count(df).collect()} == {"a": 2, "b": 2, "c": 1, " a": 1}


def trace(*values):
    fields = [str(i) for i in range(15)]
    for at, value in values:
        fields[at] = value
    return "|".join(fields)


def test_path_adjacency_drops_null_hops_and_bad_lines(spark, tmp_path):
    a, b = (4, "a"), (12, "b")
    lines = [trace(a, b, (14, "10")), trace(a, b, (14, "13")), trace(a, b, (10, "0.0.0.0")), trace(a, b, (10, "0")),
             trace(a, b, (14, "x")), trace(a, b) + "|more", "a|b", trace(a, (12, "c"), (14, "2.4"))]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    got = sorted(tuple(r) for r in text.path_adjacency(df).collect())
    assert got == [("a", "b", 2, 12), ("a", "c", 1, 2)]


def test_job_history_nested_and_flat(spark, tmp_path):
    started = ('{"type":"MAP_ATTEMPT_STARTED","event":{"TaskAttemptStarted":{"attemptId":"t1","startTime":100,'
               '"locality":"NODE_LOCAL"}}}')
    finished = ('{"type":"MAP_ATTEMPT_FINISHED","event":{"MapAttemptFinished":{"attemptId":"t1","finishTime":350,'
                '"hostname":"w1","state":"done with input file f.pcap here"}}}')
    unpaired = '{"type":"MAP_ATTEMPT_STARTED","attemptId":"t2","time_ms":5}'
    (tmp_path / "job").write_text("\n".join(["Avro-Json", "", started, '{"type":"AM_STARTED"}', finished, unpaired]))
    rows = text.task_durations(read_job_history(spark, str(tmp_path / "job"))).collect()
    assert [tuple(r) for r in rows] == [("t1", 100, "NODE_LOCAL", 350, 250, "w1", "f.pcap")]


def test_delimited_text_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    write_text(df, str(tmp_path / "out"), sep="|")
    assert sorted(read_delimited(spark, str(tmp_path / "out"), "|", "k string, n int").collect()) == sorted(df.collect())
    (tmp_path / "bad").write_text("a|1\nb|x\nc|3\n")
    assert sorted(r.k for r in read_delimited(spark, str(tmp_path / "bad"), "|", "k string, n int").collect()) == ["a", "c"]
    bad = read_delimited(spark, str(tmp_path / "bad"), "|", "k string, n int")
    assert bad.count() == len(bad.collect()) == len(bad.select("k").collect()) == len(bad.select("n").collect()) == 2


def test_intervals_restart_every_fifteen_seconds(spark):
    df = spark.createDataFrame([(0, 10, 1), (14, 20, 3), (15, 7, 7)], "ts_s long, capacity long, containers long")
    got = sorted(tuple(r) for r in flows.usage_avg(df).collect())
    assert got == [(0, 2, 15.0, 2.0), (15, 1, 7.0, 7.0)]
