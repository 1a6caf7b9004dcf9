"""Packet operators on hand-built packets; ordered gaps against brute force."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from flowloom.functions.net import direction, forward_key, parse_ip, reverse_key
from flowloom.operators import packets as ops
from flowloom.plans.gaps import in_chunks
from tests.conftest import packet_rows

S = 1_000_000


def p(i, t, src=1, dst=2, sport=10, dport=80, proto=6, ip_len=100, payload_len=60, payload="data", eth=2048):
    return (i, t, src, dst, sport, dport, proto, ip_len, payload_len, payload, eth)


def test_ipv6_is_not_counted_as_ipv4_or_non_ip(spark):
    df = packet_rows(spark, [p(1, 0), p(2, 0, eth=0x86DD), p(3, 0, eth=0x0806)])
    got = {r.family: (r.bytes, r.packets) for r in ops.rate(df).collect()}
    assert got == {"IPv4": (100, 1), "IPv6": (100, 1), "non-IP": (0, 1)}


def test_family_uses_the_version_nibble_where_decoded(spark):
    df = packet_rows(spark, [p(1, 0), p(2, 0)]).withColumn("ip_version", F.when(F.col("pkt_id") == 1, 4).otherwise(6))
    assert [r.family for r in df.withColumn("family", ops.family(df)).orderBy("pkt_id").collect()] == ["IPv4", "IPv6"]
    assert ops.packets_per_source(df).first().n == 1


def test_rate_keeps_the_bucket_of_non_ip(spark):
    df = packet_rows(spark, [p(1, 61 * S, eth=0x0806), p(2, 121 * S, eth=0x0806)])
    assert sorted(r.bucket for r in ops.rate(df).collect()) == [60, 120]


def test_top_n_is_numeric_descending_with_ties_by_key(spark):
    df = packet_rows(spark, [p(1, 0, src=1, ip_len=9), p(2, 0, src=2, ip_len=100), p(3, 0, src=3, ip_len=100)])
    counts = ops.count_up(df, "srcIP")
    assert [r.src_addr for r in ops.top_n(counts, 2, "bytes").collect()] == [2, 3]
    assert [r.src_addr for r in ops.top_n(counts, 2, "packets").collect()] == [1, 2]


def test_adjacency_is_a_set_in_bounded_blocks(spark):
    near = [parse_ip("10.0.0.1"), parse_ip("10.0.0.2")]
    far = parse_ip("10.9.0.1")
    rows = [p(i, i, src=7, dst=d) for i, d in enumerate([near[0], near[1], near[0], far, near[0]])]
    got = {r.dst_block: r.neighbours for r in ops.adjacency(packet_rows(spark, rows)).collect()}
    assert got == {parse_ip("10.0.0.0"): near, parse_ip("10.9.0.0"): [far]}


def test_endpoint_count_is_distinct_tuples(spark):
    rows = [p(1, 0), p(2, 1 * S), p(3, 2 * S, sport=11), p(4, 61 * S)]
    got = {r.bucket: (r.flows, r.endpoints, r.packets) for r in ops.flow_stats(packet_rows(spark, rows)).collect()}
    assert got == {0: (2, 2, 3), 60: (1, 1, 1)}


def test_packet_count_only_counts_ports_of_tcp_and_udp(spark):
    get = "GET /x HTTP/1.1"
    rows = [p(1, 0, payload=get), p(2, 0, proto=1, payload=get), p(3, 0, proto=17, dport=53, payload=get),
            p(4, 0, payload=get, payload_len=0)]
    got = {r.key: r.n for r in ops.packet_count(packet_rows(spark, rows)).collect()}
    assert got == {"10": 3, "80": 2, "53": 1, "HTTP2": 1}


def test_total_stats_names_every_total(spark):
    got = {r.metric: r.value for r in ops.total_stats(packet_rows(spark, [p(1, 0), p(2, 0, src=2, dst=1)])).collect()}
    assert set(got) == set(ops.TOTAL_METRICS)
    assert (got["IPv4 addr"], got["IPv4 srcaddr"], got["IPv4 flows"], got["IPv6 pc"], got["non-IP protocols"]) == (2, 2, 2, 0, 0)
    empty = ops.total_stats(packet_rows(spark, [p(1, 0)]).where("false"))
    assert {r.value for r in empty.collect()} == {0} and empty.count() == 15


def test_approximate_counts_are_near(spark):
    df = packet_rows(spark, [p(i, 0, src=i) for i in range(500)])
    exact = {r.metric: r.value for r in ops.total_stats(df).collect()}
    near = {r.metric: r.value for r in ops.total_stats(df, approx=True).collect()}
    assert all(abs(near[m] - exact[m]) <= 0.15 * exact[m] for m in exact)
    assert abs(ops.popularity(df, approx=True).first().n - 500) < 75


def test_filters(spark):
    rows = [p(1, 0, src=parse_ip("10.0.0.5")), p(2, 0, src=parse_ip("10.0.1.5"), dport=53, proto=17)]
    df = packet_rows(spark, rows)
    ids = lambda f: sorted(r.pkt_id for r in f.collect())
    assert ids(ops.filter_packets(df, net="10.0.0.0/24")) == [1]
    assert ids(ops.filter_packets(df, net="10.0.0.0/16")) == [1, 2]
    assert ids(ops.filter_packets(df, port=53)) == [2]
    assert ids(ops.capture_filter(df)) == [2] and ids(ops.capture_filter(df, dst_port=1)) == []


def test_conversation_keys(spark):
    df = packet_rows(spark, [p(1, 0, src=1, dst=2, sport=5, dport=6), p(2, 0, src=2, dst=1, sport=6, dport=5)])
    rows = df.select(forward_key().alias("f"), reverse_key().alias("r"), direction().alias("d")).collect()
    assert rows[0].f == rows[1].r and rows[1].f == rows[0].r
    assert [r.d for r in rows] == [1, -1]
    both = ops.bidir_flows(df).collect()
    assert len(both) == 1 and (both[0].packets_ab, both[0].packets_ba) == (1, 1)


def test_tcp_summary_with_decoded_columns(spark):
    df = packet_rows(spark, [p(1, 0, payload_len=0), p(2, 5, payload_len=9)]).withColumns({
        "tcp_flags": F.when(F.col("pkt_id") == 1, 0x10).otherwise(0x13), "window": F.col("pkt_id").cast("int") - 1,
        "ttl": F.lit(60)})
    row = ops.tcp_summary(df).first()
    assert (row.packets, row.data_packets, row.data_bytes) == (2, 1, 9)
    assert (row.syn, row.fin, row.rst, row.ack, row.pure_ack) == (1, 1, 0, 2, 1)
    assert (row.win_min, row.win_max, row.cnt_zerowin, row.ttl_min, row.ttl_max) == (0, 1, 1, 60, 60)


def random_packets(n, seed):
    """One flow holds half of all packets, some at equal times; long silences cross many chunks."""
    rng = random.Random(seed)
    rows, t = [], 0
    for i in range(n):
        t += rng.choice([0, 1, 400, 90_000, 2_500_000, 40_000_000])
        sport = 1 if rng.random() < 0.5 else rng.randrange(2, 12)
        rows.append(p(i, t, sport=sport, ip_len=rng.randrange(40, 1500)))
    rng.shuffle(rows)
    return rows


def brute_gaps(rows):
    flows = defaultdict(list)
    for r in rows:
        flows[r[4]].append((r[1], r[0], r[7]))
    return {key: sorted(v) for key, v in flows.items()}


CUTS = [(1, None), (1_000_000, None), (10**12, None), (60_000_000, 5), (10**9, 7), (10**12, 1)]


@pytest.mark.parametrize("chunk_us, hot_rows", CUTS)
def test_gaps_do_not_depend_on_the_cut(spark, chunk_us, hot_rows):
    rows = random_packets(400, chunk_us)
    flows = brute_gaps(rows)
    want = {(sport, b[1]): (i, b[0] - a[0] if a else None)
            for sport, v in flows.items() for i, (a, b) in enumerate(zip([None, *v], v))}
    got = {(r.src_port, r.pkt_id): (r.seq, r.gap_us)
           for r in ops.packet_gaps(packet_rows(spark, rows), chunk_us, hot_rows).collect()}
    assert got == want


def test_gap_pages_join_to_the_whole_list(spark):
    rows = random_packets(300, 3)
    got = defaultdict(list)
    for r in ops.flow_gap_list(packet_rows(spark, rows), page=7).orderBy("src_port", "page").collect():
        assert len(r.gaps) <= 7
        got[r.src_port] += r.gaps
    want = {k: [b[0] - a[0] for a, b in zip(v, v[1:])] for k, v in brute_gaps(rows).items() if len(v) > 1}
    assert dict(got) == want


def test_flow_means_equal_the_mean_of_gaps(spark):
    rows = random_packets(200, 9)
    got = {r.src_port: r.mean_gap_s for r in ops.flow_means(packet_rows(spark, rows)).collect()}
    for key, v in brute_gaps(rows).items():
        gaps = [(b[0] - a[0]) / S for a, b in zip(v, v[1:])]
        assert got[key] == pytest.approx(sum(gaps) / len(gaps) if gaps else 0.0)


def test_packets_without_ports_keep_their_place(spark):
    df = packet_rows(spark, [p(1, 5, sport=None), p(2, 9, sport=None), p(3, 7)])
    got = {r.pkt_id: (r.src_port, r.gap_us, r.seq) for r in ops.packet_gaps(df).collect()}
    assert got == {1: (None, None, 0), 2: (None, 4, 1), 3: (10, None, 0)}


def test_hot_minutes_are_cut_shorter(spark):
    """Sixty packets a minute with at most ten a chunk: no chunk holds more than that, others stay whole."""
    rows = [p(i, i * S, sport=1) for i in range(120)] + [p(200 + i, i * 7 * S, sport=2) for i in range(8)]
    sizes = in_chunks(packet_rows(spark, rows), ["src_port"], 60 * S, 10).groupBy("src_port", "chunk").count().collect()
    assert max(r["count"] for r in sizes if r.src_port == 1) <= 10
    assert [r["count"] for r in sizes if r.src_port == 2] == [8]
