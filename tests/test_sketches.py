"""Sketches of periods against exact counts over ranges of them."""

import random

import pytest

from flowloom.operators import packets as packet_ops
from flowloom.operators.sketches import over_range, period_sketches, popularity_over, popularity_sketches
from tests.conftest import packet_rows

US = 1_000_000


@pytest.fixture(scope="module")
def traffic(spark):
    return spark.range(60_000, numPartitions=4).selectExpr(
        "id AS pkt_id", "id * 5000 AS ts_us", "hash(id % 20000) & 2147483647 AS src_addr", "id % 7 AS dst_addr",
        "cast(id % 900 AS int) AS src_port", "80 AS dst_port", "6 AS proto", "100 AS ip_len", "60 AS payload_len",
        "'x' AS payload", "2048 AS eth_type")


@pytest.mark.parametrize("begin, end", [(None, None), (60, 240), (120, 180), (1000, 2000)])
def test_union_over_periods_is_close(spark, traffic, tmp_path, begin, end):
    period_sketches(traffic).write.parquet(str(tmp_path / "periods"))
    got = over_range(spark.read.parquet(str(tmp_path / "periods")), begin, end).first()
    inside = traffic.where(f"ts_us >= {(begin or 0) * US} AND ts_us < {(end or 10**6) * US}")
    want = {r.metric: r.value for r in packet_ops.total_stats(inside, interval=10**9).collect()}
    assert (got.bytes, got.packets) == (want["IPv4 bc"], want["IPv4 pc"])
    for column, metric in (("sources", "IPv4 srcaddr"), ("destinations", "IPv4 dstaddr"), ("addresses", "IPv4 addr"),
                           ("flows", "IPv4 flows")):
        assert got[column] == pytest.approx(want[metric], rel=0.02)


def test_popularity_over_periods_is_close(traffic):
    got = {r.dst_addr: r.n for r in popularity_over(popularity_sketches(traffic), 60, 180).collect()}
    want = {r.dst_addr: r.n for r in packet_ops.popularity(traffic.where("ts_us >= 60000000 AND ts_us < 180000000")).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=0.02) for k in want)


def test_other_packets_and_empty_tables(spark):
    rows = packet_rows(spark, [(1, 0, 1, 2, 3, 4, 6, 100, 60, "x", 0x86DD)])
    assert period_sketches(rows).collect() == []
    row = over_range(period_sketches(rows)).first()
    assert tuple(row) == (0, 0, 0, 0, 0, 0)
