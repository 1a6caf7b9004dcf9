"""NetFlow v5 export packets and flow-tools records, from hand-built bytes."""

import struct

from pyspark.sql import functions as F

from flowloom.functions.net import parse_ip
from flowloom.sources.netflow import encode_netflow_v5, encode_flowtools, flowtools, netflow_v5, read_flowtools, write_flowtools
from tests.conftest import flow_rows

FIELDS = ["src_addr", "dst_addr", "src_port", "dst_port", "prot", "dpkts", "doctets", "first_us", "last_us",
          "tcp_flags", "syn", "ack", "fin", "src_as", "dst_as", "src_mask", "dst_mask", "src_subnet", "dst_subnet"]


def flow_record(first_ms, last_ms, flags=0x12, smask=24, dmask=16):
    return struct.pack(
        ">IIIHHIIIIHHBBBBHHBBH", parse_ip("10.1.2.3"), parse_ip("192.168.77.9"), parse_ip("10.0.0.254"),
        3, 4, 10, 1500, first_ms, last_ms, 5555, 443, 0, flags, 6, 1, 64512, 7, smask, dmask, 0)


def export(records, count=None, secs=1_700_000_000, nsecs=5_000, uptime=1_000_000, version=5):
    head = struct.pack(">HHIII", version, len(records) if count is None else count, uptime, secs, nsecs) + bytes(8)
    return bytes(42) + head + b"".join(records)


def decode(spark, *frames):
    raw = spark.createDataFrame([(f,) for f in map(bytearray, frames)], "frame binary")
    return netflow_v5(raw).orderBy("first_us").collect()


def test_every_record_of_a_packet_is_read(spark):
    rows = decode(spark, export([flow_record(999_000 + i, 999_500) for i in range(7)]))
    assert len(rows) == 7


def test_fields_times_flags_and_subnets(spark):
    (row,) = decode(spark, export([flow_record(999_000, 999_900)]))
    export_us = 1_700_000_000 * 1_000_000 + 5
    assert (row.timestamp_us, row.sys_uptime) == (export_us, 1_000_000)
    assert row.first_us == export_us - 1_000_000  # one second of uptime before the export
    assert row.last_us == export_us - 100_000
    assert (row.src_port, row.dst_port, row.prot, row.tos) == (5555, 443, 6, 1)
    assert (row.input, row.output, row.dpkts, row.doctets) == (3, 4, 10, 1500)
    assert (row.syn, row.ack, row.fin, row.flows) == (1, 1, 0, 1)
    assert (row.src_as, row.dst_as) == (64512, 7)
    assert row.src_subnet == parse_ip("10.1.2.0") and row.dst_subnet == parse_ip("192.168.0.0")


def test_mask_ends(spark):
    rows = decode(spark, export([flow_record(1, 1, smask=0, dmask=32)]))
    assert rows[0].src_subnet == 0 and rows[0].dst_subnet == parse_ip("192.168.77.9")


def test_announced_records_that_are_missing_and_other_frames(spark):
    one = flow_record(1, 2)
    assert len(decode(spark, export([one, one], count=5))) == 2
    assert decode(spark, export([], count=0)) == []
    assert decode(spark, export([one], version=9)) == []
    assert decode(spark, b"short") == []


def test_export_round_trip(spark):
    rows = [dict(src_port=1000 + i, dst_port=i, first_us=1_700_000_000_000_000 + i * 250_000, dpkts=i + 1)
            for i in range(40)]
    flows = flow_rows(spark, rows)
    exported = encode_netflow_v5(flows.withColumn("part", flows.src_port % 2), ["part"])
    names = flows.columns
    assert sorted(netflow_v5(exported).select(names).collect()) == sorted(flows.collect())


def test_a_packet_has_thirty_records_at_most(spark):
    flows = flow_rows(spark, [dict(src_port=i, first_us=1_700_000_000_000_000 + i) for i in range(2000)])
    exported = encode_netflow_v5(flows, ["prot"])
    assert exported.count() == 67 and exported.agg(F.max(F.length("frame"))).first()[0] == 42 + 24 + 30 * 48
    assert sorted(r.src_port for r in netflow_v5(exported).collect()) == list(range(2000))


def test_flowtools_files(spark, tmp_path):
    flows = flow_rows(spark, [dict(src_port=i, first_us=i * 1_000_000) for i in range(500)])
    write_flowtools(encode_flowtools(flows.repartition(3)), str(tmp_path / "f"))
    (tmp_path / "f" / "tail").write_bytes(bytes(30))
    for split in (None, 1000):
        rows = read_flowtools(spark, str(tmp_path / "f"), split).select(flows.columns)
        assert sorted(rows.collect()) == sorted(flows.collect())


def test_flowtools_record(spark):
    body = bytearray(flow_record(0, 0))
    body[24:32] = struct.pack("<II", 1_700_000_000, 1_700_000_009)  # little-endian seconds
    raw = spark.createDataFrame([(bytearray(16) + body,), (bytearray(10),)], "record binary")
    (row,) = flowtools(raw).collect()
    assert (row.first_us, row.last_us) == (1_700_000_000_000_000, 1_700_000_009_000_000)
    assert (row.src_addr, row.dst_port, row.doctets) == (parse_ip("10.1.2.3"), 443, 1500)


def test_flowtools_file(spark, tmp_path):
    flows = flow_rows(spark, [dict(src_port=i, first_us=i * 1_000_000) for i in range(100)])
    records = [bytes(r.record) for r in encode_flowtools(flows).collect()]
    (tmp_path / "ft").write_bytes(b"".join(records))
    back = read_flowtools(spark, str(tmp_path / "ft")).select(flows.columns)
    assert sorted(back.collect()) == sorted(flows.collect())
