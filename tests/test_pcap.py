"""Capture files: framing over any split, damaged input, decoding, writing."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from flowloom.functions.net import ip_number, ip_text, parse_ip
from flowloom.sources import pcap
from flowloom.sources.decode import decode_packets, encode_frames
from flowloom.sources.pcap import (
    FILE_HEADER, MANY_TASKS, TASK_BYTES, plan_ranges, read_pcap, read_pcap_stream, write_pcap,
)
from tests.conftest import packet_rows

T0 = 1_704_067_200


def record(sec, usec, frame, wire=None):
    return struct.pack("<IIII", sec, usec, len(frame), wire or len(frame)) + frame


def ethernet(kind, body):
    return bytes(12) + struct.pack(">H", kind) + body


def ipv4_tcp(payload=b"", options=b"", flags=0x18, src="10.0.0.1", dst="10.0.0.2", sport=1234, dport=80):
    ihl = 20 + len(options)
    tcp = struct.pack(">HHIIBBHHH", sport, dport, 7, 9, 5 << 4, flags, 512, 0, 0)
    total = ihl + len(tcp) + len(payload)
    head = struct.pack(">BBHHHBBHII", 0x40 | ihl // 4, 0, total, 0, 0, 61, 6, 0, parse_ip(src), parse_ip(dst))
    return ethernet(0x0800, head + options + tcp + payload)


def write_capture(path, records, tail=b""):
    path.write_bytes(FILE_HEADER + b"".join(records) + tail)


def read_back(spark, path, **options):
    rows = read_pcap(spark, str(path), **options).select("ts_us", "cap_len", "wire_len", "frame").collect()
    return sorted((r.ts_us, r.cap_len, r.wire_len, bytes(r.frame)) for r in rows)


def expected(records):
    out = []
    for r in records:
        sec, usec, cap, wire = struct.unpack("<IIII", r[:16])
        out.append((sec * 1_000_000 + usec, cap, wire, r[16:]))
    return sorted(out)


def random_records(n, seed, adversarial=False):
    rng = random.Random(seed)
    records, t = [], T0 * 1_000_000
    for i in range(n):
        t += rng.randrange(1, 50_000)
        body = rng.randbytes(rng.choice([0, 1, 20, 46, 200, 1400]))
        if adversarial and i % 3 == 0:
            # A payload that is itself a run of capture records, up to its last byte.
            body = b"".join(record(T0 + k, k, rng.randbytes(30)) for k in range(rng.randrange(1, 40)))
        records.append(record(t // 1_000_000, t % 1_000_000, ipv4_tcp(body)))
    return records


@pytest.mark.parametrize("adversarial", [False, True])
@pytest.mark.parametrize("split", [None, 100_000, 33_333, 4_096, 777])
def test_any_split_reads_every_record_once(spark, tmp_path, split, adversarial):
    records = random_records(300, 5, adversarial)
    write_capture(tmp_path / "a.pcap", records)
    assert read_back(spark, tmp_path / "a.pcap", split_bytes=split) == expected(records)


def test_directory_of_files_and_cut_off_tail(spark, tmp_path):
    first, second = random_records(40, 1), random_records(60, 2)
    write_capture(tmp_path / "a.pcap", first, tail=record(T0, 1, b"x" * 100)[:50])
    write_capture(tmp_path / "b.pcap", second, tail=b"\x01\x02")
    (tmp_path / "_hidden").write_bytes(b"not a capture")
    write_capture(tmp_path / "empty.pcap", [])
    assert read_back(spark, tmp_path) == expected(first + second)
    assert read_back(spark, tmp_path, split_bytes=2_000) == expected(first + second)


def test_damaged_bytes_are_skipped(spark, tmp_path):
    first, second = random_records(20, 3), random_records(20, 4)
    (tmp_path / "a.pcap").write_bytes(FILE_HEADER + b"".join(first) + b"\xff" * 37 + b"".join(second))
    assert read_back(spark, tmp_path / "a.pcap") == expected(first + second)


@pytest.mark.parametrize("split", [None, 30_000, 9_000])
def test_long_damage_costs_no_record_in_any_split(spark, tmp_path, split):
    first, second = random_records(60, 13), random_records(250, 14)
    noise = random.Random(15).randbytes(70_000)
    (tmp_path / "a.pcap").write_bytes(FILE_HEADER + b"".join(first) + noise + b"".join(second))
    assert read_back(spark, tmp_path / "a.pcap", split_bytes=split) == expected(first + second)


@pytest.mark.parametrize("split", [None, 50_000, 7_000])
def test_long_packets_are_read(spark, tmp_path, split):
    records = [record(T0, i, ipv4_tcp(b"x" * (12_000 if i % 4 == 0 else 30_000 if i % 4 == 1 else 100))) for i in range(24)]
    write_capture(tmp_path / "a.pcap", records)
    assert read_back(spark, tmp_path / "a.pcap", split_bytes=split) == expected(records)


@pytest.mark.parametrize("split", [None, 4_096, 777])
def test_clocks_may_jump(spark, tmp_path, split):
    """Two months between records, and a first record whose clock was wrong."""
    records = [record(T0 + 3 * i * 86_400, i, ipv4_tcp(b"data")) for i in range(100)]
    records[50:] = [record(T0 + (60 + i) * 86_400, i, ipv4_tcp(b"late")) for i in range(50)]
    write_capture(tmp_path / "a.pcap", records)
    write_capture(tmp_path / "b.pcap", [record(5, 0, ipv4_tcp()), *records])
    got = read_back(spark, tmp_path, split_bytes=split)
    assert len(got) == 201 and got == expected([record(5, 0, ipv4_tcp()), *records, *records])


def test_skipped_bytes_are_told(spark, tmp_path):
    records = random_records(40, 7)
    write_capture(tmp_path / "a.pcap", records)
    (tmp_path / "b.pcap").write_bytes(FILE_HEADER + b"".join(records[:20]) + b"\xff" * 37 + b"".join(records[20:]) + b"\x01\x02")
    write_capture(tmp_path / "c.pcap", [])
    for split in (None, 3_000):
        rows = pcap.capture_coverage(spark, str(tmp_path), split_bytes=split).collect()
        assert {r.file[-6:]: (r.records, r.skipped) for r in rows} == {
            "a.pcap": (40, 0), "b.pcap": (40, 39), "c.pcap": (0, 0)}


def test_times_are_compared_before_frames_are_copied(spark, tmp_path):
    write_capture(tmp_path / "a.pcap", [record(T0 + i, 0, ipv4_tcp(b"x" * 50)) for i in range(100)])
    late = read_pcap(spark, str(tmp_path), frame_bytes=20).where(F.col("ts_us") > (T0 + 89) * 10**6)
    assert sorted(r.ts_us for r in late.collect()) == [(T0 + i) * 10**6 for i in range(90, 100)]
    assert {(len(r.frame), r.cap_len) for r in late.collect()} == {(20, len(ipv4_tcp(b"x" * 50)))}
    reader = pcap.PcapReader(pcap._Options({"path": str(tmp_path)}))
    list(reader.pushFilters([pcap.GreaterThan(("ts_us",), 5), pcap.LessThanOrEqual(("ts_us",), 9)]))
    assert (reader.options.wanted.begin_us, reader.options.wanted.end_us) == (5, 9)


def test_without_file_header(spark, tmp_path):
    records = random_records(10, 6)
    (tmp_path / "raw").write_bytes(b"".join(records))
    assert read_back(spark, tmp_path / "raw", header=False) == expected(records)


def test_other_formats_are_rejected(spark, tmp_path):
    (tmp_path / "big.pcap").write_bytes(b"\xa1\xb2\xc3\xd4" + bytes(40))
    with pytest.raises(Exception, match="little-endian microsecond"):
        read_back(spark, tmp_path / "big.pcap")


def test_blocks_smaller_than_the_file(spark, tmp_path, monkeypatch):
    records = random_records(200, 8)
    write_capture(tmp_path / "a.pcap", records)
    monkeypatch.setattr(pcap, "BLOCK", 20_000)
    assert read_back(spark, tmp_path / "a.pcap") == expected(records)


def test_capture_range_keeps_a_day_of_slack(spark, tmp_path):
    day = 86_400
    times = [T0, T0 + 2 * day, T0 + 4 * day, T0 + 6 * day]
    write_capture(tmp_path / "a.pcap", [record(t, 0, ipv4_tcp()) for t in times])
    rows = read_pcap(spark, str(tmp_path), begin_us=(T0 + 3 * day) * 10**6, end_us=(T0 + 4 * day) * 10**6)
    assert sorted(r.ts_us // 10**6 - T0 for r in rows.collect()) == [2 * day, 4 * day]


def test_span_of_the_files_themselves(spark, tmp_path):
    day = 86_400
    write_capture(tmp_path / "a.pcap", [record(T0, 7, ipv4_tcp()), record(T0 + 9 * day, 0, ipv4_tcp())])
    write_capture(tmp_path / "b.pcap", [record(T0 + day, 0, ipv4_tcp()), record(T0 + 5 * day, 0, ipv4_tcp())])
    assert pcap.capture_span(spark, str(tmp_path)) == (T0 * 10**6 + 7, (T0 + 6 * day) * 10**6)
    rows = read_pcap(spark, str(tmp_path), auto_range=True).collect()
    assert sorted(r.ts_us // 10**6 - T0 for r in rows) == [0, day, 5 * day]


def test_decode_headers(spark, tmp_path):
    frames = [
        ipv4_tcp(b"GET /a HTTP/1.1\r\n"),
        ipv4_tcp(b"hello", options=bytes(8), sport=5, dport=25),
        ethernet(0x86DD, bytes([0x60, 0, 0, 0, 0, 33]) + bytes(40)),
        ethernet(0x0806, bytes(40)),
        ethernet(0x0800, struct.pack(">BBHHHBBHII", 0x45, 0, 28, 0, 0, 61, 1, 0, 1, 2) + b"\x08\x00" + bytes(6)),
        b"\x00" * 10,
    ]
    write_capture(tmp_path / "a.pcap", [record(T0, i, f) for i, f in enumerate(frames)])
    rows = {r.ts_us % 10: r for r in decode_packets(read_pcap(spark, str(tmp_path))).collect()}
    assert len(rows) == 5  # the ten-byte frame is too short to be a packet
    web, mail, v6, arp, ping = (rows[i] for i in range(5))
    assert (web.proto, web.src_port, web.dst_port, web.ip_len, web.payload_len) == (6, 1234, 80, 57, 17)
    assert bytes(web.payload) == b"GET /a HTTP/1.1\r\n"
    assert (web.tcp_flags, web.window, web.ttl, web.tcp_seq, web.tcp_ack) == (0x18, 512, 61, 7, 9)
    # IP options move the ports and the payload.
    assert (mail.ihl, mail.src_port, mail.dst_port, mail.payload_len) == (28, 5, 25, 5)
    assert bytes(mail.payload) == b"hello"
    # An IPv6 frame is IPv6 by its EtherType, and has no IPv4 fields.
    assert (v6.eth_type, v6.ip_version, v6.ipv6_len, v6.src_addr, v6.proto) == (0x86DD, 6, 33, None, None)
    assert (arp.eth_type, arp.ip_version, arp.ip_len) == (0x0806, None, None)
    assert (ping.proto, ping.icmp_type_code, ping.payload_len) == (1, 0x0800, 0)


def test_write_rolls_by_interval_and_reads_back(spark, tmp_path):
    rows = [(i, (T0 + i * 100) * 1_000_000 + i, 1, 2, 3, 4, 6, 44, 4, "data") for i in range(12)]
    frames = encode_frames(packet_rows(spark, rows))
    out = tmp_path / "out"
    write_pcap(frames, str(out), roll_s=300, files=2)
    names = {p.name.rsplit("-", 1)[0] for p in out.iterdir()}
    assert names == {f"nf-v05.2024-01-01.00{m:02d}" for m in (0, 5, 10, 15)}
    assert [r[0] for r in read_back(spark, out)] == [r[1] for r in rows]
    # Overwriting replaces, appending adds.
    write_pcap(frames.limit(5), str(out), files=1)
    assert len(read_back(spark, out)) == 5
    write_pcap(frames, str(out), mode="append", files=1)
    assert len(read_back(spark, out)) == 17


def test_stream_takes_each_file_once(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    batches = [random_records(30, seed) for seed in (11, 12)]

    def run():
        stream = read_pcap_stream(spark, str(source), split_bytes=4_000, tasks=3)
        (stream.writeStream.format("parquet").option("path", str(out))
         .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination())
        return spark.read.parquet(str(out)).count()

    write_capture(source / "a.pcap", batches[0])
    assert run() == 30
    write_capture(source / "b.pcap", batches[1])
    assert run() == 60


def test_addresses(spark):
    df = spark.createDataFrame([("10.1.2.255",), ("/192.168.0.1",), ("1.2.3",), ("1.2.3.256",), ("a.b.c.d",)], "t string")
    rows = df.select("t", ip_number(F.col("t")).alias("n")).withColumn("back", ip_text(F.col("n"))).collect()
    assert [r.back for r in rows] == ["10.1.2.255", "192.168.0.1", None, None, None]
    assert rows[0].n == parse_ip("10.1.2.255")


def test_filters_do_not_repeat_the_decoding(spark):
    raw = spark.createDataFrame([(0, 60, bytes(60))], "ts_us long, wire_len int, frame binary")
    chosen = decode_packets(raw).where("eth_type = 2048 and proto = 6 and tcp_seq is not null and dst_port = 80")
    plan = chosen._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("conv(") == 5  # the five words


def test_tasks_grow_in_size_before_they_grow_in_number():
    for size in (1 << 20, 1 << 30, 1 << 36):
        tasks = plan_ranges("r", [("f", 0, size, size, True)], 1 << 18)
        pieces = [r for t in tasks for r in t.ranges]
        assert [r[1] for r in pieces] == list(range(0, size, 1 << 18)) and pieces[-1][2] == size
        assert all(r[2] - r[1] <= 1 << 18 for r in pieces) and [r[4] for r in pieces[:2]] == [True, False]
        assert len(tasks) <= max(MANY_TASKS, size // TASK_BYTES) + 1
        assert max(sum(r[2] - r[1] for r in t.ranges) for t in tasks) <= TASK_BYTES
