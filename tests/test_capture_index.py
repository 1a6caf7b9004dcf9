"""Ranges of captures by their time index, against reads of everything."""

import os
import random

import pytest

from flowloom.sources.capture_index import build_index, chosen_ranges, index_of, read_index, read_range
from flowloom.sources.pcap import FILE_HEADER, Wanted, list_files, plan_ranges, read_pcap, write_pcap

DAY = 86_400_000_000


def record(ts_us, frame):
    head = b"".join(v.to_bytes(4, "little") for v in (ts_us // 1_000_000, ts_us % 1_000_000, len(frame), len(frame)))
    return head + frame


def write(path, packets):
    with open(path, "wb") as file:
        file.write(FILE_HEADER + b"".join(record(*p) for p in packets))


@pytest.fixture()
def captures(tmp_path):
    """A hundred files of ten days each, packets out of order, of sizes that zones cut at any byte."""
    rng = random.Random(4)
    folder = tmp_path / "captures"
    os.mkdir(folder)
    for i in range(100):
        times = [(10 * i + rng.random() * 10) * DAY for _ in range(rng.randint(20, 60))]
        write(folder / f"c{i:03d}", [(int(t), rng.randbytes(rng.randint(60, 900))) for t in times])
    return str(folder)


def rows(df):
    return sorted((r.ts_us, r.cap_len, bytes(r.frame), r.file, r.pkt_id) for r in df.collect())


@pytest.mark.parametrize("zone_bytes, split_bytes", [(4000, None), (1, 3000), (1 << 20, 700)])
def test_same_rows_out_of_fewer_files(spark, captures, tmp_path, zone_bytes, split_bytes):
    index = build_index(spark, captures, str(tmp_path / "index"), zone_bytes=zone_bytes, split_bytes=5000)
    files = list_files(captures)
    for begin, end in ((205, 207), (333.5, 352.1), (-5, 20), (990, 2000), (5000, 6000)):
        begin_us, end_us = int(begin * DAY) + DAY, int(end * DAY) - DAY
        got = read_range(spark, captures, begin_us, end_us, index, split_bytes=split_bytes)
        assert rows(got) == rows(read_pcap(spark, captures, begin_us=begin_us, end_us=end_us))
        opened = {r[0] for r in chosen_ranges(index, files, Wanted(begin_us - DAY, end_us + DAY))}
        assert len(opened) <= (end - begin) / 10 + 2 and {r.file for r in got.collect()} <= opened


def test_zones_are_pruned_and_start_at_records(spark, tmp_path):
    folder = tmp_path / "one"
    os.mkdir(folder)
    write(folder / "a", [(i * 1_000_000, b"x" * 100) for i in range(1000)])
    index = build_index(spark, str(folder), zone_bytes=1160)
    assert index == index_of(str(folder))
    ((path, start, end, size, known),) = chosen_ranges(index, list_files(str(folder)), Wanted(500_000_000, 509_000_000))
    assert known and (start - 24) % 116 == 0 and (end - 24) % 116 == 0 and end - start <= 3 * 1160
    tasks = plan_ranges(str(folder), [(path, start, end, size, known)], 500)
    assert [r[4] for t in tasks for r in t.ranges] == [True] + [False] * (len(tasks) - 1)


def test_grown_and_new_files_are_read_until_they_are_indexed(spark, captures, tmp_path):
    index = build_index(spark, captures, str(tmp_path / "index"))
    before = read_index(spark, index).count()
    with open(f"{captures}/c000", "ab") as file:
        file.write(record(2000 * DAY, b"late" * 20))
    write(f"{captures}/new", [(2001 * DAY, b"new" * 30)])
    files = list_files(captures)
    whole = [r for r in chosen_ranges(index, files, Wanted(1999 * DAY, None)) if not r[4]]
    assert [os.path.basename(r[0]) for r in whole] == ["c000", "new"]
    got = rows(read_range(spark, captures, 2000 * DAY, 2001 * DAY, index))
    assert len(got) == 2 and got == rows(read_pcap(spark, captures, begin_us=2000 * DAY, end_us=2001 * DAY))
    assert build_index(spark, captures, index) == index
    assert read_index(spark, index).count() == before + 2
    assert all(r[4] for r in chosen_ranges(index, files, Wanted(1999 * DAY, None)))
    assert rows(read_range(spark, captures, 2000 * DAY, 2001 * DAY, index)) == got
    build_index(spark, captures, index)
    assert read_index(spark, index).count() == before + 2


def test_files_without_packets(spark, tmp_path):
    folder = tmp_path / "none"
    os.mkdir(folder)
    write(folder / "empty", [])
    (folder / "nothing").write_bytes(b"")
    index = build_index(spark, str(folder))
    assert [(r.records, r.min_us) for r in read_index(spark, index).collect()] == [(0, None)] * 2
    assert read_range(spark, str(folder), 0, DAY, index).collect() == []


def test_index_beside_written_captures(spark, tmp_path):
    frames = spark.range(3000).selectExpr("1700000000000000 + id * 100000 AS ts_us", "60 AS wire_len", "cast(rpad(id, 60, 'x') as binary) AS frame")
    path = str(tmp_path / "written")
    write_pcap(frames, path, roll_s=10)
    build_index(spark, path)
    begin, end = 1700000100000000, 1700000120000000
    got = read_range(spark, path, begin + DAY, end - DAY)
    assert sorted(r.ts_us for r in got.collect()) == list(range(begin, end + 1, 100_000))
    assert len({r.file for r in got.collect()}) <= 4
