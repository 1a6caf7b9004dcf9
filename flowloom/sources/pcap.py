"""Capture files as a Spark data source, read in splits and written in parts.

A file is cut into byte ranges; a record belongs to the range in which it
starts.  Small ranges share a task.  The framing below is the only per-record
Python in the library: it walks the record headers, and everything else about a
block is done on whole arrays.
"""

from __future__ import annotations

import struct
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition,
    LessThan, LessThanOrEqual, WriterCommitMessage,
)

from flowloom.functions.net import date_label

# File header (little-endian, microseconds, Ethernet), where it holds the
# snapshot length, header sizes, the snapshot length of captures that state none, the
# longest one taken at its word, and how far after the last file's first packet a
# capture may go on.
FILE_HEADER = bytes.fromhex("d4c3b2a1020004000000000000000000ffff000001000000")
MAGIC = FILE_HEADER[:4]
SNAP_AT = 16
RECORD_HEADER = 16
MAX_PACKET = 262_144
LONGEST_SNAP = 16 << 20
SPAN_S = 432_000
FILE_PREFIX = "nf-v05."

SCHEMA = "ts_us long, cap_len int, wire_len int, frame binary, file string, pkt_id long"
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
BLOCK = 8 << 20
MANY_TASKS, TASK_BYTES = 256, 128 << 20


@dataclass
class Segments(InputPartition):
    """Byte ranges (path, start, end, file size, whether a record is known to start there) of the file system of
    ``root``, read by one task."""

    root: str
    ranges: tuple[tuple[str, int, int, int, bool], ...]


def file_system(path: str):
    """File system and path below it, for a local path or a URI."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), unquote("/" + path.removeprefix("file:").lstrip("/"))
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def list_files(path: str):
    """(path, size) of the files at or below a path, hidden ones left out."""
    fs, base = file_system(path)
    info = fs.get_file_info(base)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    infos = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(base, recursive=True))
    depth = len(base.rstrip("/"))
    return sorted(
        (i.path, i.size) for i in infos
        if i.is_file and not any(p.startswith(("_", ".")) for p in i.path[depth:].split("/"))
    )


def plan_ranges(root: str, ranges, split_bytes: int) -> list[Segments]:
    """Tasks over ranges (path, start, end, file size, known); ranges longer than ``split_bytes`` are cut, and only
    a range's first piece starts at a known record. A task has about ``split_bytes``; where that makes more than
    ``MANY_TASKS``, a task takes several pieces, up to ``TASK_BYTES``."""
    tasks, current, filled, ranges = [], [], 0, list(ranges)
    full = max(split_bytes, min(TASK_BYTES, sum(last - first for _, first, last, *_ in ranges) // MANY_TASKS))
    for path, first, last, size, known in ranges:
        for start in range(first, last, split_bytes):
            end = min(start + split_bytes, last)
            if current and filled + end - start > full:
                tasks.append(Segments(root, tuple(current)))
                current, filled = [], 0
            current.append((path, start, end, size, known and start == first))
            filled += end - start
    if current:
        tasks.append(Segments(root, tuple(current)))
    return tasks


class Framing:
    """Finds the records of one byte range of a capture file.

    A record is told by its structure alone: as many bytes stored as were on the
    wire or fewer, no more than the capture's snapshot length, and a place inside
    the file. Clocks may jump or run wrong.
    """

    def __init__(self, stream, size: int, header: bool, max_packet: int):
        self.stream, self.size, self.max_packet = stream, size, max_packet
        self.first = len(FILE_HEADER) if header else 0
        if header and size:
            head = stream.read_at(len(FILE_HEADER), 0)
            if head[:4] != MAGIC:
                raise ValueError("not a little-endian microsecond capture file")
            snap = struct.unpack_from("<I", head, SNAP_AT)[0] if len(head) == len(FILE_HEADER) else 0
            if snap <= LONGEST_SNAP:
                self.max_packet = max(max_packet, snap)

    def plausible(self, data: bytes, at: int) -> bool:
        _, usec, cap, wire = struct.unpack_from("<IIII", data, at)
        return cap <= wire and cap <= self.max_packet and 0 < wire <= LONGEST_SNAP and usec < 1_000_000

    def synchronise(self, start: int) -> int:
        """First record boundary at or after ``start``.

        The search begins far enough before ``start`` that a chain of headers
        faked inside one packet's payload has ended by then, and it accepts only
        a chain that stays plausible for longer than any single packet.
        """
        if start <= self.first:
            return self.first
        reach = 4 * (self.max_packet + RECORD_HEADER)
        base = max(self.first, start - reach)
        data = self.stream.read_at(min(start + reach, self.size) - base, base)
        need = 2 * (self.max_packet + RECORD_HEADER)
        for candidate in range(len(data) - RECORD_HEADER + 1):
            at, boundary = candidate, None
            while True:
                if boundary is None and base + at >= start:
                    boundary = base + at
                if base + at >= self.size:  # the chain ends with the file
                    return self.size if boundary is None else boundary
                if boundary is not None and at - candidate >= need:
                    return boundary
                if at + RECORD_HEADER > len(data):
                    if base + len(data) >= self.size and boundary is not None:
                        return boundary  # only a cut-off last record remains
                    break
                if not self.plausible(data, at):
                    break
                at += RECORD_HEADER + struct.unpack_from("<I", data, at + 8)[0]
            if base == self.first and candidate == 0 and boundary is not None:
                return boundary  # walked from the first record, so it is exact
        return self.next_plausible(start)  # a long damaged stretch

    def batches(self, start: int, end: int, known: bool = False):
        """(block offset, block bytes, record starts) of all records that start in the range, which a record
        is ``known`` to begin or not."""
        unpack = struct.unpack_from
        position = start if known else self.synchronise(start)
        block = max(BLOCK, self.max_packet + RECORD_HEADER)
        while position < min(end, self.size):
            data = self.stream.read_at(min(block, self.size - position), position)
            at, starts, broken = 0, [], False
            stop = min(end - position, len(data) - RECORD_HEADER + 1)
            held, largest = len(data), self.max_packet
            while at < stop:  # the test of ``plausible``, written out: this is the hot loop
                _, usec, cap, wire = unpack("<IIII", data, at)
                if cap > wire or cap > largest or not 0 < wire <= LONGEST_SNAP or usec >= 1_000_000:
                    broken = True
                    break
                follow = at + RECORD_HEADER + cap
                if follow > held:
                    break
                starts.append(at)
                at = follow
            if starts:
                yield position, data[:at], np.array(starts, dtype=np.int64)
            if broken:  # damaged bytes: go on at the next plausible record
                position = self.next_plausible(position + at + 1)
            elif not starts and len(data) == self.size - position:
                return  # a cut-off last record
            else:
                position += at

    def next_plausible(self, position: int) -> int:
        """Next offset with two plausible headers in a row, or one that ends the file."""
        while position + RECORD_HEADER <= self.size:
            data = self.stream.read_at(min(BLOCK, self.size - position), position)
            limit = len(data) - RECORD_HEADER + 1
            for at in range(limit):
                if not self.plausible(data, at):
                    continue
                follow = position + at + RECORD_HEADER + struct.unpack_from("<I", data, at + 8)[0]
                if follow == self.size:
                    return position + at
                next_header = self.stream.read_at(RECORD_HEADER, follow) if follow < self.size else b""
                if len(next_header) == RECORD_HEADER and self.plausible(next_header, 0):
                    return position + at
            position += limit
        return self.size


@dataclass(frozen=True)
class Wanted:
    """What is wanted of the packets: a range of times, and how many bytes of each frame (all)."""

    begin_us: int | None = None
    end_us: int | None = None
    frame_bytes: int | None = None


def to_batch(path: str, offset: int, data: bytes, starts: np.ndarray, wanted: Wanted = Wanted()) -> pa.RecordBatch:
    """Arrow rows of a run of neighbouring records, of those that are wanted."""
    raw = np.frombuffer(data, dtype=np.uint8)
    fields = raw[starts[:, None] + np.arange(RECORD_HEADER)].view("<u4").astype(np.int64)
    times, stored = fields[:, 0] * 1_000_000 + fields[:, 1], fields[:, 2]
    # Headers, wanted bytes and the rest of frames alternate; as one binary array every third value is wanted.
    kept = stored if wanted.frame_bytes is None else np.minimum(stored, wanted.frame_bytes)
    bounds = np.empty(3 * len(starts) + 1, dtype=np.int32)
    bounds[:-1:3], bounds[1::3], bounds[-1] = starts, starts + RECORD_HEADER, len(data)
    bounds[2::3] = starts + RECORD_HEADER + kept
    pieces = pa.Array.from_buffers(
        pa.binary(), 3 * len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    rows = np.ones(len(starts), dtype=bool)
    if wanted.begin_us is not None:
        rows &= times >= wanted.begin_us
    if wanted.end_us is not None:
        rows &= times <= wanted.end_us
    rows = np.flatnonzero(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(times[rows]), pa.array(stored[rows].astype(np.int32)),
         pa.array(fields[rows, 3].astype(np.int32)), pieces.take(pa.array(3 * rows + 1)),
         pa.repeat(path, len(rows)), pa.array(offset + starts[rows])],
        names=["ts_us", "cap_len", "wire_len", "frame", "file", "pkt_id"])


def to_records(batch: pa.RecordBatch) -> bytes:
    """Capture records of Arrow rows, the reverse of ``to_batch``."""
    frames = batch["frame"].cast(pa.binary())
    bounds = np.frombuffer(frames.buffers()[1], dtype=np.int32)[frames.offset:frames.offset + len(frames) + 1]
    stored = np.diff(bounds).astype(np.int64)
    ts = batch["ts_us"].to_numpy()
    fields = np.column_stack([ts // 1_000_000, ts % 1_000_000, stored, batch["wire_len"].to_numpy()])
    starts = np.cumsum(stored + RECORD_HEADER) - (stored + RECORD_HEADER)
    header_at = starts[:, None] + np.arange(RECORD_HEADER)
    out = np.empty(int((stored + RECORD_HEADER).sum()), dtype=np.uint8)
    rest = np.ones(len(out), dtype=bool)
    rest[header_at.ravel()] = False
    out[header_at] = fields.astype("<u4").view(np.uint8).reshape(-1, RECORD_HEADER)
    if rest.any():
        out[rest] = np.frombuffer(frames.buffers()[2], dtype=np.uint8)[bounds[0]:bounds[-1]]
    return out.tobytes()


def read_ranges(root: str, ranges, header: bool, max_packet: int, wanted: Wanted = Wanted()):
    """Arrow batches of the packets in some byte ranges."""
    fs = file_system(root)[0]
    for path, start, end, size, known in ranges:
        with fs.open_input_file(path) as stream:
            framing = Framing(stream, size, header, max_packet)
            for offset, data, starts in framing.batches(start, end, known):
                yield to_batch(path, offset, data, starts, wanted)


class _Options:
    def __init__(self, options: dict):
        self.path = options.get("path")
        if not self.path:
            raise ValueError("the pcap source needs a path")
        self.header = str(options.get("header", "true")).lower() == "true"
        self.split_bytes = int(options.get("splitBytes", 128 << 20))
        self.max_packet = int(options.get("maxPacket", MAX_PACKET))

        def number(name):
            return None if options.get(name) is None else int(options[name])
        self.wanted = Wanted(number("beginUs"), number("endUs"), number("frameBytes"))
        self.index = options.get("index")
        self.unindexed = str(options.get("unindexed", "false")).lower() == "true"


class PcapReader(DataSourceReader):
    """Reads byte ranges; comparisons of ``ts_us`` with a value are applied before frames are copied."""

    def __init__(self, options: _Options):
        self.options = options

    def pushFilters(self, filters):
        low, high = [self.options.wanted.begin_us], [self.options.wanted.end_us]
        for test in filters:
            if getattr(test, "attribute", None) == ("ts_us",) and isinstance(getattr(test, "value", None), int):
                if isinstance(test, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    low.append(test.value)
                if isinstance(test, (EqualTo, LessThan, LessThanOrEqual)):
                    high.append(test.value)
            yield test  # Spark tests again, so bounds need not be exact
        self.options.wanted = replace(
            self.options.wanted, begin_us=max((v for v in low if v is not None), default=None),
            end_us=min((v for v in high if v is not None), default=None))

    def partitions(self):
        o = self.options
        files = list_files(o.path)
        ranges = [(path, 0, size, size, False) for path, size in files]
        if o.index:
            from flowloom.sources.capture_index import chosen_ranges

            ranges = chosen_ranges(o.index, files, None if o.unindexed else o.wanted)
        return plan_ranges(o.path, ranges, o.split_bytes) or [Segments(o.path, ())]

    def read(self, partition):
        o = self.options
        return read_ranges(partition.root, partition.ranges, o.header, o.max_packet, o.wanted)


@dataclass
class Written(WriterCommitMessage):
    files: tuple[tuple[str, str], ...]


class PcapWriter(DataSourceArrowWriter):
    """One file per time interval and task, moved into place when the job commits."""

    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"]
        self.overwrite = overwrite
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator):
        from pyspark import TaskContext

        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        fs, base = file_system(self.path)
        fs.create_dir(f"{base}/{self.staging}", recursive=True)
        files, stream, current = [], None, None
        try:
            for batch in iterator:
                runs = pc.run_end_encode(batch["stamp"])
                begin = 0
                # Rows come sorted by time, so an interval opens one file per task.
                for end, stamp in zip(runs.run_ends.to_pylist(), runs.values.to_pylist()):
                    if stamp != current:
                        if stream is not None:
                            stream.close()
                        current, name = stamp, f"{FILE_PREFIX}{stamp}-{part:05d}"
                        staged = f"{base}/{self.staging}/{name}-{attempt}"
                        stream = fs.open_output_stream(staged)
                        stream.write(FILE_HEADER)
                        files.append((staged, f"{base}/{name}"))
                    stream.write(to_records(batch.slice(begin, end - begin)))
                    begin = end
        finally:
            if stream is not None:
                stream.close()
        return Written(tuple(files))

    def commit(self, messages):
        fs, base = file_system(self.path)
        fs.create_dir(base, recursive=True)
        old = {i.path for i in fs.get_file_info(pafs.FileSelector(base))
               if i.is_file and i.base_name.startswith(FILE_PREFIX)}
        # New files carry the job's own mark, so they are all in place before an old one goes.
        written = [(staged, f"{final}.{self.staging[-8:]}") for m in messages if m for staged, final in m.files]
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda pair: fs.move(*pair), written))
            if self.overwrite:
                list(pool.map(fs.delete_file, old))
        self._drop_staging(fs, base)

    def abort(self, messages):
        self._drop_staging(*file_system(self.path))

    def _drop_staging(self, fs, base):
        if fs.get_file_info(f"{base}/{self.staging}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{base}/{self.staging}")


class PcapSource(DataSource):
    """``spark.read.format("pcap")`` and ``df.write.format("pcap")``."""

    @classmethod
    def name(cls):
        return "pcap"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return PcapReader(_Options(self.options))

    def writer(self, schema, overwrite):
        return PcapWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Makes the ``pcap`` format known; workers get the classes with the tasks."""
    import flowloom
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(flowloom)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PcapSource)


def capture_span(spark: SparkSession, path: str, header: bool = True) -> tuple[int, int]:
    """Earliest first packet of the files, and latest first packet plus five days, in microseconds.

    Sixteen bytes of each file are read, in parallel; two numbers come back.
    """
    register(spark)
    skip = len(FILE_HEADER) if header else 0

    def first_packets(batches):
        for batch in batches:
            times = []
            for row in batch.to_pylist():
                with file_system(path)[0].open_input_file(row["path"]) as stream:
                    times.append(struct.unpack("<II", stream.read_at(8, skip)))
            yield pa.RecordBatch.from_arrays([pa.array([s * 1_000_000 + u for s, u in times], pa.int64())], ["ts_us"])

    files = [(p,) for p, size in list_files(path) if size >= skip + RECORD_HEADER]
    if not files:
        raise ValueError(f"no packets below {path}")
    named = spark.createDataFrame(files, "path string").repartition(min(len(files), 1000))
    first, last = named.mapInArrow(first_packets, "ts_us long").agg(F.min("ts_us"), F.max("ts_us")).first()
    return first, last + SPAN_S * 1_000_000


def read_pcap(spark: SparkSession, path: str, header: bool = True, split_bytes: int | None = None,
              begin_us: int | None = None, end_us: int | None = None, auto_range: bool = False,
              max_packet: int = MAX_PACKET, frame_bytes: int | None = None, index: str | None = None) -> DataFrame:
    """Packets of a capture file or directory: time, lengths, frame, and place in the file.

    ``begin_us`` and ``end_us`` restrict the capture time, with one day of slack;
    ``auto_range`` takes the span of the files themselves, without slack. The
    reader applies them, and any other comparison of ``ts_us``, before it copies
    frames. ``frame_bytes`` keeps that many bytes of each frame, which is enough
    for headers. ``index`` names a time index (``capture_index``): files and parts of files
    that it tells to be out of the range are not opened. Records longer than the file's snapshot length and than
    ``max_packet`` count as damage; ``capture_coverage`` tells of damage.
    """
    register(spark)
    if auto_range:
        begin, end = capture_span(spark, path, header)
        packets = read_pcap(spark, path, header, split_bytes, max_packet=max_packet, frame_bytes=frame_bytes, index=index)
        return packets.where(F.col("ts_us").between(begin, end))
    reader = spark.read.format("pcap").option("header", str(header).lower()).option("maxPacket", max_packet)
    if split_bytes:
        reader = reader.option("splitBytes", split_bytes)
    if frame_bytes is not None:
        reader = reader.option("frameBytes", frame_bytes)
    if index is not None:
        reader = reader.option("index", index)
    day = 86_400_000_000
    packets = reader.load(path)
    if begin_us is not None:
        packets = packets.where(F.col("ts_us") >= begin_us - day)
    if end_us is not None:
        packets = packets.where(F.col("ts_us") <= end_us + day)
    return packets


def capture_coverage(spark: SparkSession, path: str, header: bool = True, split_bytes: int | None = None,
                     max_packet: int = MAX_PACKET) -> DataFrame:
    """(file, bytes, records, skipped): size and records of each file, and bytes that belong to no record."""
    packets = read_pcap(spark, path, header, split_bytes, max_packet=max_packet, frame_bytes=0)
    read = packets.groupBy("file").agg(
        F.count("*").alias("records"), F.sum(F.col("cap_len") + RECORD_HEADER).alias("in_records"))
    files = spark.createDataFrame([(p, size) for p, size in list_files(path)], "file string, bytes long")
    first = F.lit(len(FILE_HEADER) if header else 0)
    return files.join(read, "file", "left").select(
        "file", "bytes", F.coalesce("records", F.lit(0)).alias("records"),
        F.greatest(F.col("bytes") - first - F.coalesce("in_records", F.lit(0)), F.lit(0)).alias("skipped"))


def read_pcap_stream(spark: SparkSession, path: str, header: bool = True, split_bytes: int = 128 << 20,
                     max_packet: int = MAX_PACKET, tasks: int | None = None) -> DataFrame:
    """A stream of the packets of every capture file that appears in a directory.

    Spark's file source keeps the log of files taken, so each is read exactly
    once; its content is never loaded, only its path and length.  The files are
    then cut into ranges, which are spread over ``tasks`` tasks.  Capture files
    must appear complete, as those moved into place do.
    """
    import flowloom
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(flowloom)

    def packets_of(batches):
        for batch in batches:
            for row in batch.to_pylist():
                relative = file_system(row["path"])[1]
                ranges = [(relative, row["start"], min(row["start"] + split_bytes, row["length"]), row["length"], False)]
                yield from read_ranges(row["path"], ranges, header, max_packet)

    files = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).load(path).select("path", "length")
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes))
    ranges = files.select("path", "length", F.explode(starts).alias("start"))
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(tasks, "path", "start").mapInArrow(packets_of, SCHEMA)


def write_pcap(packets: DataFrame, path: str, roll_s: int = 300, mode: str = "overwrite",
               files: int | None = None) -> None:
    """Writes (ts_us, wire_len, frame) rows as capture files rolled every ``roll_s`` seconds.

    Rows are range-partitioned by time, so a busy interval becomes several
    files of that interval instead of one task's burden.
    """
    register(packets.sparkSession)
    stamp = date_label(F.col("ts_us") - F.pmod("ts_us", F.lit(roll_s * 1_000_000)), "yyyy-MM-dd.HHmm")
    rows = packets.select("ts_us", "wire_len", "frame").withColumn("stamp", stamp)
    order = ["ts_us", F.xxhash64("frame")]
    spread = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    (spread.sortWithinPartitions("ts_us").write.format("pcap").mode(mode).option("path", path).save())
