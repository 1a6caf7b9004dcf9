"""Flow rows out of NetFlow v5 export packets and flow-tools records, and back.

Records are decoded in Arrow blocks by whole arrays: a block's records become
one matrix of bytes, and a field is a slice of its columns.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from flowloom.functions.binary import be_hex, bytes_of, swap32
from flowloom.functions.fields import flow_field
from flowloom.sources.pcap import BLOCK, Segments, file_system, list_files, plan_ranges

# Fixed values: (offset, length) of the fields in a 48-byte flow record.
RECORD = {
    "src_addr": (0, 4), "dst_addr": (4, 4), "nexthop": (8, 4), "input": (12, 2), "output": (14, 2),
    "dpkts": (16, 4), "doctets": (20, 4), "first": (24, 4), "last": (28, 4), "src_port": (32, 2),
    "dst_port": (34, 2), "pad1": (36, 1), "tcp_flags": (37, 1), "prot": (38, 1), "tos": (39, 1),
    "src_as": (40, 2), "dst_as": (42, 2), "src_mask": (44, 1), "dst_mask": (45, 1), "pad2": (46, 2),
}
RECORD_BYTES = 48
# Ethernet + IP + UDP headers, export header, and the flow-tools record.
UDP_HEADERS, EXPORT_HEADER, VERSION = 42, 24, 5
FLOWTOOLS_BYTES, FLOWTOOLS_SHIFT = 64, 16

_LONG = {"src_addr", "dst_addr", "nexthop", "dpkts", "doctets", "first", "last"}


RECORDS_PER_PACKET = 30
_TIMES = ["sys_uptime", "timestamp_us", "first_us", "last_us"]
_PLAIN = [n for n in RECORD if n not in ("first", "last")]


def _kind(name: str) -> pa.DataType:
    return pa.int64() if name in _LONG or name in _TIMES else pa.int32()


def _schema(names: list[str]) -> str:
    return ", ".join(f"{n} {'long' if pa.types.is_int64(_kind(n)) else 'int'}" for n in names)


def _big_endian(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Unsigned integers of ``length`` bytes at the given places of a byte array."""
    value = np.zeros(len(at), np.int64)
    for i in range(length):
        value = value << 8 | data[at + i]
    return value


def _record_fields(data: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    return {name: _big_endian(data, starts + at, length) for name, (at, length) in RECORD.items()}


def _batch(values: dict[str, np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values[n]).cast(_kind(n)) for n in names], names=names)


def _with_derived(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "syn": flow_field("syn").cast("int"), "ack": flow_field("ack").cast("int"),
        "fin": flow_field("fin").cast("int"),
        "src_subnet": flow_field("ssubnet"), "dst_subnet": flow_field("dsubnet"),
        "flows": F.lit(1).cast("bigint"),
    })


def _bytes_of_frames(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of a binary column, and where each value starts and ends."""
    frames = column.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(frames.buffers()[1], np.int64)[frames.offset:frames.offset + len(frames) + 1]
    data = frames.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), bounds[:-1], bounds[1:]


def netflow_v5(raw: DataFrame) -> DataFrame:
    """One row per flow record in the captured export packets.

    All records announced by the header are read, as far as the frame holds them.
    """
    names = ["sys_uptime", "timestamp_us", *_PLAIN, "first_us", "last_us"]

    def decode(batches):
        for batch in batches:
            data, starts, ends = _bytes_of_frames(batch.column("frame"))
            first = starts + UDP_HEADERS
            whole = first + EXPORT_HEADER <= ends
            first, ends = first[whole], ends[whole]
            held = np.minimum(_big_endian(data, first + 2, 2), (ends - first - EXPORT_HEADER) // RECORD_BYTES)
            held[_big_endian(data, first, 2) != VERSION] = 0
            uptime = _big_endian(data, first + 4, 4)
            stamp = _big_endian(data, first + 8, 4) * 1_000_000 + _big_endian(data, first + 12, 4) // 1000
            number = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
            values = _record_fields(data, np.repeat(first + EXPORT_HEADER, held) + number * RECORD_BYTES)
            values |= {"sys_uptime": np.repeat(uptime, held), "timestamp_us": np.repeat(stamp, held)}
            for name in ("first", "last"):  # uptimes in milliseconds
                values[f"{name}_us"] = values["timestamp_us"] - (values["sys_uptime"] - values.pop(name)) * 1000
            yield _batch(values, names)

    return _with_derived(raw.select("frame").mapInArrow(decode, _schema(names)))


_FLOWTOOLS_NAMES = [*_PLAIN, "first_us", "last_us"]


def _flowtools_batch(data: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """Rows of flow-tools records; their times are little-endian seconds."""
    values = _record_fields(data, starts + FLOWTOOLS_SHIFT)
    for name in ("first", "last"):
        at = starts + FLOWTOOLS_SHIFT + RECORD[name][0]
        values[f"{name}_us"] = sum(data[at + i].astype(np.int64) << 8 * i for i in range(4)) * 1_000_000
        values.pop(name)
    return _batch(values, _FLOWTOOLS_NAMES)


def flowtools(raw: DataFrame, column: str = "record") -> DataFrame:
    """Flow rows out of 64-byte flow-tools records; the times are little-endian seconds."""

    def decode(batches):
        for batch in batches:
            data, starts, ends = _bytes_of_frames(batch.column(0))
            yield _flowtools_batch(data, starts[ends - starts == FLOWTOOLS_BYTES])

    return _with_derived(raw.select(column).mapInArrow(decode, _schema(_FLOWTOOLS_NAMES)))


class FlowtoolsReader(DataSourceReader):
    """Byte ranges that end at record boundaries."""

    def __init__(self, path: str, split_bytes: int):
        self.path, self.split_bytes = path, max(FLOWTOOLS_BYTES, split_bytes // FLOWTOOLS_BYTES * FLOWTOOLS_BYTES)

    def partitions(self):
        ranges = [(path, 0, size, size, True) for path, size in list_files(self.path)]
        return plan_ranges(self.path, ranges, self.split_bytes) or [Segments(self.path, ())]

    def read(self, partition):
        fs = file_system(partition.root)[0]
        for path, start, end, *_ in partition.ranges:
            with fs.open_input_file(path) as stream:
                for at in range(start, end, BLOCK):
                    data = np.frombuffer(stream.read_at(min(BLOCK, end - at), at), np.uint8)
                    yield _flowtools_batch(data, np.arange(len(data) // FLOWTOOLS_BYTES) * FLOWTOOLS_BYTES)


class FlowtoolsSource(DataSource):
    """``spark.read.format("flowtools")``: files of 64-byte records; a cut-off last one is left out."""

    @classmethod
    def name(cls):
        return "flowtools"

    def schema(self):
        return _schema(_FLOWTOOLS_NAMES)

    def reader(self, schema):
        return FlowtoolsReader(self.options["path"], int(self.options.get("splitBytes", 128 << 20)))


def read_flowtools(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """Flow rows of files of 64-byte records, split at record boundaries."""
    import flowloom
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(flowloom)
    spark.dataSource.register(FlowtoolsSource)
    reader = spark.read.format("flowtools")
    return _with_derived((reader.option("splitBytes", split_bytes) if split_bytes else reader).load(path))


def write_flowtools(records: DataFrame, path: str) -> None:
    """Writes a column of 64-byte records, ``record``, as one file for each task."""

    def write(batches):
        fs, base = file_system(path)
        fs.create_dir(base, recursive=True)
        name, many = f"{base}/_{uuid.uuid4().hex}", 0  # hidden until it is whole
        with fs.open_output_stream(name) as stream:
            for batch in batches:
                if batch.column("record").null_count:
                    raise ValueError("a flow without an address, a time or a count has no record")
                data, starts, ends = _bytes_of_frames(batch.column("record"))
                if len(starts):
                    stream.write(data[starts[0]:ends[-1]])
                many += batch.num_rows
        yield pa.RecordBatch.from_pydict({"name": [name], "many": [many]})

    # The driver gets a name for each task; those that a failed attempt left stay hidden.
    for row in records.select("record").mapInArrow(write, "name string, many long").collect():
        if row.many:
            fs, base = file_system(path)
            fs.move(row.name, f"{base}/part-{row.name.rsplit('_', 1)[1]}")


def _record_hex(values: dict[str, Column], begin: int = 0, end: int = RECORD_BYTES) -> Column:
    """Hex text of a flow record, or of some bytes of it, eight bytes at a time; fields without a value are zero."""
    words = []
    for start in range(begin, end, 8):
        word_value = F.lit(0).cast("bigint")
        for name, (at, length) in RECORD.items():
            if start <= at < start + 8 and name in values:
                moved = F.shiftleft(values[name].cast("bigint"), 64 - 8 * (at - start + length))
                word_value = word_value.bitwiseOR(moved)
        words.append(be_hex(word_value, 8))
    return F.concat(*words)


def encode_flowtools(flows: DataFrame) -> DataFrame:
    """64-byte records out of flow rows (whole seconds)."""
    def seconds(column: str) -> Column:
        """Seconds with their four bytes swapped, as the format has them."""
        return swap32((F.col(column if column in flows.columns else "first_us") / 1_000_000).cast("bigint"))

    values = {n: F.col(n) for n in RECORD if n in flows.columns}
    record = _record_hex(values | {"first": seconds("first_us"), "last": seconds("last_us")})
    return flows.select(bytes_of(F.lit("00" * FLOWTOOLS_SHIFT), record).alias("record"))


def encode_netflow_v5(flows: DataFrame, group: list[str], port: int = 5001) -> DataFrame:
    """Export packets (ts_us, wire_len, frame) of at most 30 flows each, of one group each.

    The caller's ``group`` columns keep the start times of a packet's flows within
    the range of a 32-bit millisecond uptime.
    """
    end = "last_us" if "last_us" in flows.columns else "first_us"
    place = F.row_number().over(Window.partitionBy(*group).orderBy("first_us")) - 1
    # All of a record but its times, which depend on its packet, is encoded flow by flow, as what is done to the
    # elements of a list is not compiled.
    fields, times = {n: F.col(n) for n in RECORD if n in flows.columns}, RECORD["first"][0]
    numbered = flows.withColumns({
        "packet_no": F.floor(place / RECORDS_PER_PACKET), "head": _record_hex(fields, 0, times),
        "tail": _record_hex(fields, times + 8, RECORD_BYTES)})
    spans = numbered.groupBy(*group, "packet_no").agg(
        F.max(end).alias("latest"), F.min("first_us").alias("earliest"),
        F.collect_list(F.struct("head", F.col("first_us").alias("first"), F.col(end).alias("last"), "tail")).alias("rows"))
    export_s = F.floor(F.col("latest") / 1_000_000) + 1
    packet = spans.withColumn("export_us", export_s * 1_000_000).withColumn(
        "uptime", F.floor((F.col("export_us") - F.col("earliest")) / 1000) + 1)

    def one(row: Column) -> Column:
        ticks = {c: F.col("uptime") - F.floor((F.col("export_us") - row[c]) / 1000) for c in ("first", "last")}
        return F.concat(row["head"], _record_hex(ticks, times, times + 8), row["tail"])

    body = F.array_join(F.transform("rows", one), "")
    size = F.size("rows") * RECORD_BYTES + EXPORT_HEADER
    frame = bytes_of(
        F.lit("00" * 12 + "0800" + "4500"), be_hex(size + 28, 2), F.lit("000000004011" + "00" * 10),
        be_hex(F.lit(port), 2), be_hex(F.lit(port), 2), be_hex(size + 8, 2), F.lit("0000"),
        be_hex(F.lit(VERSION), 2), be_hex(F.size("rows"), 2), be_hex(F.col("uptime"), 4),
        be_hex(F.col("export_us") / 1_000_000, 4), F.lit("00" * 12), body)
    return packet.select(F.col("export_us").alias("ts_us"), frame.alias("frame")).withColumn(
        "wire_len", F.length("frame"))
