"""A time index of capture files: which bytes hold packets of which times.

One scan of record headers writes a row per zone of a file: where its first record
starts, where its last one ends, and the earliest and latest packet between. A read with
a range of times then opens only the zones that can hold such packets, and starts at
known records, without a search for them. Packets need not be in order of time.

An index is a folder of Parquet files beside the captures or elsewhere. It is extended by
what is new: a file counts as indexed if it has rows of its present size, so a file that
grew or is missing is read as a whole until ``build_index`` has run again. A file that was
written anew with other packets and the same size is not noticed.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowloom.sources.pcap import MAX_PACKET, RECORD_HEADER, Wanted, file_system, list_files, read_pcap, register

ZONE_BYTES = 32 << 20
INDEX_FOLDER = "_time_index"
SCHEMA = pa.schema([("file", pa.string()), ("size", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                    ("min_us", pa.int64()), ("max_us", pa.int64()), ("records", pa.int64())])


def index_of(path: str) -> str:
    """Where the index of a folder of captures is kept, unless told otherwise."""
    return f"{path.rstrip('/')}/{INDEX_FOLDER}"


def _rows(index: str, columns: list[str], condition=None) -> pa.Table:
    fs, base = file_system(index)
    if fs.get_file_info(base).type != pafs.FileType.Directory:
        return SCHEMA.empty_table().select(columns)
    return ds.dataset(base, schema=SCHEMA, format="parquet", filesystem=fs).to_table(columns, filter=condition)


def chosen_ranges(index: str, files: list[tuple[str, int]], wanted: Wanted | None) -> list[tuple[str, int, int, int, bool]]:
    """Ranges (path, start, end, file size, whether a record is known to start there) that can hold wanted packets.

    Of ``files`` (path, size), those that the index doesn't have are taken whole. Without ``wanted`` only
    those are given. The index is read by time, and neighbouring zones become one range.
    """
    known = _rows(index, ["file", "size"])
    known = set(zip(known.column("file").to_pylist(), known.column("size").to_pylist()))
    if wanted is None:
        return [(path, 0, size, size, False) for path, size in files if (path, size) not in known]
    condition = ds.field("records") > 0
    if wanted.begin_us is not None:
        condition &= ds.field("max_us") >= wanted.begin_us
    if wanted.end_us is not None:
        condition &= ds.field("min_us") <= wanted.end_us
    zones = defaultdict(list)
    found = _rows(index, ["file", "size", "start", "end"], condition)
    for path, size, start, end in zip(*[found.column(c).to_pylist() for c in found.schema.names]):
        zones[path, size].append((start, end))
    out = []
    for path, size in files:
        if (path, size) not in known:
            out.append((path, 0, size, size, False))
            continue
        begin = end = None
        for start, stop in sorted(zones[path, size]):
            if end != start:
                if begin is not None:
                    out.append((path, begin, end, size, True))
                begin = start
            end = stop
        if begin is not None:
            out.append((path, begin, end, size, True))
    return out


def build_index(spark: SparkSession, path: str, index: str | None = None, header: bool = True,
                zone_bytes: int = ZONE_BYTES, split_bytes: int | None = None, max_packet: int = MAX_PACKET) -> str:
    """Indexes the captures at or below ``path`` that the index doesn't have yet; returns where the index is.

    One scan of the new files, of which no frames are copied, and one aggregation per zone.
    """
    index = index or index_of(path)
    files = [(name, size) for name, _, _, size, _ in chosen_ranges(index, list_files(path), None)]
    if not files:
        return index
    register(spark)
    reader = spark.read.format("pcap").option("header", str(header).lower()).option("maxPacket", max_packet)
    reader = reader.option("index", index).option("unindexed", "true").option("frameBytes", 0)
    packets = (reader.option("splitBytes", split_bytes) if split_bytes else reader).load(path)
    sizes = spark.createDataFrame(files, "file string, size long")
    last = F.col("pkt_id") + RECORD_HEADER + F.col("cap_len")
    zones = packets.groupBy("file", F.floor(F.col("pkt_id") / zone_bytes).alias("zone")).agg(
        F.min("pkt_id").alias("start"), F.max(last).alias("end"), F.min("ts_us").alias("min_us"),
        F.max("ts_us").alias("max_us"), F.count("*").alias("records"))
    # A file without a record is known too: one row that matches no time.
    rows = sizes.join(zones, "file", "left").select(
        "file", "size", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("start", "end")], "min_us", "max_us",
        F.coalesce("records", F.lit(0)).alias("records"))
    rows.sort("min_us").write.mode("append").parquet(index)
    return index


def read_index(spark: SparkSession, index: str) -> DataFrame:
    """The zones (file, size, start, end, min_us, max_us, records) of an index, those of earlier sizes included."""
    return spark.read.parquet(index)


def read_range(spark: SparkSession, path: str, begin_us: int, end_us: int, index: str | None = None, **options) -> DataFrame:
    """Packets between two times (and a day around them), by the index of their folder."""
    return read_pcap(spark, path, begin_us=begin_us, end_us=end_us, index=index or index_of(path), **options)
