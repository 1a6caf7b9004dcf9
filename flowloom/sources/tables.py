"""Dated tables: definitions, and loads of one partition at a time."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from flowloom.functions.net import ip_text
from flowloom.operators.flows import FAN_OUT, fan_out
from flowloom.plans.lineage import as_table
from flowloom.session import settings

_SUMS = "octets BIGINT, pkts BIGINT, flows BIGINT"
_DAY = ("area", "month", "ds")
_LOAD = ("area", "ds", "ts")
BUCKETS = 32
REPORT_ROWS = "report_rows"
REPORT_PARTS = ("area", "month", "ds", "ts", "type")

# Columns, partition columns, and bucket and sort columns of each table.
TABLES = {
    "flowstats": (f"type STRING, aggrKey STRING, {_SUMS}", _LOAD, ("type",), ("aggrKey",)),
    "totalvolume": (f"ts STRING, {_SUMS}", _DAY, ("ts",), ()),
    "totalprotocol": (f"ts STRING, protocol STRING, {_SUMS}", _DAY, ("ts",), ("protocol",)),
    "asegress": (f"ts STRING, asn STRING, {_SUMS}", _DAY, ("ts",), ("asn",)),
    "asingress": (f"ts STRING, asn STRING, {_SUMS}", _DAY, ("ts",), ("asn",)),
    "subnetegress": (f"ts STRING, subnet STRING, {_SUMS}", _DAY, ("ts",), ("subnet",)),
    "subnetingress": (f"ts STRING, subnet STRING, {_SUMS}", _DAY, ("ts",), ("subnet",)),
    "portegress": (f"ts STRING, port STRING, {_SUMS}", _DAY, ("ts",), ("port",)),
    "portingress": (f"ts STRING, port STRING, {_SUMS}", _DAY, ("ts",), ("port",)),
    "daily_flows": (
        "sys_uptime BIGINT, time_stamp BIGINT, srcaddr STRING, dstaddr STRING, nexthop STRING, "
        "input INT, output INT, dpkts BIGINT, doctets BIGINT, first_time DOUBLE, last_time DOUBLE, "
        "srcport INT, dstport INT, pad1 INT, tcp_flags INT, prot INT, tos INT, src_as INT, dst_as INT, "
        "src_mask INT, dst_mask INT, pad2 INT, orderby STRING", _LOAD, (), ()),
    "address_registry": ("organ STRING, asn STRING, prefix STRING", ("area",), (), ()),
    "spoofs": ("srcaddr STRING, dstaddr STRING, ts STRING", _DAY, (), ()),
    "scan": ("srcaddr STRING, dstaddr STRING, cnt INT, ts STRING", _DAY, (), ()),
    "activeIP": ("ipaddr STRING, ts STRING", _DAY, (), ()),
    "activeIPCnt": ("ds STRING, cnt INT", ("area", "month"), (), ()),
    "activeSubnet": ("ipaddr STRING", _DAY, (), ()),
    "heavyUser": ("ipaddr STRING, volume BIGINT, ts STRING", _DAY, (), ()),
    "httplog": (
        "srcaddr STRING, dstaddr STRING, srcport INT, dstport INT, first_time DOUBLE, method STRING, "
        "host STRING, message STRING, referrer STRING, contentLength STRING, contentType STRING, "
        "server STRING, user_agent STRING, accept STRING, accept_encoding STRING, firstkey STRING, "
        "secondkey STRING", ("ds", "ts"), ("srcaddr",), ("first_time",)),
    "userurls": ("srcaddr STRING, urls STRING", ("ds",), (), ()),
    "urlusersviews": ("urls STRING, users INT, views INT", ("ds",), (), ()),
}


def table_ddl(name: str, db: str = "default") -> str:
    """CREATE statement of a table: Parquet, partitioned, bucketed where the table is."""
    columns, partitions, buckets, sorts = TABLES[name]
    text = f"CREATE TABLE IF NOT EXISTS {db}.{name} ({columns}, {', '.join(f'{p} STRING' for p in partitions)}) "
    text += f"USING parquet PARTITIONED BY ({', '.join(partitions)})"
    if buckets:
        text += f" CLUSTERED BY ({', '.join(buckets)})"
        text += f" SORTED BY ({', '.join(sorts)})" if sorts else ""
        text += f" INTO {BUCKETS} BUCKETS"
    return text


def create_tables(spark: SparkSession, db: str = "default") -> list[str]:
    """Creates every table that does not exist yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for name in TABLES:
        spark.sql(table_ddl(name, db))
    return list(TABLES)


def write_partitions(df: DataFrame, path: str, spread: tuple[str, ...] | None = None,
                     **partition: str | None) -> None:
    """Writes rows into Parquet partitions, replacing only the partitions that appear.

    ``partition`` gives partition columns as constants (``area="x", ds="…"``) or,
    with the value None, names columns that are already there.  With ``spread``
    rows are range-partitioned by the present partition columns and then those,
    so a partition with much data is shared by several tasks and one with little
    is a single file.
    """
    present = [column for column, value in partition.items() if value is None]
    if spread is not None:
        order = [*present, *spread]
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    for column, value in partition.items():
        if value is not None:
            df = df.withColumn(column, F.lit(value))
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition).parquet(path))


def read_partitions(spark: SparkSession, path: str, columns: str | StructType | None = None,
                    only: list[dict[str, str]] | None = None, **partition: str) -> DataFrame:
    """Rows written by ``write_partitions``, with the given types for the partition columns.

    Left to inference a period such as ``0005`` would come back as the number 5.
    With ``columns``, the other columns' types, nothing is inferred and a path
    where nothing has been written yet has no rows. ``only`` names partitions by
    their leading columns: just their folders are listed.
    """
    if columns is None:
        found = spark.read.parquet(path)
        schema = ", ".join(f"`{name}` {partition.get(name, kind)}" for name, kind in found.dtypes)
        return spark.read.schema(schema).parquet(path)
    fields = columns.fields if isinstance(columns, StructType) else _parse_datatype_string(columns).fields
    parts = [StructField(name, _parse_datatype_string(kind)) for name, kind in partition.items()]
    schema = StructType([*(f for f in fields if f.name not in partition), *parts])
    folders = [path] if only is None else [
        "/".join([path, *(f"{name}={value}" for name, value in part.items())]) for part in only]
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(*folders) if folders else (
            spark.createDataFrame([], schema))
    except AnalysisException:
        return spark.createDataFrame([], schema)


def load_partition(df: DataFrame, table: str, mode: str = "append", **partition: str) -> None:
    """Loads rows into one partition of a created table; columns are matched by name.

    ``mode="overwrite"`` replaces that partition only, which makes a load repeatable.
    """
    verbs = {"append": "INSERT INTO", "overwrite": "INSERT OVERWRITE"}
    spark = df.sparkSession
    data = [f for f in spark.table(table).schema if f.name not in partition]
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in data])
    named = {f"p{i}": value for i, value in enumerate(partition.values())}
    where = ", ".join(f"{column} = :p{i}" for i, column in enumerate(partition))
    spark.sql(f"{verbs[mode]} {table} PARTITION ({where}) SELECT * FROM {{rows}}", args=named, rows=rows)


def daily_flow_rows(flows: DataFrame) -> DataFrame:
    """Flow rows under the column names of ``daily_flows``."""
    def number(name: str, kind: str):
        return (F.col(name) if name in flows.columns else F.lit(None)).cast(kind)

    def address(name: str):
        return ip_text(number(name, "bigint"))

    key = F.concat_ws(",", address("src_addr"), number("src_port", "string"), number("prot", "string"))
    same = ["input", "output", "pad1", "tcp_flags", "prot", "tos", "src_as", "dst_as", "src_mask",
            "dst_mask", "pad2"]
    rows = flows.select(
        number("sys_uptime", "bigint").alias("sys_uptime"), number("timestamp_us", "bigint").alias("time_stamp"),
        address("src_addr").alias("srcaddr"), address("dst_addr").alias("dstaddr"),
        address("nexthop").alias("nexthop"), number("dpkts", "bigint").alias("dpkts"),
        number("doctets", "bigint").alias("doctets"), number("first_us", "double").alias("first_time"),
        number("last_us", "double").alias("last_time"), number("src_port", "int").alias("srcport"),
        number("dst_port", "int").alias("dstport"), *[number(n, "int").alias(n) for n in same],
        key.alias("orderby"))
    return rows.select(*[column.split()[0] for column in TABLES["daily_flows"][0].split(", ")])


def create_report_views(spark: SparkSession, db: str = "default") -> None:
    """One table for the rows of all reports, partitioned by period and type, and a view for each report over it.

    The views have the columns of the report tables; they read the folders of their type only.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{REPORT_ROWS} (aggr_key STRING, {_SUMS}, "
              f"{', '.join(f'{p} STRING' for p in REPORT_PARTS)}) USING parquet PARTITIONED BY ({', '.join(REPORT_PARTS)})")
    for report, (stat_type, key) in FAN_OUT.items():
        named = f"aggr_key AS {key}, " if key else ""
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{report} AS SELECT ts, {named}octets, pkts, flows, area, month, ds "
                  f"FROM {db}.{REPORT_ROWS} WHERE type = '{stat_type}'")


def load_report_rows(stats: DataFrame, db: str, area: str, ds: str | None = None, ts: str | None = None) -> None:
    """Fills the rows of all reports for the periods of ``stats``, in one write.

    Periods are those given, or those of the columns ``ds`` and ``ts``. The partitions (period
    and type) that have rows are replaced, so a load may be repeated, no other period is
    read or written, and several periods of a day may be loaded at once.
    """
    day = F.col("ds") if ds is None else F.lit(ds)
    rows = stats.select("aggr_key", *[F.col(c).cast("bigint") for c in ("octets", "pkts", "flows")], F.lit(area).alias("area"),
                        F.substring(day, 1, 7).alias("month"), day.alias("ds"),
                        (F.col("ts") if ts is None else F.lit(ts)).alias("ts"), "type")
    with settings(stats.sparkSession, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        rows.repartition("ds", "ts", "type").write.insertInto(f"{db}.{REPORT_ROWS}", overwrite=True)


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Writes a table whose rows lie in sorted buckets of their keys, one file each.

    Two tables of as many buckets of the same keys join, and group by them, without a shuffle.
    """
    (df.repartition(buckets, *keys).sortWithinPartitions(*keys).write.mode("overwrite").format("parquet")
       .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))


def join_bucketed(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of two bucketed tables' rows on their bucket keys: buckets are merged where they lie."""
    return left.hint("merge").join(right.hint("merge"), keys, "full_outer")


def load_reports(stats: DataFrame, db: str, area: str, ds: str, ts: str) -> None:
    """Fills eight report tables from one period's statistics, or the one table behind report views.

    Of separate tables each period rewrites the day; prefer views (``create_report_views``). The statistics are written once and read from there for all tables. A period
    that is loaded again replaces its rows; the day's other periods stay.
    """
    spark = stats.sparkSession
    if spark.catalog.tableExists(f"{db}.{REPORT_ROWS}"):
        return load_report_rows(stats, db, area, ds, ts)
    kept = as_table(stats, "period-stats")
    for report in FAN_OUT:
        new = fan_out(kept, report).withColumn("ts", F.lit(ts))
        table = spark.table(f"{db}.{report}")
        day = table.where((F.col("area") == area) & (F.col("month") == ds[:7]) & (F.col("ds") == ds))
        names = [c for c in table.columns if c not in _DAY]
        # A table can't be read and overwritten at once, so the day goes by way of a file.
        rows = as_table(day.where(F.col("ts") != ts).select(*names).unionByName(
            new.select(*[F.col(c).cast(table.schema[c].dataType) for c in names])), "report-day")
        load_partition(rows, f"{db}.{report}", mode="overwrite", area=area, month=ds[:7], ds=ds)
