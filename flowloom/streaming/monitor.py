"""The five-minute flow monitor, and rule detection, as streaming queries.

Every micro-batch writes what adds up (sums, partial groups) into partitions
named by its batch number and replaces them if the batch runs again, so a
restart neither loses nor doubles anything.  Readers add the pieces up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowloom.functions.net import date_label
from flowloom.operators import rules as rule_ops
from flowloom.operators.anomaly import spoofs
from flowloom.operators.flows import flow_print, flowstats, scan
from flowloom.plans.lineage import as_table
from flowloom.session import settings
from flowloom.sources.tables import REPORT_ROWS, load_report_rows, load_reports, read_partitions, write_partitions

PERIOD_S = 300
SPREAD = 16
STATS_COLUMNS = "type string, aggr_key string, octets bigint, pkts bigint, flows bigint"
FLOW_COLUMNS = ("src_addr long, dst_addr long, src_port int, dst_port int, prot int, dpkts long, doctets long, "
                "tcp_flags int, src_as int, dst_as int, src_mask int, dst_mask int, first_us long")
PERIOD_TYPES = {"area": "string", "ds": "string", "ts": "string", "batch": "bigint"}
BIN_TYPES = {"day": "string", "batch": "bigint"}


def with_period(flows: DataFrame, time: str = "first_us", ds_format: str = "yyyy-MM-dd",
                ts_format: str = "HHmm", period_s: int = PERIOD_S) -> DataFrame:
    """Adds ``ds`` and ``ts``: the day and the period in which a flow was seen."""
    start = F.col(time) - F.pmod(time, F.lit(period_s * 1_000_000))
    return flows.withColumns({"ds": date_label(start, ds_format), "ts": date_label(start, ts_format)})


def _touched(rows: DataFrame, *names: str, **fixed: str) -> list[dict[str, str]]:
    """The partitions that rows are in: a batch has few, as it is a few minutes of traffic."""
    return [fixed | row.asDict() for row in rows.select(*names).distinct().collect()]


def _added_up(sums: DataFrame, by: list[str]) -> DataFrame:
    """Statistics out of those of several batches."""
    return sums.groupBy(*by, "type", "aggr_key").agg(
        F.sum("octets").alias("octets"), F.sum("pkts").alias("pkts"), F.sum("flows").alias("flows"))


def load_period(root: str, area: str, threshold: int = 10, registry: DataFrame | None = None,
                reports: str | None = None, **period):
    """Micro-batch writer: printed flows, then their statistics, port scans and, with a registry, spoofs.

    ``reports`` names a database whose report views (or eight report tables) get the touched periods, as they
    are now; views get all of them in one write.

    The batch goes into the table of flows, unsorted between tasks, so it is decoded
    once; the rest reads the touched periods of that table back, and of them only
    the columns it needs. A batch without flows does nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        parts = dict(area=area, ds=None, ts=None, batch=str(batch_id))
        printed = with_period(batch, **period)
        write_partitions(printed.repartition("ds", "ts", F.pmod(F.xxhash64("src_addr", "dst_addr"), F.lit(SPREAD))),
                         f"{root}/daily_flows", **parts)
        # The folders of this batch are those its rows name.
        periods = _touched(printed, "ds", "ts", area=area)
        every = read_partitions(spark, f"{root}/daily_flows", printed.schema, periods, **PERIOD_TYPES)
        loaded = every.where(F.col("batch") == batch_id)
        write_partitions(flowstats(loaded, by=["ds", "ts"]), f"{root}/flowstats", ("type", "aggr_key"), **parts)
        # Distinct ports do not add up over batches: a period that came in pieces is
        # looked at again as a whole, and its new result replaces the old one.
        write_partitions(scan(every, threshold, ("ds", "ts")), f"{root}/scan", ("src_addr", "dst_addr"),
                         area=area, ds=None, ts=None)
        if reports is not None:
            # Sums of all batches of the touched periods: the flows themselves need not be read again.
            sums = read_partitions(spark, f"{root}/flowstats", STATS_COLUMNS, periods, **PERIOD_TYPES)
            stats = as_table(_added_up(sums, ["ds", "ts"]), "touched-stats")
            if spark.catalog.tableExists(f"{reports}.{REPORT_ROWS}"):
                load_report_rows(stats, reports, area)
                periods = []
            for part in periods:
                of_period = stats.where((F.col("ds") == part["ds"]) & (F.col("ts") == part["ts"])).drop("ds", "ts")
                load_reports(of_period, reports, area, part["ds"], part["ts"])
        if registry is not None:
            found = spoofs(loaded, registry, by=("ds", "ts"))
            write_partitions(found, f"{root}/spoofs", ("src_addr", "first_us"), **parts)
    return write


def start_monitor(flows: DataFrame, root: str, area: str, trigger: dict | None = None, threshold: int = 10,
                  registry: DataFrame | None = None, reports: str | None = None, **period):
    """Starts the monitor over a stream of flows; ``trigger`` defaults to every five minutes."""
    return (
        flows.writeStream.foreachBatch(load_period(root, area, threshold, registry, reports, **period))
        .option("checkpointLocation", f"{root}/_checkpoint")
        .trigger(**(trigger or {"processingTime": "5 minutes"})).start()
    )


def monitored_flows(spark: SparkSession, root: str, **period: str) -> DataFrame:
    """The loaded flows, those of a period (``area``, ``ds``, ``ts``) in printing order."""
    rows = read_partitions(spark, f"{root}/daily_flows", **PERIOD_TYPES)
    for name, value in period.items():
        rows = rows.where(F.col(name) == value)
    return flow_print(rows, ("ds", "ts"))


def monitored_stats(spark: SparkSession, root: str, by: list[str] | None = None) -> DataFrame:
    """Statistics over everything the monitor has loaded."""
    return _added_up(read_partitions(spark, f"{root}/flowstats", STATS_COLUMNS, **PERIOD_TYPES), by or [])


def detect_batch(root: str, rules: list[rule_ops.Rule], day_format: str = "yyyy-MM-dd"):
    """Micro-batch writer: partial groups of the batch, then reports for the bins it touched.

    Late flows are counted whenever they come: their bin is evaluated again, and
    the newest evaluation of a bin is the one that counts. A batch that matches
    no rule does nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        day = date_label(F.col("bin_start") * 1_000_000, day_format)
        partial = as_table(rule_ops.partial_groups(rule_ops.matched(batch, rules)).withColumn("day", day), "batch-groups")
        if partial.isEmpty():
            return
        keys = [c for c in partial.columns if c.startswith(("key_", "sort_"))]
        write_partitions(partial, f"{root}/groups", ("bin_start", "rule_id", *keys), day=None, batch=str(batch_id))
        groups = read_partitions(spark, f"{root}/groups", partial.schema, _touched(partial, "day"), **BIN_TYPES)
        touched = partial.select("day", "bin_start").distinct()
        again = groups.join(touched, ["day", "bin_start"], "left_semi").drop("day", "batch")
        reports = rule_ops.final_groups(rule_ops.partial_groups(again), rules)
        write_partitions(reports, f"{root}/reports", batch=str(batch_id))
        write_partitions(touched.select("bin_start"), f"{root}/evaluated", ("bin_start",), batch=str(batch_id))
    return write


def reported(spark: SparkSession, root: str, rules: list[rule_ops.Rule]) -> DataFrame:
    """The reports that stand: for each bin those of the newest batch that evaluated it."""
    newest = read_partitions(spark, f"{root}/evaluated", "bin_start bigint", batch="bigint").groupBy(
        F.col("bin_start").alias("bin")).agg(F.max("batch").alias("newest"))
    empty = rule_ops.final_groups(rule_ops.partial_groups(rule_ops.matched(
        spark.createDataFrame([], FLOW_COLUMNS), rules)), rules)
    reports = read_partitions(spark, f"{root}/reports", empty.schema, batch="bigint")
    return reports.join(newest, (F.col("bin_start") == F.col("bin")) & (F.col("batch") == F.col("newest"))).select(
        *empty.columns)


def start_detection(flows: DataFrame, root: str, rules: list[rule_ops.Rule] | None = None,
                    trigger: dict | None = None, day_format: str = "yyyy-MM-dd"):
    """Starts rule detection over a stream of flows."""
    rules = rule_ops.load_rules() if rules is None else rules
    return (
        flows.writeStream.foreachBatch(detect_batch(root, rules, day_format))
        .option("checkpointLocation", f"{root}/_checkpoint")
        .trigger(**(trigger or {"processingTime": "5 minutes"})).start()
    )


def append_all(make, rows: DataFrame, closing: DataFrame, root: str, files: int = 3, time: str | None = None,
               progress: list | None = None, conf: dict[str, str] | None = None) -> DataFrame:
    """Runs ``make``, a function from a stream of rows to an aggregated stream, over rows that come in
    ``files`` pieces, in append mode; returns what was appended.

    With ``time``, a column of numbers, the pieces follow each other in time, each is one
    micro-batch, and what its watermark closes is released before the next; else the pieces
    hold rows of any time. ``closing`` has a row whose time is past all windows: it comes last,
    moves the watermark on, and so closes every window of the rows. ``progress`` gets the
    reports of all batches; ``conf`` are settings of the query.
    """
    spark = rows.sparkSession
    closing = closing.select(*[F.col(f.name).cast(f.dataType) for f in rows.schema])

    def run(files_a_batch=None):
        reader = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true")
        stream = make((reader.option("maxFilesPerTrigger", files_a_batch) if files_a_batch else reader).parquet(f"{root}/in"))
        with settings(spark, conf or {}):
            query = (stream.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out")
                     .option("checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
        if progress is not None:
            progress.extend(query.recentProgress)
        return stream.schema
    if time is None:
        rows.repartition(files).write.parquet(f"{root}/in/rows")
        run(1)
        closing.coalesce(1).write.parquet(f"{root}/in/closing")
        return spark.read.schema(run(1)).parquet(f"{root}/out")
    first, last = rows.agg(F.min(time), F.max(time)).first()
    piece = F.lit(0)
    if first is not None and last > first:
        piece = F.coalesce(F.least(F.floor((F.col(time) - first) * files / (last - first)), F.lit(files - 1)), F.lit(0))
    for i in range(files):
        part = rows.where(piece == i)
        (part.unionByName(closing) if i == files - 1 else part).write.parquet(f"{root}/in/piece-{i}")
        schema = run()
    return spark.read.schema(schema).parquet(f"{root}/out")
