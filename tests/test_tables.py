"""Table definitions, partition loads, and the folder for intermediate results."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from flowloom.operators.flows import flowstats
from flowloom.plans.lineage import as_table, cut, fits, shared_folder
from flowloom.sources import tables
from tests.conftest import flow_rows


@pytest.fixture(scope="module")
def db(spark):
    tables.create_tables(spark, "netdb")
    yield "netdb"
    spark.sql("DROP DATABASE netdb CASCADE")


def test_every_table_is_created_once(spark, db):
    names = {r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()}
    assert names == {n.lower() for n in tables.TABLES} and len(names) == 20
    assert tables.create_tables(spark, db)  # again, without harm
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {db}.flowstats").collect()}
    assert described["Num Buckets"] == "32" and "type" in described["Bucket Columns"]


def test_loads_touch_only_their_partition(spark, db):
    rows = flow_rows(spark, [dict(src_addr=i) for i in range(3)])
    daily = tables.daily_flow_rows(rows)
    assert daily.columns == [c.split()[0] for c in tables.TABLES["daily_flows"][0].split(", ")]
    name = f"{db}.daily_flows"
    tables.load_partition(daily, name, area="x", ds="2024-01-01", ts="0000")
    tables.load_partition(daily, name, area="x", ds="2024-01-01", ts="0005")
    tables.load_partition(daily.limit(1), name, mode="overwrite", area="x", ds="2024-01-01", ts="0005")
    got = {r.ts: r["count"] for r in spark.table(name).groupBy("ts").count().collect()}
    assert got == {"0000": 3, "0005": 1}
    plan = spark.table(name).where("ts = '0005'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ts" in plan


def test_reports_are_filled_from_the_statistics(spark, db):
    stats = flowstats(flow_rows(spark, [dict(), dict(dst_port=443)])).withColumnRenamed("aggr_key", "aggrKey")
    tables.load_partition(stats, f"{db}.flowstats", area="x", ds="2024-01-02", ts="0000")
    loaded = spark.table(f"{db}.flowstats").where("ds = '2024-01-02'").withColumnRenamed("aggrKey", "aggr_key")
    tables.load_reports(loaded, db, "x", "2024-01-02", "0000")
    assert [tuple(r) for r in spark.table(f"{db}.totalvolume").select("octets", "pkts", "flows", "month").collect()] == [
        (200, 2, 2, "2024-01")]
    assert {r.port for r in spark.table(f"{db}.portingress").collect()} == {"80", "443"}
    assert spark.table(f"{db}.asegress").count() == 1


def test_reports_of_a_period_may_be_loaded_again(spark, db):
    stats = flowstats(flow_rows(spark, [dict(), dict(dst_port=443)]))
    for ts in ("0000", "0005", "0000"):
        tables.load_reports(stats, db, "y", "2024-01-03", ts)
    rows = spark.table(f"{db}.portingress").where("area = 'y'").select("ts", "port", "flows").collect()
    assert sorted(map(tuple, rows)) == [(ts, port, 1) for ts in ("0000", "0005") for port in ("443", "80")]


def test_write_partitions_replaces_what_appears(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "n int, k string")
    tables.write_partitions(rows, path, area="x", k=None)
    tables.write_partitions(rows.where("k = 'b'").withColumn("n", F.lit(9)), path, area="x", k=None)
    assert sorted((r.n, r.k) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]


def test_intermediate_results_stay_in_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    df = spark.range(5)
    assert cut(df).count() == 5 and folder in spark.sparkContext.getCheckpointDir()
    assert folder in as_table(df, "x").inputFiles()[0]
    assert fits(df, 5) and not fits(df, 4)


@pytest.fixture()
def views(spark, tmp_path):
    db = f"views_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path / 'db'}'")
    tables.create_report_views(spark, db)
    tables.create_report_views(spark, db)  # again, without harm
    yield db
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_periods_of_a_day_may_be_loaded_at_once(spark, views):
    stats = {f"{i:04d}": flowstats(flow_rows(spark, [dict(dst_port=i)] * (i + 1))).persist() for i in range(6)}
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda ts: tables.load_reports(stats[ts], views, "x", "2024-01-03", ts), stats))
    tables.load_reports(stats["0002"], views, "x", "2024-01-03", "0002")
    got = spark.table(f"{views}.portingress").select("area", "month", "ds", "ts", "port", "flows").collect()
    assert sorted(map(tuple, got)) == [("x", "2024-01", "2024-01-03", f"{i:04d}", str(i), i + 1) for i in range(6)]
    assert spark.table(f"{views}.totalvolume").columns == ["ts", "octets", "pkts", "flows", "area", "month", "ds"]
    plan = spark.table(f"{views}.portingress").where("ts = '0003'")._jdf.queryExecution().executedPlan().toString()
    assert "type" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_all_periods_of_a_batch_are_one_write(spark, views):
    rows = flow_rows(spark, [dict(), dict(dst_port=443), dict(dst_port=443, first_us=300_000_000)])
    rows = rows.withColumn("ds", F.lit("2024-01-04")).withColumn("ts", F.when(F.col("first_us") == 0, "0000").otherwise("0005"))
    tables.load_report_rows(flowstats(rows, by=["ds", "ts"]), views, "x")
    got = spark.table(f"{views}.portingress").select("ts", "port", "flows").collect()
    assert sorted(map(tuple, got)) == [("0000", "443", 1), ("0000", "80", 1), ("0005", "443", 1)]


def test_bucketed_tables_join_without_a_shuffle(spark, views):
    for name, n in (("before", 200), ("after", 300)):
        tables.write_bucketed(spark.range(n).selectExpr("id % 50 AS src_addr", "id AS octets"), f"{views}.{name}", ["src_addr"], 8)
    sides = [spark.table(f"{views}.{name}").groupBy("src_addr").agg(F.sum("octets").alias(name)) for name in ("before", "after")]
    joined = tables.join_bucketed(*sides, ["src_addr"])
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    want = [(i, sum(range(i, 200, 50)), sum(range(i, 300, 50))) for i in range(50)]
    assert sorted(map(tuple, joined.collect())) == want
