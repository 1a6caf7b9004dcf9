"""Delimited text and job-history lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

# Fixed value: the first line of a job-history file.
HISTORY_HEADING = "Avro-Json"

_EVENT = "attemptId: string, startTime: long, finishTime: long, hostname: string, state: string, locality: string"
_HISTORY = f"type string, attemptId string, time_ms long, event map<string, struct<{_EVENT}>>"


def read_delimited(spark: SparkSession, path: str, sep: str, schema: str, header: bool = False) -> DataFrame:
    """Rows of delimited text; malformed lines are dropped, whichever columns are used later."""
    whole = StructType(_parse_datatype_string(schema).fields + [StructField("_malformed", StringType())])
    rows = spark.read.option("columnPruning", "false").csv(
        path, sep=sep, schema=whole, header=header, mode="PERMISSIVE", columnNameOfCorruptRecord="_malformed")
    names = [field.name for field in whole.fields[:-1]]
    # The hash (never below the least long) makes every column needed: Spark reads no file for the mark alone.
    return rows.where(F.col("_malformed").isNull() & (F.xxhash64(*names) >= F.lit(-2**63))).select(*names)


def write_text(df: DataFrame, path: str, sep: str = "|", mode: str = "overwrite") -> None:
    """Rows as delimited text."""
    df.write.mode(mode).csv(path, sep=sep)


def job_history(lines: DataFrame, column: str = "line") -> DataFrame:
    """Task-attempt events out of history lines.

    An event's fields lie either beside its type or one level down, below a
    name that depends on the event.
    """
    rows = lines.where((F.trim(column) != "") & (F.trim(column) != HISTORY_HEADING))
    parsed = rows.select(F.from_json(column, _HISTORY).alias("j"))
    inner = F.try_element_at(F.map_values("j.event"), F.lit(1))
    return parsed.select(
        F.col("j.type").alias("type"),
        F.coalesce("j.attemptId", inner["attemptId"]).alias("attempt"),
        F.coalesce("j.time_ms", inner["startTime"], inner["finishTime"]).alias("time_ms"),
        inner["locality"].alias("locality"), inner["hostname"].alias("host"), inner["state"].alias("state"),
    )


def read_job_history(spark: SparkSession, path: str) -> DataFrame:
    """Task-attempt events of history files."""
    return job_history(spark.read.text(path).withColumnRenamed("value", "line"))
