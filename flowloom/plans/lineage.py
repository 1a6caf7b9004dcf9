"""Where intermediate results go, and how a plan is cut.

Everything is kept in the folder that the session names in
``spark.checkpoint.dir``: it must be shared by all executors, so that a lost
executor costs only its running tasks.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate results, from the session.

    In a session of one process with nothing set (tests), a folder is made, set and
    removed at the end; on a cluster an unset folder is an error, because no local
    path is shared there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="flowloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as a reliable checkpoint, for plans that read them many times."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def as_table(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` written once as Parquet and read back (columns stay prunable)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows, read no further than needed."""
    return df.limit(max_rows + 1).count() <= max_rows
