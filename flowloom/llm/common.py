"""What several operators here share: tables, digests, ASCII case, session settings."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are.

    ``lower`` does just that for a text of ASCII alone, and much faster.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def fingerprint(value: Column) -> list[Column]:
    """128 bits of a value as two columns, ``h1`` and ``h2``."""
    return [F.xxhash64(value).alias("h1"), F.xxhash64(F.lit(1), value, F.lit(2)).alias("h2")]


@contextmanager
def settings(spark: SparkSession, **values: str):
    """SQL settings for the jobs run inside; double underscores stand for dots."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def tidy_shuffles(spark: SparkSession):
    """Inside, a job's shuffle files go when the job ends, so that several jobs of one operator need
    the disk of the largest, not of all."""
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def arrow_batches(spark: SparkSession, rows: int = 512, size: int = 4 << 20):
    """Inside, jobs send texts to Python in batches of so many rows and bytes at most."""
    return settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(rows),
                    spark__sql__execution__arrow__maxBytesPerBatch=str(size))


def filtered(docs: DataFrame, added, keep) -> DataFrame:
    """The rows of ``docs`` that ``keep``, a function of a DataFrame, keeps, as they are: columns with names that it
    adds itself (``added``) are set aside under others meanwhile."""
    mark = "_" * (1 + max(map(len, docs.columns)))
    aside = {c: f"{mark}{c}" for c in docs.columns if c in added}
    return keep(docs.withColumnsRenamed(aside)).select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def small_batches(spark: SparkSession) -> None:
    """Arrow batches for texts: bounded by bytes, so that long texts don't add up in a worker.

    The setting is read when a plan runs, which may be after the operator returns; so it stays.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def least_count(counts: DataFrame, most: int) -> int:
    """Smallest count ``n`` such that at most ``most`` rows of ``counts`` have it or more."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 64)  # by 64ths of a power of two: few rows for the driver
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("rows"), F.min("n").alias("least")).collect()
    total, least = 0, 1 << 62
    for row in sorted(sizes, key=lambda r: -r.step):
        total += row.rows
        if total > most:
            break
        least = row.least
    return least


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned 32- or 64-bit numbers by byte planes, pressed."""
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes() for x in arrays]
    head = np.array([len(arrays), *(v for x in arrays for v in (len(x), x.itemsize))], "<u4").tobytes()
    return head + zstandard.compress(b"".join(planes), 3)


def unpack(data: bytes) -> list[np.ndarray]:
    many = int.from_bytes(data[:4], "little")
    head = np.frombuffer(data, "<u4", 2 * many, 4).reshape(-1, 2).astype(np.int64)
    planes, out, at = zstandard.decompress(data[4 + 8 * many:]), [], 0
    for n, size in head.tolist():
        part = np.frombuffer(planes, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(part.T).view(f"<u{size}").ravel())
        at += n * size
    return out
