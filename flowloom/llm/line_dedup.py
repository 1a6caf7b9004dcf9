"""Line dedup with levelled sorted runs (native: built-in functions only).

A run holds, sorted by line hash, for each distinct line key of one or more
batches: the number of documents that hold it and the largest of their ids.
A batch is joined with the runs by merge (which of its lines are new: the anti
join), and its own run joins level 0. When a level has ``fanout`` runs they are
compacted into one of the next level, so k batches leave O(log k) runs.

A line's key is the line without blanks at its ends and with A-Z in lower case.
Only 128-bit hashes of keys are shuffled, counted before the shuffle, so a line
that a third of all documents hold costs a row per task.

Defined cases: a null or empty text is one empty line; blank and short lines
always stay; a null doc_id counts as one document, smaller than any other;
rows that repeat a doc_id count as one holder; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowloom.llm.common import BLANKS, ascii_lower, fingerprint, read, tidy_shuffles
from flowloom.plans.lineage import as_table, scratch_path

MIN_LENGTH = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 3
RESULTS = ["kept", "n_lines", "n_dropped"]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_hashes(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, text_hash, line_no, h1, h2) of every line whose key has at least ``min_length`` characters."""
    line = F.btrim("line", F.lit(BLANKS))
    return (
        docs.select("doc_id", _text_hash(F.col("text")).alias("text_hash"),
                    F.posexplode(_lines(F.col("text"))).alias("line_no", "line"))
        .where(F.char_length("line") >= min_length).withColumn("line", line)
        .where(F.char_length("line") >= min_length)
        .select("doc_id", "text_hash", "line_no", *fingerprint(ascii_lower(F.col("line"))))
    )


class LineRuns:
    """Sorted runs of line keys in a folder: ``h1, h2, n_docs, last_doc, is_new``.

    ``add`` may be repeated for the batch it added last (the run is replaced); the
    documents of one batch must not come again in another.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.folder = folder or scratch_path(spark, "line-runs")
        self.levels: list[list[str]] = [[]]

    def paths(self) -> list[str]:
        return [path for level in self.levels for path in level]

    def totals(self, paths: list[str] | None = None) -> DataFrame:
        """One row for each key over the given runs (all)."""
        runs = self.spark.read.parquet(*(paths or self.paths()))
        return runs.groupBy("h1", "h2").agg(
            F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"), F.max("is_new").alias("is_new"))

    def _write(self, run: DataFrame, path: str) -> None:
        run.sortWithinPartitions("h1", "h2").write.mode("overwrite").parquet(path)

    def add(self, batch: str, hashes: DataFrame) -> DataFrame:
        """Add a batch's lines; return the keys of it that no earlier batch holds."""
        own = (
            hashes.select("h1", "h2", "doc_id").distinct().groupBy("h1", "h2")
            .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        )
        path = f"{self.folder}/level=0/{batch}"
        older = [p for p in self.paths() if p != path]
        if older:  # one merge with the runs tells new lines (the anti join) from those met again
            known = self.totals(older).select("h1", "h2", F.lit(False).alias("is_new")).hint("merge")
            own = own.join(known, ["h1", "h2"], "left")
        else:
            own = own.withColumn("is_new", F.lit(True))
        self._write(own.withColumn("is_new", F.coalesce("is_new", F.lit(True))), path)
        if path not in self.levels[0]:
            self.levels[0].append(path)
        self.compact(batch)
        return self.spark.read.parquet(path).where("is_new")

    def compact(self, name: str) -> None:
        """Merge every level that is full into one run of the next."""
        for number, level in enumerate(self.levels):
            if len(level) < self.fanout:
                continue
            path = f"{self.folder}/level={number + 1}/{name}"
            self._write(self.totals(level), path)
            if number + 1 == len(self.levels):
                self.levels.append([])
            self.levels[number + 1].append(path)
            self.levels[number] = []


def repeated_lines(docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS,
                   batches: int = BATCHES) -> DataFrame:
    """(h1, h2, last_doc) of the keys that at least ``min_docs`` documents hold.

    The documents go through the runs in ``batches`` parts by a hash of their id.
    """
    spark = docs.sparkSession
    part = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    with tidy_shuffles(spark):
        hashes = as_table(line_hashes(docs, min_length).select("doc_id", "h1", "h2", part.alias("batch")), "line-hashes")
        runs = LineRuns(spark)
        for batch in range(batches):
            runs.add(f"batch-{batch}", hashes.where(F.col("batch") == batch))
        return as_table(runs.totals().where(F.col("n_docs") >= min_docs).select("h1", "h2", "last_doc"), "repeated-lines")


def dedup_lines(docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS,
                batches: int = BATCHES) -> DataFrame:
    """``docs`` with ``kept`` (the text without repeated lines), ``n_lines`` and ``n_dropped``.

    A line goes if its key is held by at least ``min_docs`` documents and this one
    hasn't the largest doc_id of them. Columns of ``docs`` with these names are replaced.
    """
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns if c not in RESULTS]).alias("row"),
                       F.col("doc_id").alias("doc"), _text_hash(F.col("text")).alias("hash"),
                       _lines(F.col("text")).alias("lines"))
    gone = (
        line_hashes(docs, min_length).join(repeated_lines(docs, min_length, min_docs, batches), ["h1", "h2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
        .groupBy(F.col("doc_id").alias("doc2"), F.col("text_hash").alias("hash2"))
        .agg(F.collect_set("line_no").alias("gone"))
    )
    numbers = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.transform(F.array_except(numbers, F.coalesce("gone", F.array().cast("array<int>"))),
                       lambda i: F.get(F.col("lines"), i))
    return rows.join(gone, F.col("doc").eqNullSafe(F.col("doc2")) & (F.col("hash") == F.col("hash2")), "left").select(
        "row.*", F.array_join(kept, "\n").alias("kept"), F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    done = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(str_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(str_split(coalesce(text, ''), chr(10))))) AS line_no
  FROM documents),
keyed AS (
  SELECT doc_id, line_no, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM lines),
repeated AS (
  SELECT line_key, max(doc_id) AS last_doc FROM keyed WHERE length(line_key) >= 40
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.*, r.line_key IS NOT NULL AND k.doc_id <> r.last_doc AS gone
  FROM keyed k LEFT JOIN repeated r ON k.line_key = r.line_key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
