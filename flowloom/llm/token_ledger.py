"""Token counts as rollups maintained by deltas.

A ledger holds, for each committed batch, signed entries by document and
tokenizer version and their sums by source, language and version. A batch of
inserts, deletes and revised counts is turned into entries that cancel what
the ledger has for these documents and add what is new; the totals of all
batches simply add up. Entries and sums are written first, the batch's mark
last. A batch without its mark doesn't count and is written anew; a batch with
its mark is not applied again, so a commit may be repeated after any failure.

Entries are summed by group before they are shuffled, so a source with a third
of all documents costs a row per task; what a batch reads of older entries is
bounded by a join on the documents it changes.

Defined cases: an insert of a document that the ledger has, and a revision of
one that it hasn't, both set the count; a delete of an unknown one does nothing;
of several changes of one document and version in a batch the last by ``seq``
counts, then the greatest row; null ids are one document; null sources and
languages are groups of their own; null texts have no tokens; groups without
documents are left out of the totals.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowloom.llm.common import read, tidy_shuffles
from flowloom.plans.lineage import as_table, scratch_path

GROUP = ["source", "lang", "version"]
KEY = ["doc_id", "version"]
ENTRY = "doc_id long, version string, source string, lang string, n_docs long, n_tokens long, batch string"
TOTAL = "source string, lang string, version string, n_docs long, n_tokens long, batch string"

#: Tokens of each tokenizer version, as a pattern.
TOKENIZERS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "words-2": r"[A-Za-z0-9\x{80}-\x{10FFFF}]+|[^A-Za-z0-9\x{80}-\x{10FFFF}\x20\x09-\x0D]",
}
LONG_WORDS = r"[^\x20\x09-\x0D]{2,}"


def count_tokens(text: Column, pattern: str) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(pattern)).cast("long")


class TokenLedger:
    """A ledger in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or scratch_path(spark, "token-ledger")

    def _read(self, part: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{part}")
        except AnalysisException:  # nothing was written yet
            return self.spark.createDataFrame([], schema)

    def _committed(self, part: str, schema: str) -> DataFrame:
        return self._read(part, schema).join(F.broadcast(self.batches()), "batch", "left_semi")

    def batches(self) -> DataFrame:
        """(batch) of every committed batch."""
        return self._read("commits", "at long, batch string").select("batch")

    def current(self) -> DataFrame:
        """What the ledger has: one row for each document and version."""
        return (
            self._committed("entries", ENTRY).groupBy(*KEY, "source", "lang")
            .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0")
        )

    def totals(self) -> DataFrame:
        """n_docs and n_tokens by source, language and version."""
        return (
            self._committed("totals", TOTAL).groupBy(*GROUP)
            .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0")
        )

    def _entries(self, changes: DataFrame) -> DataFrame:
        order = ["seq"] if "seq" in changes.columns else []
        last = changes.groupBy(*KEY).agg(F.max(F.struct(*order, "op", "source", "lang", "n_tokens")).alias("c")).select(
            *KEY, "c.op", "c.source", "c.lang", "c.n_tokens")
        new = last.where("op <> 'delete'").select(
            *KEY, "source", "lang", F.lit(1).cast("long").alias("n_docs"), "n_tokens")
        have, touched = self.current(), last.select(*[F.col(c).alias(f"_{c}") for c in KEY])
        same = [have[c].eqNullSafe(touched[f"_{c}"]) for c in KEY]
        old = have.join(touched, same, "left_semi").withColumns(
            {"n_docs": -F.col("n_docs"), "n_tokens": -F.col("n_tokens")})
        return new.unionByName(old)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply (doc_id, version, op, source, lang, n_tokens[, seq]), op 'insert', 'revise' or 'delete'.

        False if the batch was committed before (nothing is done then).
        """
        if self.batches().where(F.col("batch") == batch).take(1):
            return False
        with tidy_shuffles(self.spark):
            path = f"{self.folder}/entries/batch={batch}"
            self._entries(changes).write.mode("overwrite").parquet(path)
            sums = self.spark.read.parquet(path).groupBy(*GROUP).agg(
                F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
            sums.write.mode("overwrite").parquet(f"{self.folder}/totals/batch={batch}")
            self.spark.range(1).select(F.col("id").alias("at")).write.mode("overwrite").parquet(
                f"{self.folder}/commits/batch={batch}")
        return True


def _changes(docs: DataFrame, op: str, version: str, pattern: str | None = None) -> DataFrame:
    count = count_tokens(F.col("text"), pattern) if pattern else F.lit(0).cast("long")
    return docs.select("doc_id", F.lit(version).alias("version"), F.lit(op).alias("op"), "source", "lang",
                       count.alias("n_tokens"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source, lang, version, n_docs, n_tokens after three batches over all documents.

    All documents come in with the first tokenizer, then with the second. The third
    batch deletes the documents labelled as of low quality and revises, for
    the first tokenizer, those labelled toxic; it is committed twice.
    """
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels")
    ledger = TokenLedger(spark)
    for version, pattern in TOKENIZERS.items():
        ledger.commit(f"load-{version}", _changes(docs, "insert", version, pattern))
    first = next(iter(TOKENIZERS))
    low, toxic = labels.where("quality = 0"), labels.where("toxic = 1 and quality <> 0")
    gone = docs.select("doc_id", "source", "lang").join(low, "doc_id", "left_semi")
    # Counted before the join, and written, so that it moves counts and not texts.
    changes = as_table(_changes(docs, "revise", first, LONG_WORDS), "revised-counts").join(toxic, "doc_id", "left_semi")
    for version in TOKENIZERS:
        changes = changes.unionByName(_changes(gone, "delete", version))
    for _ in range(2):
        ledger.commit("labels", changes)
    return ledger.totals()


OP4_SQL = r"""
WITH low AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 0),
toxic AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1 AND quality <> 0),
counted AS (
  SELECT source, lang, 'words-1' AS version, len(regexp_extract_all(coalesce(text, ''),
    CASE WHEN doc_id IN (SELECT doc_id FROM toxic) THEN '[^\x20\x09-\x0D]{2,}' ELSE '[^\x20\x09-\x0D]+' END)) AS n
  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM low)
  UNION ALL
  SELECT source, lang, 'words-2', len(regexp_extract_all(coalesce(text, ''),
    '[A-Za-z0-9\x{80}-\x{10FFFF}]+|[^A-Za-z0-9\x{80}-\x{10FFFF}\x20\x09-\x0D]'))
  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM low))
SELECT source, lang, version, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM counted GROUP BY source, lang, version
"""
