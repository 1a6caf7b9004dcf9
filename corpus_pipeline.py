"""The corpus pipeline: five stages over ``documents``, each over all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``; the last returns the tokens of every kept document.

Only three stages drop documents: toxic ones, all but the first of each group of near
copies, and those that hold a window of the benchmark. Line dedup shortens texts, even to
nothing; such documents go on as empty ones, as null and empty texts do: they have no
shingles, no window and no tokens, so nothing drops them and their row has no
tokens. Rows without doc_id stay as each stage defines it; tables without rows give
none; further columns go through whatever their names are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowloom.llm import byte_bpe, decontaminate, jaccard_join, line_dedup, toxicity
from flowloom.llm.common import read
from flowloom.plans.lineage import as_table


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels, does not call toxic."""
    return toxicity.drop_toxic(docs, toxicity.toxic_labels(read(spark, sf_dir, "labels")))


def _line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; lines that many documents repeat stay in the last of them only."""
    done = line_dedup.dedup_lines(docs).withColumn("text", F.col("kept"))
    return done.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def _jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies; documents without words all stay."""
    return jaccard_join.keep_one_of_each(docs)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def _byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.VOCABULARY))
    return byte_bpe.digests(byte_bpe.encode(docs, ranks, decoded=True))


STAGES = [
    ("toxicity", _toxicity),
    ("line_dedup", _line_dedup),
    ("jaccard_join", _jaccard_join),
    ("benchmark_decontamination", _decontamination),
    ("byte_bpe", _byte_bpe),
]

# The toxicity classifier and the encoding have no SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = as_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
