"""Toxicity: a character n-gram linear classifier with naive Bayes log-count ratios.

Texts become the set of their hashed character n-grams (3 to 5 characters, lower
case, blanks at both ends). A feature's value is the log ratio of its smoothed
document rates in toxic and clean texts; a logistic regression over these
values, fitted by Spark, gives the weights. The model is one number for each of
2**18 bins (1 MB), so scoring is one scan of all documents and whole texts.

Learning uses at most ``sample`` labelled rows, those of smallest id hash; the
features kept are the ``kept`` that tell most about the label, ties by bin. Spark
counts and ranks the bins; the driver gets the counts of the kept ones and two sums.

Defined cases: null and empty texts have the share of label 1 among the rows
learned from as their score; labels other than 0 and 1 or of no document are not used, of
repeated labels for a document each counts; without rows of both labels every
score is the share of label 1 (0 without labels), pulled in by smoothing; rows
with a null doc_id are scored, never learned from; other columns pass through,
columns with the names of results are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from flowloom.llm.common import filtered, read, small_batches, tidy_shuffles
from flowloom.llm.spans import CHUNK_BYTES, mix
from flowloom.plans.lineage import as_table

SIZES = (3, 4, 5)
BINS = 1 << 18
SAMPLE = 20_000
KEPT = 1024
FOLDS = 5


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS; fold 0 is held out."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS))


def _bins(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bin) of every n-gram of the texts."""
    padded = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum([len(p) for p in padded])
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(p) for p in padded])
    left = ends[owner] - np.arange(len(codes))
    spread = mix(codes + np.uint64(1))
    owners, found, total = [], [], np.zeros(len(codes), np.uint64)
    for size in range(1, max(SIZES) + 1):
        total = total[:len(codes) - size + 1] if len(codes) >= size else total[:0]
        total = total + spread[size - 1:] * np.uint64(2 * size + 1)
        if size in SIZES:
            fits = left[:len(total)] >= size
            owners.append(owner[:len(total)][fits])
            found.append((mix(total[fits]) >> np.uint64(46)).astype(np.int32))
    return np.concatenate(owners), np.concatenate(found)


def _parts(texts: list) -> list[tuple[int, list[str]]]:
    """(first index, texts) of runs of texts of bounded length; null is empty."""
    parts, held, total = [], [], 0
    for text in texts:
        text = text or ""
        if held and total + len(text) > CHUNK_BYTES // 4:
            parts.append(held)
            held, total = [], 0
        held.append(text)
        total += len(text)
    parts.append(held)
    starts = np.cumsum([0, *map(len, parts)]).tolist()
    return [(s, p) for s, p in zip(starts, parts) if p]


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, label) of at most ``sample`` labelled rows outside fold 0."""
    usable = labels.where("doc_id is not null and label in (0, 1)").where(fold(F.col("doc_id")) != 0)
    chosen = usable.select("doc_id", F.col("label").cast("int").alias("_label")).orderBy(
        F.xxhash64("doc_id"), "doc_id", "_label").limit(sample)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "text", F.col("_label").alias("label"))


def bin_counts(rows: DataFrame) -> DataFrame:
    """(bin, n0, n1): number of documents of label 0 and of label 1 that have a bin."""

    def count(batches):
        sums = np.zeros((2, BINS), np.int64)
        for batch in batches:
            texts, labels = batch.column("text").to_pylist(), np.array(batch.column("label").to_pylist(), np.int64)
            for start, part in _parts(texts):
                owner, bins = _bins(part)
                both = np.unique(owner.astype(np.int64) * BINS + bins)
                np.add.at(sums, (labels[start + both // BINS], both % BINS), 1)
        place = np.flatnonzero(sums.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(place.astype(np.int32)), pa.array(sums[0, place]), pa.array(sums[1, place])],
            names=["bin", "n0", "n1"])

    return rows.mapInArrow(count, "bin int, n0 long, n1 long").groupBy("bin").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _information(totals: np.ndarray) -> Column:
    """Mutual information of having a bin with the label, from its n0 and n1; totals: rows of each label, neither 0."""
    every = float(totals.sum())
    have = (F.col("n0") + F.col("n1")).cast("double")
    parts = []
    for name, total in zip(("n0", "n1"), map(float, totals)):
        with_bin = F.col(name).cast("double")
        for n, margin in ((with_bin, have), (total - with_bin, every - have)):
            parts.append(F.when(n > 0, n / every * F.log(n * every / (margin * total))).otherwise(0.0))
    return parts[0] + parts[1] + parts[2] + parts[3]


def telling_bins(counts: DataFrame, totals: np.ndarray, kept: int) -> DataFrame:
    """The at most ``kept`` rows of (bin, n0, n1) that tell most about the label, ties by bin."""
    return counts.withColumn("information", _information(totals)).where("information > 0").orderBy(
        F.desc("information"), "bin").limit(kept).select("bin", "n0", "n1")


def _features(rows: DataFrame, chosen: np.ndarray, ratio: np.ndarray) -> DataFrame:
    """(label, features): log-count ratios of the chosen bins that a text has."""
    place = np.full(BINS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    shared = rows.sparkSession.sparkContext.broadcast((place, ratio[chosen]))

    def make(batches):
        at, values = shared.value
        for batch in batches:
            out = []
            for _, part in _parts(batch.column("text").to_pylist()):
                owner, bins = _bins(part)
                found = at[bins]
                both = np.unique(owner[found >= 0].astype(np.int64) * BINS + found[found >= 0])
                bounds = np.searchsorted(both, np.arange(len(part) + 1) * BINS)
                out += [(both[a:b] % BINS).astype(np.int32) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(out, pa.list_(pa.int32())),
                 pa.array([values[o] for o in out], pa.list_(pa.float64()))], names=["label", "indices", "values"])

    # Written first, as vectors are made by Python again: in one stage a task would keep two workers, and the fit's passes
    # would make the features anew.
    sparse = as_table(rows.select("text", "label").mapInArrow(
        make, "label int, indices array<int>, values array<double>"), "training-features")
    vector = F.udf(_sparse(len(chosen)), VectorUDT())
    return sparse.select(F.col("label").cast("double").alias("label"), vector("indices", "values").alias("features"))


def _sparse(size: int):
    def make(indices, values):
        return SparseVector(size, indices, values)
    return make


class Model:
    """Weights by bin, a bias, and the log odds of label 1 among the rows learned from."""

    def __init__(self, weights: np.ndarray, bias: float, prior: float):
        self.weights, self.bias, self.prior = weights.astype(np.float64), float(bias), float(prior)

    def scores(self, texts: list) -> np.ndarray:
        out = np.array([self.bias if text else self.prior for text in texts], np.float64)
        filled = np.flatnonzero([bool(text) for text in texts])
        for start, part in _parts([texts[i] for i in filled]):
            owner, bins = _bins(part)
            used = self.weights[bins] != 0
            both = np.unique(owner[used].astype(np.int64) * BINS + bins[used])
            np.add.at(out, filled[start + both // BINS], self.weights[both % BINS])
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, kept: int = KEPT,
        regularisation: float = 1e-3) -> Model:
    """A model from documents (doc_id, text) and labels (doc_id, label 0 or 1) outside fold 0."""
    spark = docs.sparkSession
    small_batches(spark)
    with tidy_shuffles(spark):
        rows = as_table(training_rows(docs, labels, sample).repartition(
            spark.sparkContext.defaultParallelism), "training-texts")
        totals = np.zeros(2)
        for row in rows.groupBy("label").count().collect():
            totals[row.label] = row["count"]
        prior = np.log((totals[1] + 0.5) / (totals[0] + 0.5)) if totals.sum() else -500.0
        if not totals.all():
            return Model(np.zeros(BINS), prior, prior)
        counts = as_table(bin_counts(rows), "training-counts")  # at most BINS rows
        sums = counts.agg(F.sum("n0"), F.sum("n1")).first()
        found = np.array(sorted(telling_bins(counts, totals, kept).collect()), np.int64).reshape(-1, 3)
        chosen = found[:, 0]
        rate = [np.log((found[:, 1 + label] + 1.0) / ((sums[label] or 0) + BINS)) for label in (0, 1)]
        ratio = np.zeros(BINS)
        ratio[chosen] = rate[1] - rate[0]
        fitted = LogisticRegression(regParam=regularisation, standardization=False, maxIter=100, tol=1e-7).fit(
            _features(rows, chosen, ratio))
    weights = np.zeros(BINS)
    weights[chosen] = np.array(fitted.coefficients.toArray()) * ratio[chosen]
    return Model(weights, fitted.intercept, prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier), from whole texts."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.drop("score")
    field = pa.field("score", pa.float64())

    def run(batches):
        for batch in batches:
            values = shared.value.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], schema=pa.schema([*batch.schema, field]))

    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField("score", T.DoubleType())]))


def toxic_labels(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", F.col("toxic").alias("label"))


def drop_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """The documents whose score is below ``limit``, with all their columns; ``labels`` has doc_id and label."""
    model = fit(docs, labels)
    return filtered(docs, ("score",), lambda rows: score(rows, model).where(F.col("score") < limit))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, toxic_labels(read(spark, sf_dir, "labels"))))
    return scored.select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
