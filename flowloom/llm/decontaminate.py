"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Benchmark texts become windows of ten words (a shorter item is one window). The
windows' hashes are broadcast; every document's windows of the same sizes are
looked up in one scan without a shuffle, hits are verified word by word, and the
words inside a hit are marked. Then spans or whole documents can be removed.

The windows are counted first. What is broadcast at once is held to
``block_windows`` windows and ``block_bytes`` bytes; a larger benchmark goes over
the documents in several blocks, whose hits are merged by document; spans are then cut
out of the texts in one more scan.

Defined cases: a null or empty text has no words and no hits; an item without
words hits nothing; equal items all count; an item that occurs twice counts
once; items whose id is null count as one item without an id, which hits words
and is the last, null, in the list of items; other columns pass through, columns with the names of results are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flowloom.llm.common import filtered, read, small_batches
from flowloom.llm.spans import Words, chunks, split_words, word_table

WINDOW = 10
BLOCK_WINDOWS = 500_000
BLOCK_BYTES = 48 << 20
# The characters that part words: all of ASCII but digits and (texts are in lower case by then) a-z.
STOPS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))

ADDED = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.StructType([
        T.StructField("first", T.IntegerType()), T.StructField("past", T.IntegerType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("clean_text", T.StringType()),
])
_ARROW = [pa.field("n_words", pa.int64()),
          pa.field("hit_spans", pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))),
          pa.field("items", pa.list_(pa.string())), pa.field("clean_text", pa.string())]


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (size, hash, phrase, item) of a benchmark (item_id, text)."""
    table = word_table(STOPS)

    def windows(batches):
        for batch in batches:
            items = batch.column("item").to_pylist()
            out = {"size": [], "hash": [], "phrase": [], "item": []}
            for start, texts in chunks(batch.column("text").to_pylist()):
                for i, text in enumerate(texts):
                    words = split_words([text], table)
                    size = min(window, len(words.starts))
                    if not size:
                        continue
                    first, hashes = words.windows(size)
                    out["size"] += [size] * len(first)
                    out["hash"] += hashes.view(np.int64).tolist()
                    out["phrase"] += [words.phrase(j, size) for j in first.tolist()]
                    out["item"] += [items[start + i]] * len(first)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("size", pa.int32()), ("hash", pa.int64()), ("phrase", pa.binary()), ("item", pa.string())]))

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return rows.mapInArrow(windows, "size int, hash long, phrase binary, item string").distinct()


def _runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last of every run of true values."""
    edges = np.diff(np.concatenate(([0], marked.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _in_order(items: set[str | None]) -> list[str | None]:
    """Ids in order, null last."""
    return sorted(items, key=lambda item: (item is None, item or ""))


def _without(text: bytes, words: Words, k: int, low: int, runs: list[tuple[int, int]]) -> bytes:
    """Text ``k``, whose first word is ``low``, without the runs of its words."""
    base, clean, at = words.offsets[k], [], 0
    for a, b in runs:
        clean.append(text[at:words.starts[low + a] - base])
        at = words.ends[low + b - 1] - base
    clean.append(text[at:])
    return b"".join(clean)


class _Scan:
    """Looks up the windows of texts in a block of benchmark windows."""

    def __init__(self, rows: list):
        self.by_size: dict[int, np.ndarray] = {}
        self.phrases: dict[bytes, list[str | None]] = {}
        hashes: dict[int, list[int]] = {}
        for size, value, phrase, item in rows:
            hashes.setdefault(size, []).append(value)
            self.phrases.setdefault(bytes(phrase), []).append(item)
        for size, values in hashes.items():
            self.by_size[size] = np.unique(np.array(values, np.int64).view(np.uint64))
        self.table = word_table(STOPS)

    def texts(self, texts: list[bytes]):
        """(number of words, hit runs of words, items, clean text) of each text."""
        words = split_words(texts, self.table)
        bounds = np.searchsorted(words.text, np.arange(len(texts) + 1))
        cover = np.zeros(len(words.starts) + 1, np.int64)
        items: dict[int, set[str | None]] = {}
        for size, known in self.by_size.items():
            first, hashes = words.windows(size)
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            for i in first[known[at] == hashes].tolist():
                found = self.phrases.get(words.phrase(i, size))
                if found:
                    cover[i] += 1
                    cover[i + size] -= 1
                    items.setdefault(int(words.text[i]), set()).update(found)
        hit = np.cumsum(cover)[:-1] > 0
        for k, text in enumerate(texts):
            low, high = bounds[k], bounds[k + 1]
            if k not in items:
                yield high - low, [], [], text
                continue
            first, past = _runs(hit[low:high])
            runs = list(zip(first.tolist(), past.tolist()))
            yield high - low, runs, _in_order(items[k]), _without(text, words, k, low, runs)


def _scanned(docs: DataFrame, block: DataFrame, clean: bool) -> DataFrame:
    """``docs`` with the columns of ADDED for one block of windows, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in block.collect()])
    base = docs.drop(*ADDED.names)
    schema = T.StructType(base.schema.fields + ADDED.fields)

    def scan(batches):
        look = _Scan(shared.value)
        for batch in batches:
            words, spans, items, cleaned = [], [], [], []
            texts = batch.column("text").to_pylist()
            for _, part in chunks(texts):
                for n, runs, found, rest in look.texts(part):
                    words.append(n)
                    spans.append([{"first": a, "past": b} for a, b in runs])
                    items.append(found)
                    cleaned.append(rest.decode("utf-8", "surrogatepass") if clean else None)
            added = [pa.array(v, f.type) for v, f in zip((words, spans, items, cleaned), _ARROW)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], schema=pa.schema([*batch.schema, *_ARROW]))

    return base.mapInArrow(scan, schema)


def _blocks(windows: DataFrame, block_windows: int, block_bytes: int) -> int:
    """Number of blocks in which windows are broadcast."""
    size = F.length("phrase") + F.coalesce(F.length("item"), F.lit(0)) + 16
    count, total = windows.agg(F.count("*"), F.sum(size)).first()
    return max(1, math.ceil(count / block_windows), math.ceil((total or 0) / block_bytes))


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                      block_windows: int = BLOCK_WINDOWS, block_bytes: int = BLOCK_BYTES,
                      clean: bool = False) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (word ranges inside benchmark windows), ``items``
    (ids as text of the items found) and, if ``clean``, ``clean_text`` (the text without those ranges).
    """
    spark = docs.sparkSession
    small_batches(spark)
    windows = benchmark_windows(benchmark, window)
    blocks = _blocks(windows, block_windows, block_bytes)
    if blocks == 1:
        return _scanned(docs, windows, clean)
    parts = None
    for k in range(blocks):
        part = _scanned(docs.select("doc_id", "text"), windows.where(F.pmod(F.xxhash64("phrase", "item"), F.lit(blocks)) == k), False)
        parts = part if parts is None else parts.unionByName(part)
    merged = parts.groupBy(F.col("doc_id").alias("doc2"), F.xxhash64("text").alias("hash2")).agg(
        F.first("n_words").alias("n_words"), F.flatten(F.collect_list("hit_spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns if c not in ADDED.names]).alias("row"),
                       F.col("doc_id").alias("doc"), F.xxhash64("text").alias("hash"))
    marked = rows.join(merged, F.col("doc").eqNullSafe(F.col("doc2")) & (F.col("hash") == F.col("hash2"))).select(
        "row.*", "n_words", _joined_spans("spans").alias("hit_spans"), "items",
        F.lit(None).cast("string").alias("clean_text"))
    return _cut(marked) if clean else marked


def _cut(marked: DataFrame) -> DataFrame:
    """``marked`` with ``clean_text``, the text without its ``hit_spans``, in one scan."""
    table = word_table(STOPS)
    base = marked.drop("clean_text")

    def scan(batches):
        for batch in batches:
            spans, cleaned = batch.column("hit_spans").to_pylist(), []
            for start, part in chunks(batch.column("text").to_pylist()):
                words = split_words(part, table)
                bounds = np.searchsorted(words.text, np.arange(len(part)))
                for k, text in enumerate(part):
                    runs = [(s["first"], s["past"]) for s in spans[start + k]]
                    cleaned.append(_without(text, words, k, bounds[k], runs).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cleaned, _ARROW[-1].type)],
                                             schema=pa.schema([*batch.schema, _ARROW[-1]]))

    return base.mapInArrow(scan, T.StructType([*base.schema.fields, ADDED["clean_text"]]))


def _joined_spans(spans: str):
    """Spans in order, those that meet or overlap as one."""
    def add(done, s):
        last = F.element_at(done, -1)
        wider = F.struct(last["first"].alias("first"), F.greatest(last["past"], s["past"]).alias("past"))
        return F.when((F.size(done) > 0) & (last["past"] >= s["first"]),
                      F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))).otherwise(F.concat(done, F.array(s)))
    return F.aggregate(F.array_sort(spans), F.array().cast(ADDED["hit_spans"].dataType), add)


def n_hit(spans: str = "hit_spans"):
    """Number of words in the given runs."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["past"] - s["first"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any benchmark window, with all their columns."""
    return filtered(docs, ADDED.names, lambda rows: mark_contaminated(rows, benchmark, **options).where(F.size("items") == 0))


def cut_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """All documents, their texts without the benchmark windows (null becomes empty)."""
    marked = mark_contaminated(docs, benchmark, clean=True, **options)
    return marked.withColumn("text", F.col("clean_text")).select(*docs.columns)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    marked = mark_contaminated(read(spark, sf_dir, "documents").select("doc_id", "text"),
                               read(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit() > 0).alias("contaminated"))


OP7_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
sized AS (SELECT item, w, least(len(w), 10) AS k FROM item_words WHERE len(w) > 0),
places AS (SELECT item, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM sized),
item_windows AS (SELECT DISTINCT item, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase FROM places),
doc_places AS (
  SELECT d.doc_id, d.w, s.k, unnest(generate_series(1, len(d.w) - s.k + 1)) AS i
  FROM doc_words d JOIN (SELECT DISTINCT k FROM sized) s ON len(d.w) >= s.k),
hits AS (
  SELECT d.doc_id, d.i, d.k, b.item
  FROM (SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase FROM doc_places) d
  JOIN item_windows b ON b.k = d.k AND b.phrase = d.phrase),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hits))
  GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words h ON d.doc_id = h.doc_id LEFT JOIN hit_items i ON d.doc_id = i.doc_id
"""
