"""Alignment of two tokenizers, with corpus-wide counts of linked tokens by external spill counting.

A text is encoded by A (byte-level BPE, of a blank and the text) and by B (pieces,
which adds the blank itself). Byte offsets where tokens of both end cut both into
groups; the tokens of A and B that end a group are linked. How often a pair of
ids is linked in all texts, and which A a B is linked with most, needs counts of pairs
that no task can hold:

1. a task collects links up to ``RUN_LINKS``, sorts them by (B, A, document) and
   cuts the run by the radix of B into ``CLASSES`` blocks: records of pair, document
   and number, delta-coded by byte planes and pressed by zstd. Blocks are spilled
   to a table in the shared folder;
2. blocks meet by (class, salt), in order of their first pair. The salt is a run's own
   and their number grows with the input, so a B with a third of all links is
   spread over as many tasks. A k-way heap merge of blocks, each a cursor over its
   pairs, counts each pair in B-major order; it holds the blocks that overlap;
3. counts of the salts are summed, which gives each pair's total and each B's
   largest;
4. each (class, salt) gets the totals of its own pairs, in the same order, and
   streams its blocks past them: every record's contribution is added up by document
   inside the block, then over blocks.

Defined cases: null and empty texts, and texts whose tokens don't spell them (B
writes U+2581 as a blank), have no tokens, zeros and an empty digest; rows that repeat a
doc_id are documents of their own; null doc_ids pass through; other columns are
not used; an empty table gives no rows. A long text is taken in parts that end
before a blank, where tokens of both end, and its links are held until all of it is
known to be spelled.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import sentencepiece
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowloom.llm.bpe_transducer import Encoder, Merges, read_merges
from flowloom.llm.common import pack, read, tidy_shuffles, unpack
from flowloom.plans.lineage import as_table

SIDE_A = "byte_bpe_50k.json"
SIDE_B = "piece_bpe_32k.model"
RUN_LINKS = 4_000_000
CLASSES = 16
SALT_CHARS = 128_000_000
TEXT_PART = 1 << 18
TEXTS_AT_ONCE = 512
CHARS_AT_ONCE = 1 << 20
PAIRS_AT_ONCE = 100_000
BLANK = "▁"
A_BITS = 32


class Pieces:
    """A sentencepiece model in a task: ids of texts, and the bytes of each id."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes = [self._bytes(i) for i in range(self.model.vocab_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(BLANK, " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def text_parts(text: str, size: int) -> list[str]:
    """The text in parts of about ``size``, cut at blanks between other characters than white space; the blank
    goes, as both encoders put it back."""
    parts, start = [], 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while 0 < at < len(text) - 1 and (text[at - 1].isspace() or text[at + 1].isspace()):
            at = text.find(" ", at + 1)
        if not 0 < at < len(text) - 1:
            break
        parts.append(text[start:at])
        start = at + 1
    return [*parts, text[start:]]


class Aligner:
    """Aligns texts: ids of both sides, and which of them end groups."""

    def __init__(self, merges: Merges, model: bytes, part: int = TEXT_PART):
        self.a, self.b, self.part = Encoder(merges), Pieces(model), part
        self.a.special = None  # their strings are plain text
        self.a_sizes = np.array([len(t or b"") for t in merges.tokens], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b.bytes], np.int64)
        names = [f"{i}{mark}" for i in range(len(self.a_sizes)) for mark in ",|"]
        self.b_names = len(names)
        self.names = np.array(names + [f"{i}{mark}" for i in range(len(self.b_sizes)) for mark in ",;"], object)

    def texts(self, texts: list[str]) -> Iterator[list[tuple] | None]:
        """For each text its parts (a ids, b ids, places in them where groups end), or None without tokens."""
        self.a.warm(texts)
        parts = [text_parts(text, self.part) if text else [] for text in texts]
        encoded = iter(self.b.encode([p for of in parts for p in of]))
        for of in parts:
            aligned = [self._aligned(p, next(encoded)) for p in of]
            yield aligned if aligned and all(aligned) else None

    def _aligned(self, text: str, b: list[int]):
        data = " " + text
        if b"".join(map(self.b.bytes.__getitem__, b)) != data.encode():
            return None
        a = np.frombuffer(b"".join(self.a.segment(data)), "<u4")
        b = np.array(b, np.uint32)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        if a_ends[-1] != b_ends[-1]:
            return None
        marked = np.zeros(a_ends[-1] + 1, bool)
        marked[a_ends] = True
        b_last = np.flatnonzero(marked[b_ends])
        marked[:] = False
        marked[b_ends] = True
        return a, b, np.flatnonzero(marked[a_ends]), b_last

    def spelled(self, a, b, a_last, b_last) -> str:
        """``a1,a2|b1;...`` of a part, with a mark at the end."""
        a_group = np.searchsorted(a_last, np.arange(len(a)))
        b_group = np.searchsorted(b_last, np.arange(len(b)))
        codes = np.empty(len(a) + len(b), np.int64)
        ends_a, ends_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        ends_a[a_last] = ends_b[b_last] = True
        codes[np.arange(len(a)) + np.concatenate(([0], b_last + 1))[a_group]] = 2 * a.astype(np.int64) + ends_a
        codes[np.arange(len(b)) + (a_last + 1)[b_group]] = self.b_names + 2 * b.astype(np.int64) + ends_b
        return "".join(self.names[codes].tolist())


class Run:
    """Links of documents, up to a run's size."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.rows: list[int] = []
        self.size = 0

    def add(self, row: int, keys: np.ndarray) -> None:
        self.keys.append(keys)
        self.docs.append(np.full(len(keys), len(self.rows), np.uint32))
        self.rows.append(row)
        self.size += len(keys)

    def blocks(self, salts: int) -> Iterator[tuple[int, int, int, bytes]]:
        """(class, salt, first pair, payload) of the sorted run, by the radix of B. A payload holds row numbers,
        pairs, how many documents each has, documents and how often they hold the pair."""
        keys, docs = np.concatenate(self.keys), np.concatenate(self.docs)
        order = np.lexsort((docs, keys))
        keys, docs = keys[order], docs[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
        at = np.flatnonzero(new)
        keys, docs, n = keys[at], docs[at], np.diff(at, append=len(new)).astype("<u4")
        rows = np.diff(np.array(self.rows, np.int64), prepend=0).view(np.uint64)
        salt = xxhash.xxh32_intdigest(self.rows[0].to_bytes(8, "little")) % salts
        classes = (keys >> np.uint64(A_BITS)) % np.uint64(CLASSES)
        for place in range(CLASSES):
            mine = classes == place
            if mine.any():
                pairs, many = np.unique(keys[mine], return_counts=True)
                yield place, salt, int(pairs[0]), pack(
                    rows, np.diff(pairs, prepend=np.uint64(0)), many.astype("<u4"), docs[mine].astype("<u4"), n[mine])


class Block:
    """An unpacked block."""

    def __init__(self, data: bytes):
        rows, pairs, self.many, self.docs, self.n = unpack(data)
        self.rows, self.pairs = np.cumsum(rows.view(np.int64)), np.cumsum(pairs, dtype=np.uint64)
        self.totals = np.add.reduceat(self.n.astype(np.int64), np.cumsum(self.many, dtype=np.int64) - self.many)


def merged(blocks: Iterator[tuple]) -> Iterator[tuple]:
    """(part, pair, total) of (part, first pair, pairs, totals), given by part and first pair: a heap of cursors,
    of which a block is dropped when its last pair has been counted."""
    heap: list[list] = []
    current = None

    def pop(until):
        while heap and (until is None or heap[0][0] < until):
            pair, total = heap[0][0], 0
            while heap and heap[0][0] == pair:
                top = heap[0]
                total += top[4][top[2]]
                top[2] += 1
                if top[2] < len(top[3]):
                    top[0] = top[3][top[2]]
                    heapq.heapreplace(heap, top)
                else:
                    heapq.heappop(heap)
            yield current, pair, total

    for number, (part, first, pairs, totals) in enumerate(blocks):
        if part != current:
            yield from pop(None)
            current = part
        yield from pop(first)
        heapq.heappush(heap, [first, number, 0, pairs, totals])
    yield from pop(None)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of so many texts and characters at most, a long text by itself."""
    sizes = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and (held + size > CHARS_AT_ONCE or i - start == TEXTS_AT_ONCE):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(batch):
        yield batch.slice(start)


def spill(docs: DataFrame, merges: Merges, model: bytes, salts: int, run_links: int = RUN_LINKS,
          part: int = TEXT_PART) -> DataFrame:
    """Rows of documents (row, doc_id, n_a, n_b, n_links, groups_sha256) and of blocks (class, salt, first, payload)."""
    shared = docs.sparkSession.sparkContext.broadcast((merges, model))
    numbered = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        aligner, links = Aligner(*shared.value, part), Run()
        schema = None

        def rows(columns):
            some = next(iter(columns.values()))
            return pa.RecordBatch.from_arrays([
                pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(some), f.type) for f in schema], schema=schema)

        def spilled():
            names = ("class", "salt", "first", "payload")
            for block in links.blocks(salts):
                yield rows({c: [v] for c, v in zip(names, block)})

        for batch in batches:
            schema = schema or pa.schema([
                ("row", pa.int64()), ("doc_id", batch.schema.field("doc_id").type), ("n_a", pa.int64()), ("n_b", pa.int64()),
                ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("class", pa.int32()), ("salt", pa.int32()),
                ("first", pa.int64()), ("payload", pa.binary())])
            for piece in slices(batch):
                out = {c: [] for c in ("row", "doc_id", "n_a", "n_b", "n_links", "groups_sha256")}
                numbers = piece.column("row").to_pylist()
                for row, doc_id, parts in zip(numbers, piece.column("doc_id").to_pylist(),
                                              aligner.texts([t or "" for t in piece.column("text").to_pylist()])):
                    digest, count = hashlib.sha256(), [0, 0, 0]
                    for i, (a, b, a_last, b_last) in enumerate(parts or []):
                        text = aligner.spelled(a, b, a_last, b_last)
                        digest.update(text.encode() if i + 1 < len(parts) else text[:-1].encode())
                        count = [x + len(y) for x, y in zip(count, (a, b, a_last))]
                    for c, v in zip(out, (row, doc_id, *count, digest.hexdigest() if parts else "")):
                        out[c].append(v)
                    if parts:
                        links.add(row, np.concatenate([
                            b[b_last].astype(np.uint64) << np.uint64(A_BITS) | a[a_last] for a, b, a_last, b_last in parts]))
                        if links.size >= run_links:
                            yield from spilled()
                            links = Run()
                yield rows(out)
        if links.size:
            yield from spilled()

    return numbered.mapInArrow(
        run, f"row long, doc_id {kind}, n_a long, n_b long, n_links long, groups_sha256 string, class int, salt int, "
             "first long, payload binary")


def pair_parts(blocks: DataFrame) -> DataFrame:
    """(class, salt, pair, n): how often each pair is linked in the blocks of a class and salt."""

    def read_blocks(batches):
        for batch in batches:
            for place, salt, first, payload in zip(*[batch.column(c) for c in ("class", "salt", "first", "payload")]):
                block = Block(payload.as_py())
                yield (place.as_py(), salt.as_py()), first.as_py(), block.pairs.tolist(), block.totals.tolist()

    def rows(held):
        parts, pairs, totals = zip(*held)
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.int32()),
             pa.array(pairs, pa.int64()), pa.array(totals, pa.int64())], names=["class", "salt", "pair", "n"])

    def count(batches):
        held = []
        for counted in merged(read_blocks(batches)):
            held.append(counted)
            if len(held) >= PAIRS_AT_ONCE:
                yield rows(held)
                held = []
        if held:
            yield rows(held)

    together = blocks.select("class", "salt", "first", "payload").repartition("class", "salt")
    return together.sortWithinPartitions("class", "salt", "first").mapInArrow(count, "class int, salt int, pair long, n long")


def pair_totals(parts: DataFrame) -> DataFrame:
    """(pair, a, b, n, best): each pair's total, and whether it is the largest of its B (ties are)."""
    totals = parts.groupBy("pair").agg(F.sum("n").alias("n")).select(
        "pair", F.col("pair").bitwiseAND(F.lit((1 << A_BITS) - 1)).alias("a"), F.shiftright("pair", A_BITS).alias("b"), "n")
    most = totals.groupBy("b").agg(F.max("n").alias("most"))
    return totals.join(most, "b").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def contributions(blocks: DataFrame, parts: DataFrame, totals: DataFrame) -> DataFrame:
    """(row, n_best, count_sum) of every document that has links."""
    known = parts.join(totals.select("pair", F.col("n").alias("total"), "best"), "pair").select(
        "class", "salt", F.lit(0).alias("kind"), F.col("pair").alias("first"), "total", "best",
        F.lit(None).cast("binary").alias("payload"))
    both = known.unionByName(blocks.select(
        "class", "salt", F.lit(1).alias("kind"), "first", F.lit(None).cast("long").alias("total"),
        F.lit(None).cast("boolean").alias("best"), "payload"))

    def stream(batches):
        current, held, table = None, [], None
        for batch in batches:
            part = batch.column("class").to_numpy().astype(np.int64) << 32 | batch.column("salt").to_numpy()
            kinds = batch.column("kind").to_numpy()
            edges = np.flatnonzero((part[1:] != part[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(batch)]):
                rows = batch.slice(start, end - start)
                if not len(rows):
                    continue
                if part[start] != current:
                    current, held, table = part[start], [], None
                if kinds[start] == 0:
                    held.append([rows.column(c).to_numpy(zero_copy_only=False) for c in ("first", "total", "best")])
                    continue
                if table is None:
                    table, held = [np.concatenate(c) for c in zip(*held)], []
                for payload in rows.column("payload"):
                    block = Block(payload.as_py())
                    at = np.repeat(np.searchsorted(table[0], block.pairs.view(np.int64)), block.many)
                    n = block.n.astype(np.int64)
                    best, total = np.zeros(len(block.rows), np.int64), np.zeros(len(block.rows), np.int64)
                    np.add.at(best, block.docs, n * table[2][at].astype(bool))
                    np.add.at(total, block.docs, n * table[1][at].astype(np.int64))
                    some = np.flatnonzero(total)
                    yield pa.RecordBatch.from_arrays([pa.array(block.rows[some]), pa.array(best[some]), pa.array(total[some])],
                                                     names=["row", "n_best", "count_sum"])

    ordered = both.repartition("class", "salt").sortWithinPartitions("class", "salt", "kind", "first")
    return ordered.mapInArrow(stream, "row long, n_best long, count_sum long").groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def _spilled(docs: DataFrame, merges: Merges, model: bytes, salt_chars: int, run_links: int, part: int) -> DataFrame:
    docs = docs.select("doc_id", "text")
    chars = docs.agg(F.sum(F.char_length("text"))).first()[0] or 0
    return as_table(spill(docs, merges, model, 1 + chars // salt_chars, run_links, part), "alignment-runs")


def linked_pairs(docs: DataFrame, merges: Merges, model: bytes, salt_chars: int = SALT_CHARS,
                 run_links: int = RUN_LINKS) -> DataFrame:
    """(a, b, n, best) of every pair of ids that is linked somewhere in ``docs`` (doc_id, text)."""
    blocks = _spilled(docs, merges, model, salt_chars, run_links, TEXT_PART).where("payload is not null")
    return pair_totals(as_table(pair_parts(blocks), "pair-parts")).drop("pair")


def groups(docs: DataFrame, merges: Merges, model: bytes) -> DataFrame:
    """(doc_id, groups) of every row of ``docs``: ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
    shared = docs.sparkSession.sparkContext.broadcast((merges, model))

    def run(batches):
        aligner = Aligner(*shared.value)
        for batch in batches:
            for piece in slices(batch):
                spelled = ["".join(aligner.spelled(*p) for p in parts or [])[:-1]
                           for parts in aligner.texts([t or "" for t in piece.column("text").to_pylist()])]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(spelled, pa.string())],
                                                 names=["doc_id", "groups"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, groups string")


def align(docs: DataFrame, merges: Merges, model: bytes, salt_chars: int = SALT_CHARS, run_links: int = RUN_LINKS,
          part: int = TEXT_PART) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs`` (doc_id, text)."""
    with tidy_shuffles(docs.sparkSession):
        spilled = _spilled(docs, merges, model, salt_chars, run_links, part)
        blocks = spilled.where("payload is not null")
        parts = as_table(pair_parts(blocks), "pair-parts")
        totals = as_table(pair_totals(parts), "pair-totals")
        sums = as_table(contributions(blocks, parts, totals), "contributions")
    return spilled.where("payload is null").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")


def op11_token_alignment(spark: SparkSession, sf_dir: str, a: str | None = None, b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    with open(b or public_tokenizers.path(SIDE_B), "rb") as file:
        model = file.read()
    return align(read(spark, sf_dir, "documents"), read_merges(a or public_tokenizers.path(SIDE_A)), model)
