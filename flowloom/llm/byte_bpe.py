"""Byte-level BPE by a global shuffle of distinct words.

A text's pre-tokens (the matches of a pattern) are its words, in order. Each
distinct word of the corpus is encoded once:

1. words are counted within tasks and summed; the most frequent, at most
   ``hot``, are encoded and broadcast with their ids, so that the keys that hold
   most rows need no shuffle;
2. all other words are exploded with the block of documents they stand in and
   shuffled by the word: each distinct one is encoded once, and its ids go back
   to every block that has it;
3. a document's words travel to its block as a stream in order of position: the
   number of a hot word, or a mark and the hash of another one. There the ids
   of the block's words are joined in and put together by position.

Blocks take documents by a hash, about ``BLOCK_CHARS`` characters each, so that
a block's words fit in memory; a longer text is one block's load by itself.
Decoding joins ids with the token-byte table, which has as many rows as the
vocabulary and is broadcast; it can follow in the worker that puts ids together.

Cutting a text before a blank that follows other than white space parts no
match of the pattern; so words are found once for each distinct piece between
blanks, not once for each place.

Defined cases: null is empty and has no ids; rows that repeat a doc_id are
encoded each; a null doc_id passes through; other columns are not used.
"""

from __future__ import annotations

import base64
from collections import Counter
from struct import pack

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowloom.llm.common import least_count, read, small_batches, tidy_shuffles
from flowloom.plans.lineage import as_table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
HOT = 1 << 18
BLOCK_CHARS = 4_000_000
COUNTED_AT_ONCE = 300_000
PACKED_AT_ONCE = 200_000
SENT_AT_ONCE = 4 << 20
CACHED = 150_000
SEEN = 3
OTHER = 0xFFFFFFFF
# White space of the pattern that is rare, in ASCII and beyond; marks that end words, none of which
# begins a match with what may follow.
RARE_WHITE = "\t\x0b\x0c\r"
OTHER_WHITE = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
MARKS = frozenset(".,;:!?")


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank of each token's bytes, from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Cutter:
    """Cuts texts into pieces that hold whole matches of a pattern, and pieces into matches (words)."""

    def __init__(self, pattern: str):
        self.pattern = regex.compile(pattern)
        self.cut = regex.compile(r"(?<=\S)(?= )")

    def pieces(self, text: str) -> tuple[str, list[str]]:
        """The first piece, and the others, each without the blank that it begins with."""
        if "  " in text or "\n " in text or any(c in text for c in RARE_WHITE) or not text.isascii() and any(
                c in text for c in OTHER_WHITE):
            first, *rest = self.cut.split(text)
            return first, [piece[1:] for piece in rest]
        rest = text.split(" ")
        return rest.pop(0), rest

    def words(self, piece: str) -> list[str]:
        return self.pattern.findall(piece)

    def after_blank(self, piece: str) -> list[str]:
        """Words of a piece given without its blank; letters, and letters with one mark, need no search."""
        if piece.isalpha():
            return [" " + piece]
        if piece[-1:] in MARKS and piece[:-1].isalpha():
            return [" " + piece[:-1], piece[-1]]
        return self.pattern.findall(" " + piece)


def _blocked(docs: DataFrame, blocks: int) -> DataFrame:
    """``docs`` (doc_id, text) with the block of each row."""
    return docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"))


def frequent_words(docs: DataFrame, pattern: str) -> DataFrame:
    """(word, n) of the words that occur ``SEEN`` times among the pieces counted at once, from all texts."""

    def count(batches):
        cutter, pieces, firsts = Cutter(pattern), Counter(), Counter()

        def flush():
            words = Counter()
            for piece, n in firsts.items():
                for word in cutter.words(piece):
                    words[word] += n
            for piece, n in pieces.items():
                if n > 1:  # of a piece seen once the words are rarely frequent
                    for word in cutter.after_blank(piece):
                        words[word] += n
            often = [(w, n) for w, n in words.items() if n >= SEEN]
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in often], pa.string()), pa.array([n for _, n in often], pa.int64())],
                names=["word", "n"])

        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    first, rest = cutter.pieces(text)
                    firsts[first] += 1
                    pieces.update(rest)
            if len(pieces) + len(firsts) > COUNTED_AT_ONCE:
                yield flush()
                pieces, firsts = Counter(), Counter()
        yield flush()

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _encoder(ranks: dict[bytes, int]):
    """Ids of a word, packed; the word is taken whole."""
    whole = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})

    def ids(word):
        found = whole.encode_ordinary(word)
        return pack(f"<{len(found)}I", *found)
    return ids


class _HotIds:
    """The ids of the words that are broadcast, most frequent first."""

    def __init__(self, ids: list[bytes]):
        self.sizes = np.array([len(i) // 4 for i in ids], np.int64)
        self.ids = np.frombuffer(b"".join(ids), "<u4")


class _HotWords:
    """The words themselves, for tasks that look for them."""

    def __init__(self, words: list[str]):
        self.words = words

    def places(self) -> dict[str, int]:
        return {w: i for i, w in enumerate(self.words)}


def hot_words(docs: DataFrame, ranks, pattern: str, hot: int) -> tuple[_HotWords, _HotIds]:
    """At most ``hot`` of the most frequent words, each encoded once."""
    counts = as_table(frequent_words(docs, pattern), "word-counts")

    def encode_all(batches):
        encoded = _encoder(ranks.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(map(encoded, batch.column("word").to_pylist())), pa.binary())],
                names=["word", "n", "ids"])

    often = counts.where(F.col("n") >= least_count(counts, hot))
    table = often.mapInArrow(encode_all, "word string, n long, ids binary").toArrow()
    table = table.sort_by([("n", "descending"), ("word", "ascending")])
    return _HotWords(table.column("word").to_pylist()), _HotIds(table.column("ids").to_pylist())


def _other_words(docs: DataFrame, pattern: str, hot) -> DataFrame:
    """(word, block) of the words that aren't hot, each once for a batch of documents."""

    def explode(batches):
        cutter, known = Cutter(pattern), set(hot.value.words)
        plain: set[str] = set()
        for batch in batches:
            found = set()
            for text, block in zip(batch.column("text").to_pylist(), batch.column("block").to_pylist()):
                first, rest = cutter.pieces(text or "")
                found.update((w, block) for w in cutter.words(first) if w not in known)
                for piece in set(rest).difference(plain):
                    others = [w for w in cutter.after_blank(piece) if w not in known]
                    if others:
                        found.update((w, block) for w in others)
                    elif len(plain) < CACHED:
                        plain.add(piece)
            words, blocks = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(blocks, pa.int32())], names=["word", "block"])

    return docs.select("text", "block").mapInArrow(explode, "word string, block int")


def _hash(word: str) -> int:
    """62 bits, in two halves that are no mark."""
    value = xxhash.xxh64_intdigest(word)
    return (value >> 33) << 32 | value & 0x7FFFFFFF


def _encoded_others(others: DataFrame, ranks) -> DataFrame:
    """(block, payload): hashes, sizes and ids of a block's words, many to a row.

    Equal words come together, each is encoded once, and its ids go with every block that has it.
    """

    def encode_all(batches):
        encoded = _encoder(ranks.value)
        last, value, ids = None, 0, b""
        held: dict[int, tuple[list, list]] = {}
        many = 0

        def flush():
            rows = [len(h).to_bytes(4, "little") + np.array(h, np.uint64).tobytes() + zstandard.compress(
                np.array([len(i) // 4 for i in parts], "<u4").tobytes() + b"".join(parts), 3)
                for h, parts in held.values()]
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(rows, pa.binary())],
                                              names=["block", "payload"])
        for batch in batches:
            for word, block in zip(batch.column("word").to_pylist(), batch.column("block").to_pylist()):
                if word != last:
                    last, value, ids = word, _hash(word), encoded(word)
                hashes, parts = held.setdefault(block, ([], []))
                hashes.append(value)
                parts.append(ids)
                many += 1
            if many > PACKED_AT_ONCE:
                yield flush()
                held, many = {}, 0
        yield flush()

    return others.repartition("word").sortWithinPartitions("word").mapInArrow(encode_all, "block int, payload binary")


def _streams(docs: DataFrame, pattern: str, hot) -> DataFrame:
    """(block, doc_id, payload): the words of each document in order, hot ones as their number, others as
    a mark and the halves of their hash."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    class Codes(dict):
        """Packed numbers of the words of a piece that follows a blank."""

        def __init__(self, cutter, places):
            super().__init__()
            self.cutter, self.places = cutter, places

        def of(self, words):
            out = []
            for word in words:
                place = self.places.get(word)
                if place is None:
                    value = _hash(word)
                    out += [OTHER, value & 0xFFFFFFFF, value >> 32]
                else:
                    out.append(place)
            return pack(f"<{len(out)}I", *out)

        def __missing__(self, piece):
            found = self.of(self.cutter.after_blank(piece))
            if len(self) < CACHED:
                self[piece] = found
            return found

    def write(batches):
        cutter = Cutter(pattern)
        codes, press = Codes(cutter, hot.value.places()), zstandard.ZstdCompressor(level=3)
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                first, rest = cutter.pieces(text or "")
                numbers = codes.of(cutter.words(first)) + b"".join(map(codes.__getitem__, rest))
                out.append(press.compress(np.frombuffer(numbers, np.uint8).reshape(-1, 4).T.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("doc_id"), pa.array(out, pa.binary())],
                names=["block", "doc_id", "payload"])

    return docs.mapInArrow(write, f"block int, doc_id {kind}, payload binary")


class _Block:
    """The ids of one block's own words, found by hash."""

    def __init__(self, payloads: list[bytes]):
        hashes, sizes, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for data in payloads:
            n = int.from_bytes(data[:4], "little")
            rest = np.frombuffer(zstandard.decompress(data[4 + 8 * n:]), "<u4")
            hashes.append(np.frombuffer(data, np.uint64, n, 4))
            sizes.append(rest[:n].astype(np.int64))
            ids.append(rest[n:])
        hashes, self.sizes, self.ids = np.concatenate(hashes), np.concatenate(sizes), np.concatenate(ids)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes, self.starts = hashes[self.order], np.cumsum(self.sizes) - self.sizes

    def find(self, wanted: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.hashes, wanted)
        if len(wanted) and (len(self.hashes) == 0 or (self.hashes[np.minimum(at, len(self.hashes) - 1)] != wanted).any()):
            raise ValueError("a word of the block has no ids")
        return self.order[at]


def _put_together(payload: bytes, hot: _HotIds, hot_starts: np.ndarray, own: _Block) -> np.ndarray:
    """Ids of a document from its stream."""
    planes = np.frombuffer(zstandard.decompress(payload), np.uint8).reshape(4, -1)
    codes = np.ascontiguousarray(planes.T).view("<u4").ravel()
    marks = np.flatnonzero(codes == OTHER)
    if not len(marks):
        sizes, starts = hot.sizes[codes], hot_starts[codes]
    else:
        found = own.find(codes[marks + 1].astype(np.uint64) | codes[marks + 2].astype(np.uint64) << np.uint64(32))
        word = np.ones(len(codes), bool)
        word[marks + 1] = word[marks + 2] = False
        safe = np.where(codes == OTHER, 0, codes) if len(hot.sizes) else np.zeros(len(codes), np.int64)
        safe[~word] = 0
        sizes = hot.sizes[safe] if len(hot.sizes) else np.zeros(len(codes), np.int64)
        starts = hot_starts[safe] if len(hot.sizes) else np.zeros(len(codes), np.int64)
        sizes[marks], starts[marks] = own.sizes[found], own.starts[found] + len(hot.ids)
        sizes, starts = sizes[word], starts[word]
    places = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    mine = places >= len(hot.ids)
    out = np.empty(len(places), np.uint32)
    out[~mine], out[mine] = hot.ids[places[~mine]], own.ids[places[mine] - len(hot.ids)]
    return out


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN,
           hot: int = HOT, block_chars: int = BLOCK_CHARS, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text); ids are little-endian unsigned 32-bit integers.

    With ``decoded``, ``decode`` of the ids follows in the same worker: as a step of its own it would keep a second
    one for every task.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    small_batches(spark)
    with tidy_shuffles(spark):
        table = spark.sparkContext.broadcast(ranks)
        shared, shared_ids = map(spark.sparkContext.broadcast, hot_words(docs, table, pattern, hot))
        chars = docs.agg(F.sum(F.char_length("text"))).first()[0] or 0
        blocked = _blocked(docs, max(1, -(-chars // block_chars)))
        packed = as_table(_encoded_others(_other_words(blocked, pattern, shared), table), "block-words")
    streams = _streams(blocked, pattern, shared)
    both = packed.select("block", F.lit(0).alias("part"), F.lit(None).cast(kind).alias("doc_id"), "payload").unionByName(
        streams.select("block", F.lit(1).alias("part"), "doc_id", "payload"))

    names = ["doc_id", "ids", "decoded"] if decoded else ["doc_id", "ids"]
    tokens = spark.sparkContext.broadcast(TokenBytes(ranks)) if decoded else None

    def put_together(batches):
        known = shared_ids.value
        starts = np.cumsum(known.sizes) - known.sizes
        block, parts, own = None, [], None
        ids, out, total, id_type = [], [], 0, None

        def columns():
            whole = [pa.array(ids, id_type), pa.array(out, pa.binary())]
            if decoded:
                whole.append(pa.array([tokens.value.join(i) for i in out], pa.binary()))
            return pa.RecordBatch.from_arrays(whole, names=names)

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for at, part, doc_id, payload in zip(*[batch.column(c).to_pylist() for c in batch.schema.names]):
                if at != block:
                    block, parts, own = at, [], None
                if part == 0:
                    parts.append(payload)
                    continue
                if own is None:
                    own, parts = _Block(parts), []
                ids.append(doc_id)
                out.append(_put_together(payload, known, starts, own).astype("<u4").tobytes())
                total += len(out[-1])
                if total > SENT_AT_ONCE:
                    yield columns()
                    ids, out, total = [], [], 0
            if ids:
                yield columns()
                ids, out, total = [], [], 0

    return both.repartition("block").sortWithinPartitions("block", "part").mapInArrow(
        put_together, f"doc_id {kind}, ids binary" + ", decoded binary" * decoded)


def id_arrays(encoded: DataFrame) -> DataFrame:
    """``encoded`` with ``ids`` as arrays of long."""

    def run(batches):
        for batch in batches:
            ids = [np.frombuffer(i, "<u4").astype(np.int64) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int64()))],
                                             names=["doc_id", "ids"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<long>")


class TokenBytes:
    """The token-byte table as arrays, so that a text's ids are joined with it at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.sizes = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)

    def join(self, ids: bytes) -> bytes:
        ids = np.frombuffer(ids, "<u4")
        sizes = self.sizes[ids]
        if not sizes.all():
            raise ValueError("an id is not in the token table")
        places = np.repeat(self.starts[ids] - (np.cumsum(sizes) - sizes), sizes)
        return self.bytes[places + np.arange(len(places))].tobytes()


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``: the bytes of the tokens, joined.

    Null ids are none; an id that the table doesn't have is an error.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(TokenBytes(ranks))

    def run(batches):
        table = shared.value
        for batch in batches:
            decoded = [table.join(ids or b"") for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())],
                                             names=["doc_id", "ids", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of (doc_id, ids, decoded)."""
    return decoded.select(
        "doc_id", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    ranks = read_ranks(path or public_tokenizers.path(VOCABULARY))
    return digests(encode(read(spark, sf_dir, "documents"), ranks, decoded=True))
