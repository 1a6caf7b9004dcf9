"""BPE encoding as a streaming transducer of bounded lookahead, and decoding as a state machine.

Encoding reads a text once from left to right and keeps constant memory:

1. the text is cut at special tokens, then into windows at blanks that part no
   pre-token, then into pre-tokens; a pre-token that ends inside its window is
   encoded at once (pieces between blanks are kept in a bounded cache);
2. a pre-token longer than a window is pushed through a ``Transducer`` in steps.
   It merges what it holds and emits the tokens that no continuation can change.

How far back a continuation can reach follows from the merge list alone. Compare
the merges of x with those of xy: a boundary of x is removed in only one of the
two by a merge s = (a, b) whose right part b meets an earlier difference, either
at its right end, made by a merge r of lower rank with b as left part, or inside
b, made by a merge of b's own derivation. So the farthest distance D(s) from the
end of x is the largest of D(r) + len(b) and D(m) + offset of m in b; ranks only
grow along such a chain, so one pass over the list gives every D, and their
maximum is the sufficient lookahead (``Merges.lookahead``; 118 bytes for the
50k list). Boundaries farther from the end are final, and as no merge crosses
them, the rest is encoded by itself.

A text gives one or more parts (doc_id, part, last, ids), which follow each
other; ids are little-endian unsigned 32-bit integers. Decoding joins the bytes
of tokens and turns them into text part by part; its state is the at most three
bytes of a character that isn't complete. Parts that were stored or shuffled are
brought together again by ``in_order``.

Defined cases: null is empty and gives one empty part; rows that repeat a doc_id
are encoded each; a null doc_id passes through; other columns are not used;
ids without a token are an error, bytes that are no text become U+FFFD. Besides the
text itself a task holds the cache, a window and a part. Letters, digits and white
space are those of the tokenizer's own pre-tokenizer.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from tokenizers.pre_tokenizers import ByteLevel

from flowloom.llm.common import read

VOCABULARY = "byte_bpe_50k.json"
WINDOW = 1 << 16
STEP = 4096
CACHED = 200_000
WARMED_CHARS = 1 << 21
SHORT_WORD = 48
PART_IDS = 1 << 18
FLUSH_BYTES = 4 << 20
NO_PAIR = 1 << 62
# White space that is rare, in ASCII and beyond; bytes that stand for themselves in byte-level vocabularies, the
# others being numbered from 256 on.
RARE_WHITE = "\t\x0b\x0c\r"
OTHER_WHITE = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Up to here the classes of letters and digits of all Unicode versions agree.
SETTLED = "\u0530"
#: A character of each class, put before text that goes on with that class.
CLASS_MARKS = ("a", "1", "!")


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    rest = [b for b in range(256) if b not in PRINTABLE]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Merges:
    """A byte-level merge list: ids of bytes, pairs (left id << 20 | right id) with rank << 20 | id of the
    result, bytes of every id, special tokens, and the sufficient lookahead in bytes."""

    byte_ids: list[int]
    pairs: dict[int, int]
    tokens: list[bytes | None]
    special: dict[str, int]
    lookahead: int


def build_merges(merges: list[tuple[bytes, bytes]], ids: dict[bytes, int], special: dict[str, int] | None = None) -> Merges:
    """``Merges`` of a list in order of rank; every part must be a byte or the result of an earlier merge, and
    every result must be new, which makes merging by rank the same from whichever side it is looked at."""
    made = {bytes([b]) for b in range(256)}
    reach: dict[bytes, int] = {}  # farthest D of the merges with this left part so far
    inside: dict[bytes, int] = {}  # farthest D plus offset among the merges that derive this token
    lookahead = 0
    for left, right in merges:
        if left not in made or right not in made or left + right in made:
            raise ValueError(f"not a list of merges in order of their making: {left!r} {right!r}")
        far = max(reach[right] + len(right) if right in reach else 0, inside.get(right, 0))
        reach[left] = max(reach.get(left, 0), far)
        inside[left + right] = max(far + len(left), inside.get(left, 0), len(left) + inside.get(right, 0))
        made.add(left + right)
        lookahead = max(lookahead, far)
    tokens: list[bytes | None] = [None] * (max([*ids.values(), *(special or {}).values()], default=-1) + 1)
    for token, i in ids.items():
        tokens[i] = token
    for text, i in (special or {}).items():
        tokens[i] = text.encode()
    return Merges([ids[bytes([b])] for b in range(256)],
                  {ids[a] << 20 | ids[b]: rank << 20 | ids[a + b] for rank, (a, b) in enumerate(merges)},
                  tokens, dict(special or {}), lookahead)


def read_merges(path: str) -> Merges:
    """``Merges`` of a tokenizer file of kind byte-level BPE."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    byte_of = byte_characters()

    def raw(token):
        return bytes(byte_of[c] for c in token)
    special = {}
    for token in content["added_tokens"]:
        if any(token[k] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added token with rules of its own: {token['content']}")
        special[token["content"]] = token["id"]
    ids = {raw(t): i for t, i in content["model"]["vocab"].items() if t not in special}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
    return build_merges([(raw(a), raw(b)) for a, b in pairs], ids, special)


def merge(merges: Merges, data: bytes) -> list[int]:
    """Ids of ``data``: the pair of lowest rank is merged, the leftmost one first, until none is left."""
    parts = [merges.byte_ids[b] for b in data]
    if len(parts) > 64:
        return _merge_long(merges, parts)
    get = merges.pairs.get
    ranks = [get(a << 20 | b, NO_PAIR) for a, b in zip(parts, parts[1:])]
    while ranks:
        best = min(ranks)
        if best == NO_PAIR:
            break
        i = ranks.index(best)
        parts[i] = best & 0xFFFFF
        del parts[i + 1], ranks[i]
        if i < len(ranks):
            ranks[i] = get(parts[i] << 20 | parts[i + 1], NO_PAIR)
        if i:
            ranks[i - 1] = get(parts[i - 1] << 20 | parts[i], NO_PAIR)
    return parts


def _merge_long(merges: Merges, parts: list[int]) -> list[int]:
    """As ``merge``, with a heap of pairs over a linked list."""
    get = merges.pairs.get
    after = [*range(1, len(parts)), -1]
    before = [-1, *range(len(parts) - 1)]
    heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := get(a << 20 | b)) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i, a, b = heapq.heappop(heap)
        j = after[i]
        if parts[i] != a or j < 0 or parts[j] != b:
            continue  # one of the two has been merged
        parts[i], parts[j] = rank & 0xFFFFF, -1
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
            if (r := get(parts[i] << 20 | parts[k])) is not None:
                heapq.heappush(heap, (r, i, parts[i], parts[k]))
        if (h := before[i]) >= 0 and (r := get(parts[h] << 20 | parts[i])) is not None:
            heapq.heappush(heap, (r, h, parts[h], parts[i]))
    return [p for p in parts if p >= 0]


class BatchMerger:
    """Merges many short words at once: each step merges one pair of every word, by whole arrays."""

    def __init__(self, merges: Merges):
        self.byte_ids = np.array(merges.byte_ids, np.int64)
        keys = np.array(sorted(merges.pairs), np.int64)
        found = np.array([merges.pairs[k] for k in keys.tolist()], np.int64)
        self.keys, self.ranks = np.append(keys, NO_PAIR), np.append(found >> 20, 1 << 30)
        self.results = np.zeros(len(keys) + 1, np.int64)
        self.results[found >> 20] = found & 0xFFFFF

    def _ranks(self, left: np.ndarray, right: np.ndarray, same: np.ndarray) -> np.ndarray:
        pairs = left << 20 | right
        at = np.searchsorted(self.keys, pairs)
        return np.where(same & (self.keys[at] == pairs), self.ranks[at], 1 << 30)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word; as ``merge`` of each."""
        if not words:
            return []
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        rank = np.append(self._ranks(ids[:-1], ids[1:], word[:-1] == word[1:]), 1 << 30)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank << 32 | np.arange(len(rank)), starts)
            more = best < 1 << 62
            if 2 * more.sum() <= len(more):  # words without pairs leave when they are half of all
                kept = np.repeat(more, np.diff(starts, append=len(ids)))
                done.append((word[~kept], ids[~kept]))
                ids, word, rank = ids[kept], word[kept], rank[kept]
                continue
            best = best[more]
            at = best & 0xFFFFFFFF
            ids[at] = self.results[best >> 32]
            kept = np.ones(len(ids), bool)
            kept[at + 1] = False
            at -= np.arange(len(at))  # one place is dropped after each earlier one
            ids, word, rank = ids[kept], word[kept], rank[kept]
            touched = np.concatenate((at, at[at > 0] - 1))
            after = np.minimum(touched + 1, len(ids) - 1)
            rank[touched] = self._ranks(ids[touched], ids[after], (word[touched] == word[after]) & (after > touched))
        word, ids = np.concatenate([w for w, _ in done]), np.concatenate([i for _, i in done])
        packed = ids[np.argsort(word, kind="stable")].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(word, minlength=len(words)))).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]


class Transducer:
    """Encodes one pre-token that comes in steps; holds the bytes whose tokens aren't final."""

    def __init__(self, merges: Merges, step: int = STEP):
        self.merges, self.step, self.held = merges, step, b""

    def push(self, data: bytes) -> list[int]:
        """The ids that became final."""
        self.held += data
        return self._stable() if len(self.held) > self.merges.lookahead + self.step else []

    def _stable(self) -> list[int]:
        ids, end, size = [], 0, len(self.held)
        for i in merge(self.merges, self.held):
            if size - (end + len(self.merges.tokens[i])) <= self.merges.lookahead:
                break
            ids.append(i)
            end += len(self.merges.tokens[i])
        self.held = self.held[end:]
        return ids

    def finish(self) -> list[int]:
        """The ids of what is held; the pre-token ends here."""
        data, self.held = self.held, b""
        return merge(self.merges, data)


class _Pieces(dict):
    """Packed ids of pieces that follow a blank."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        found = self.encoder.encoded(" " + piece)
        if len(self) < self.encoder.cached:
            self[piece] = found
        return found


class Encoder:
    """Encodes texts to parts of packed ids."""

    def __init__(self, merges: Merges, window: int = WINDOW, part_ids: int = PART_IDS, cached: int = CACHED):
        self.merges, self.window, self.part_bytes, self.cached = merges, window, 4 * part_ids, cached
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.cut = regex.compile(r"(?<=\S)(?= )")
        self.white = regex.compile(r"\s+")
        self.library = ByteLevel(add_prefix_space=False)
        self.special = regex.compile("|".join(map(regex.escape, sorted(merges.special, key=len, reverse=True)))) \
            if merges.special else None
        self.many = BatchMerger(merges)
        self.pieces = _Pieces(self)

    def words(self, text: str) -> list[str]:
        """Pre-tokens of ``text``."""
        if text.isascii() or max(text) < SETTLED:
            return self.pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def encoded(self, piece: str) -> bytes:
        ids = [i for word in self.words(piece) for i in merge(self.merges, word.encode())]
        return np.array(ids, "<u4").tobytes()

    def warm(self, texts: list[str]) -> None:
        """Encodes the pieces of texts that the cache lacks, all at once."""
        wanted = set().union(*(text[:WARMED_CHARS].split(" ") for text in texts)).difference(self.pieces, ("",))
        if len(self.pieces) + len(wanted) > self.cached:
            self.pieces.clear()
        pieces = [p for p in wanted if len(p) < SHORT_WORD][:self.cached]
        words = [[" " + p] if p.isascii() and p.isalpha() else self.words(" " + p) for p in pieces]
        distinct = list({w for of in words for w in of})
        ids = dict(zip(distinct, self.many.merge([w.encode() for w in distinct])))
        self.pieces.update(zip(pieces, (b"".join([ids[w] for w in of]) for of in words)))

    def _window(self, text: str) -> bytes:
        """Ids of text that ends where a pre-token ends."""
        if "  " in text or "\n " in text or any(c in text for c in RARE_WHITE) or not text.isascii() and any(
                c in text for c in OTHER_WHITE):
            first, *rest = self.cut.split(text)
            rest = [piece[1:] for piece in rest]
        else:
            first, *rest = text.split(" ")
        return self.encoded(first) + b"".join(map(self.pieces.__getitem__, rest))

    def _safe_blank(self, text: str, start: int, end: int) -> int:
        """The last blank after ``start`` that follows something else than white space, or -1."""
        at = text.rfind(" ", start + 1, end)
        while at > start and self.white.match(text[at - 1]):
            at = text.rfind(" ", start + 1, at)
        return at

    def segment(self, text: str):
        """Packed ids of a text without special tokens, window by window."""
        start = 0
        while len(text) - start > self.window:
            end = self._safe_blank(text, start, start + self.window)
            if end > start:
                yield self._window(text[start:end])
                start = end
                continue
            # No blank to cut at: what follows can change only the last three characters' matches, and a run that
            # reaches them.
            limit, begin = start + self.window - 3, start
            for word in self.words(text[start:start + self.window]):
                if start + len(word) > limit:
                    break
                yield np.array(merge(self.merges, word.encode()), "<u4").tobytes()
                start += len(word)
            if start == begin:
                start = yield from self._long(text, start)
        yield self._window(text[start:])

    def _long(self, text: str, start: int):
        """Ids of the pre-token at ``start``, which fills a window at least; gives where it ends."""
        at = start + self.window - 3
        if self.white.fullmatch(text[start:at]):
            end = start
            while end < len(text) and (run := self.white.match(text[end:end + self.window])):
                end += run.end()
            end -= end < len(text)  # the last one goes with what follows
        else:
            mark = next(m for m in CLASS_MARKS if len(self.words(m + text[at - 1])) == 1)
            end = at
            while end < len(text):
                more = len(self.words(mark + text[end:end + self.window])[0]) - 1
                end += more
                if more < self.window:
                    break
        state = Transducer(self.merges)
        for piece in (text[i:min(i + self.window, end)] for i in range(start, end, self.window)):
            data = piece.encode()
            for i in range(0, len(data), STEP):
                yield np.array(state.push(data[i:i + STEP]), "<u4").tobytes()
        yield np.array(state.finish(), "<u4").tobytes()
        return end

    def pieces_of(self, text: str):
        if self.special is None or not any(token in text for token in self.merges.special):
            yield from self.segment(text)
            return
        start = 0
        for match in self.special.finditer(text):
            yield from self.segment(text[start:match.start()])
            yield np.array([self.merges.special[match.group()]], "<u4").tobytes()
            start = match.end()
        yield from self.segment(text[start:])

    def parts(self, text: str):
        """(last, packed ids) of a text: one part at least."""
        held, size = [], 0
        for ids in self.pieces_of(text):
            held.append(ids)
            size += len(ids)
            if size >= self.part_bytes:
                yield False, b"".join(held)
                held, size = [], 0
        yield True, b"".join(held)


class TextState:
    """Bytes to text, as they come: the state is a character's first bytes that lack others."""

    def __init__(self):
        self.held = b""

    def push(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                wanted = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                if back < wanted and byte < 0xF5:
                    cut = len(data) - back
                break
            if byte < 0x80:
                break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        data, self.held = self.held, b""
        return data.decode("utf-8", "replace")


def _rows(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns, schema=schema)


def encode(docs: DataFrame, merges: Merges, window: int = WINDOW, part_ids: int = PART_IDS) -> DataFrame:
    """(doc_id, row, part, last, ids) of every row of ``docs`` (doc_id, text); ``row`` numbers the rows."""
    shared = docs.sparkSession.sparkContext.broadcast(merges)
    numbered = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")

    def run(batches):
        encoder = Encoder(shared.value, window, part_ids)
        for batch in batches:
            schema = pa.schema([("doc_id", batch.schema.field("doc_id").type), ("row", pa.int64()), ("part", pa.int32()),
                                ("last", pa.bool_()), ("ids", pa.binary())])
            out, size, chars = {c: [] for c in schema.names}, 0, 0
            texts = batch.column("text")
            lengths = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
            for i, (doc_id, row, text) in enumerate(zip(*[batch.column(c) for c in ("doc_id", "row", "text")])):
                if chars <= 0:  # the cache gets what the next texts lack
                    end = i
                    while end < len(lengths) and (end == i or chars + lengths[end] <= WARMED_CHARS):
                        chars += max(1, lengths[end])
                        end += 1
                    encoder.warm([t or "" for t in texts.slice(i, end - i).to_pylist()])
                chars -= max(1, lengths[i])
                for part, (last, ids) in enumerate(encoder.parts(text.as_py() or "")):
                    for c, v in zip(out, (doc_id.as_py(), row.as_py(), part, last, ids)):
                        out[c].append(v)
                    size += len(ids)
                    if size > FLUSH_BYTES:
                        yield _rows(out, schema)
                        out, size = {c: [] for c in schema.names}, 0
            yield _rows(out, schema)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return numbered.mapInArrow(run, f"doc_id {kind}, row long, part int, last boolean, ids binary")


def in_order(encoded: DataFrame) -> DataFrame:
    """Stored parts, those of a row together and in their order; a row's parts in several tasks come to one."""
    return encoded.repartition("row").sortWithinPartitions("row", "part")


def decode(encoded: DataFrame, merges: Merges) -> DataFrame:
    """``encoded`` with ``text`` of each part. The parts of a row must follow each other, as they do from
    ``encode`` and from ``in_order``."""
    shared = encoded.sparkSession.sparkContext.broadcast(merges.tokens)

    def run(batches):
        tokens, state = shared.value, TextState()
        for batch in batches:
            texts = []
            for last, ids in zip(batch.column("last").to_pylist(), batch.column("ids")):
                ids = np.frombuffer(ids.as_py() or b"", "<u4").tolist()
                try:
                    text = state.push(b"".join(map(tokens.__getitem__, ids)))
                except (IndexError, TypeError):
                    raise ValueError("an id has no token") from None
                texts.append(text + state.finish() if last else text)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "row", "part", "last", "ids").mapInArrow(
        run, f"doc_id {kind}, row long, part int, last boolean, ids binary, text string")


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row of ``decoded``, whose parts follow each other."""

    def run(batches):
        n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
        for batch in batches:
            schema = pa.schema([("doc_id", batch.schema.field("doc_id").type), ("n_tokens", pa.int64()),
                                ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
            out = {c: [] for c in schema.names}
            for doc_id, last, ids, text in zip(*[batch.column(c) for c in ("doc_id", "last", "ids", "text")]):
                ids = np.frombuffer(ids.as_py(), "<u4").tolist()
                if ids:
                    of_ids.update((b"," if n else b"") + ",".join(map(str, ids)).encode())
                    n += len(ids)
                of_text.update(text.as_py().encode())
                if last.as_py():
                    for c, v in zip(out, (doc_id.as_py(), n, of_ids.hexdigest(), of_text.hexdigest())):
                        out[c].append(v)
                    n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
            yield _rows(out, schema)

    kind = decoded.schema["doc_id"].dataType.simpleString()
    return decoded.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def joined(decoded: DataFrame) -> DataFrame:
    """(doc_id, row, text) with whole texts again, for texts that fit into a row."""
    parts = W.partitionBy("row").orderBy("part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return decoded.withColumn("text", F.array_join(F.collect_list("text").over(parts), "")).where("last").select(
        "doc_id", "row", "text")


def op13_bpe_transducer(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    merges = read_merges(path or public_tokenizers.path(VOCABULARY))
    return digests(decode(encode(read(spark, sf_dir, "documents"), merges), merges))
