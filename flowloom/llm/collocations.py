"""Phrase collocations by SON partitioning.

A phrase is a run of 2 to ``LONGEST`` words inside a piece of text. Those that
occur ``support`` times or more in a language are found in two counting scans:

1. a task takes its documents shard by shard (``SHARD_BYTES`` of text) and mines
   each shard completely, level by level: a run is counted only if both runs of
   one word less reach the shard's support, which is the support lowered in
   proportion to the shard's share of the language's text. If a phrase reaches
   the support in all, it does so in one shard at least. A shard that doesn't
   report a phrase holds it fewer times than its own support; where reports and
   these bounds together stay below the support, the phrase is no candidate;
2. the union of the locally frequent phrases is made a bitmap of ``BITS`` bits
   (16 MB, whatever the input) and broadcast. Every shard counts all phrases
   whose bit is set, by their words, and the sums over all shards are exact.

The bitmap only saves work: what it lets through by chance is counted too and
falls below the support. Before, single words are counted once over all shards;
runs with a word below the support are never formed. Shards have a fixed size,
so at great size a shard's support becomes one and its counts are complete.

Score of a phrase with count a cut after its first k words: floor(1000 a n / (l
r)), n the language's words, l and r the counts of both parts (phrases that reach the
support too). The lowest cut counts, of equal ones the first. A phrase inside a
longer one that occurs ``100 * f(longer) >= COVERED * a`` times is dropped.

Defined cases: null or empty texts have no words, a null language is ``und``;
doc_ids and other columns are not used, repeated rows count again; an empty
table gives no rows. A text of any length is split in blocks; what a task holds is one
shard's words. Inside a shard, phrases are told apart by 64-bit hashes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from flowloom.llm.common import arrow_batches, pack, read, tidy_shuffles, unpack
from flowloom.llm.spans import mix, split_words, word_table
from flowloom.plans.lineage import as_table

SUPPORT = 100
LONGEST = 5
COVERED = 100
TOP = 2000
SHARD_BYTES = 32 << 20
BLOCK_BYTES = 1 << 20
BITS = 1 << 27
AT_ONCE = 1 << 17
BLANKS = " \t"
MARKS = ".,;:!?\n\x0b\x0c\r"
UNKNOWN = "und"


def _odd(i: int) -> np.uint64:
    return mix(np.array([i + 1], np.uint64))[0] | np.uint64(1)


_PLACES = [_odd(i) for i in range(16)]


class ShardWords:
    """The words of one language in a shard: hashes, the piece that each stands in, places in the buffers."""

    stops = re.compile(b"[" + re.escape(BLANKS + MARKS).encode() + b"]")
    table = word_table(BLANKS + MARKS)
    marks = ~word_table(MARKS)

    def __init__(self, lang: str, total: int):
        self.seed = np.uint64(xxhash.xxh64_intdigest(lang))
        self.lang, self.total, self.bytes = lang, total, 0
        self.waiting: list[bytes] = []
        self.waiting_bytes = self.pieces = self.place = 0
        self.parts: tuple[list, ...] = ([], [], [], [], [])

    def add(self, text: bytes) -> None:
        self.bytes += len(text)
        start = 0
        while len(text) - start > BLOCK_BYTES:  # a long text is split after a blank or mark
            stop = self.stops.search(text, start + BLOCK_BYTES // 2)
            if stop is None:
                break
            self._split()
            self.waiting = [text[start:stop.end()]]
            start = stop.end()
            self._split(end=b"")
        self.waiting.append(text[start:])
        self.waiting_bytes += len(text) - start
        if self.waiting_bytes > BLOCK_BYTES:
            self._split()

    def _split(self, end: bytes = b"\n") -> None:
        if not self.waiting:
            return
        words = split_words([b"\n".join(self.waiting) + end], self.table)
        piece = np.cumsum(self.marks[np.frombuffer(words.buffer, np.uint8)], dtype=np.int32)
        base = np.int32(self.place)
        for held, part in zip(self.parts, (words.buffer, words.starts.astype(np.int32) + base, words.ends.astype(np.int32) + base,
                                           words.hashes, piece[words.starts] + np.int32(self.pieces))):
            held.append(part)
        self.place += len(words.buffer)
        self.pieces += int(piece[-1]) if len(piece) else 0
        self.waiting, self.waiting_bytes = [], 0

    def close(self) -> None:
        """Turns what was added into arrays."""
        self._split()

        def joined(place, kind):
            out = np.concatenate(self.parts[place] or [np.zeros(0, kind)])
            self.parts[place].clear()
            return out
        self.buffer = b"".join(self.parts[0])
        self.parts[0].clear()
        self.starts, self.ends, self.hashes, self.piece = (
            joined(1, np.int32), joined(2, np.int32), joined(3, np.uint64), joined(4, np.int32))

    def runs(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the runs of ``size`` words that begin at the words ``at``."""
        total = np.full(len(at), self.seed + np.uint64(size), np.uint64)
        for start in range(0, len(at), AT_ONCE):
            part = slice(start, start + AT_ONCE)
            for i in range(size):
                total[part] += self.hashes[at[part] + i] * _PLACES[i]
            total[part] = mix(total[part])
        return total

    def longer(self, kept: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """Where runs of ``size`` words begin whose two runs of a word less begin at kept places ``at[kept]``."""
        good = np.zeros(len(self.hashes) + 1, bool)
        good[at[kept]] = True
        first = at[kept]
        first = first[first + size <= len(self.hashes)]
        return first[good[first + 1] & (self.piece[first] == self.piece[first + size - 1])]

    def phrase(self, at: int, size: int) -> bytes:
        return b" ".join([self.buffer[self.starts[i]:self.ends[i]] for i in range(at, at + size)])


def over_shards(docs: DataFrame, work: Callable, schema: pa.Schema, kinds: str, shard_bytes: int) -> DataFrame:
    """Rows that ``work`` yields, as columns, for each language of each shard of ``docs`` (lang, total, text)."""

    def run(batches):
        shard: dict[str, ShardWords] = {}
        held = 0

        def flush():
            for lang in list(shard):
                words = shard.pop(lang)
                words.close()
                for columns in work(words):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
                del words

        for batch in batches:
            for lang, total, text in zip(*[batch.column(c) for c in ("lang", "total", "text")]):
                lang, data = lang.as_py(), text.as_py().encode("utf-8", "surrogatepass")
                if lang not in shard:
                    shard[lang] = ShardWords(lang, total.as_py())
                shard[lang].add(data)
                held += len(data)
                if held >= shard_bytes:
                    yield from flush()
                    held = 0
        yield from flush()

    return docs.mapInArrow(run, kinds)


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(hashes), bool)
    for start in range(0, len(hashes), AT_ONCE):
        place = hashes[start:start + AT_ONCE] & np.uint64(BITS - 1)
        out[start:start + AT_ONCE] = (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1)
    return out


def bitmap(hashes: DataFrame) -> np.ndarray:
    """The bits at the hashes (column ``h``), as bytes; the driver gets ``BITS`` bits and no more."""
    place = F.col("h").bitwiseAND(F.lit(BITS - 1)) + 1
    rows = hashes.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).toArrow()
    out = np.zeros((BITS // 32768, 4096), np.uint8)
    for bucket, data in zip(rows.column("bucket").to_pylist(), rows.column("bits")):
        out[bucket - 1] = np.frombuffer(data.as_py(), np.uint8)
    return out.ravel()


def tally(hashes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of hashes found ``least`` times: the distinct ones, where each is first, how often; and which are such."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1])))
    n = np.diff(first, append=len(ordered))
    often = n >= least
    kept = np.zeros(len(hashes), bool)
    kept[order] = np.repeat(often, n)
    first, n = first[often], n[often]
    return ordered[first], order[first], n, kept


def by_part(hashes: np.ndarray, bits: int):
    """(part, slice) of sorted hashes, by their first ``bits`` bits."""
    part = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for a, b in zip(edges, edges[1:]):
        if a < b:
            yield int(part[a]), slice(a, b)


def word_counts(docs: DataFrame, shard_bytes: int) -> DataFrame:
    """(lang, h, n) of every word, exact."""
    schema = pa.schema([("lang", pa.string()), ("h", pa.int64()), ("n", pa.int64())])

    def work(words):
        h, _, n, _ = tally(words.runs(np.arange(len(words.hashes), dtype=np.int32), 1), 1)
        yield [words.lang] * len(h), h.view(np.int64), n

    found = over_shards(docs, work, schema, "lang string, h long, n long", shard_bytes)
    return found.groupBy("lang", "h").agg(F.sum("n").alias("n"))


def local_phrases(docs: DataFrame, frequent: np.ndarray, support: int, bits: int, shard_bytes: int) -> DataFrame:
    """(lang, part, slack, found) of the phrases that each shard finds frequent: their sorted hashes and counts, packed
    by the first ``bits`` bits of the hash (the part); slack is one less than the shard's support. A row without
    part tells the slack of each shard and language once."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    schema = pa.schema([("lang", pa.string()), ("part", pa.int64()), ("slack", pa.int64()), ("found", pa.binary())])

    def work(words):
        least = max(1, -(-support * words.bytes // max(1, words.total)))
        yield [words.lang], [None], [least - 1], [None]
        at = np.arange(len(words.hashes), dtype=np.int32)
        kept = in_bitmap(shared.value, words.runs(at, 1))
        for size in range(2, LONGEST + 1):
            at = words.longer(kept, at, size)
            hashes, _, n, kept = tally(words.runs(at, size), least)
            for part, piece in by_part(hashes, bits):
                found = pack(np.diff(hashes[piece], prepend=np.uint64(0)), n[piece].astype("<u4"))
                yield [words.lang], [part], [least - 1], [found]

    return over_shards(docs, work, schema, "lang string, part long, slack long, found binary", shard_bytes)


def candidates(local: DataFrame, support: int) -> DataFrame:
    """(h) of the phrases whose reports, and the bounds of shards that don't report them, reach the support."""
    slack = as_table(local.where("part is null").groupBy("lang").agg(F.sum("slack").alias("all_slack")), "slack")
    parts = local.where("part is not null").join(slack, "lang").select("lang", "part", "slack", "all_slack", "found")

    def merged(held):
        hashes, n, slack = [], [], []
        for slack_of, found in held:
            gaps, counts = unpack(found)
            hashes.append(np.cumsum(gaps, dtype=np.uint64))
            n.append(counts.astype(np.int64) - slack_of)
        hashes, n = np.concatenate(hashes), np.concatenate(n)
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        first = np.flatnonzero(np.concatenate((np.ones(1, bool), hashes[1:] != hashes[:-1])))
        return hashes[first].view(np.int64), np.add.reduceat(n[order], first)

    def run(batches):
        current, held, room = None, [], 0
        for batch in batches:
            for key in zip(*[batch.column(c).to_pylist() for c in ("lang", "part", "slack", "all_slack", "found")]):
                if key[:2] != current:
                    if held:
                        hashes, n = merged(held)
                        yield pa.RecordBatch.from_arrays([pa.array(hashes[n + room >= support])], names=["h"])
                    current, held, room = key[:2], [], key[3]
                held.append((key[2], key[4]))
        if held:
            hashes, n = merged(held)
            yield pa.RecordBatch.from_arrays([pa.array(hashes[n + room >= support])], names=["h"])

    return parts.repartition("lang", "part").sortWithinPartitions("lang", "part").mapInArrow(run, "h long")


def counted_phrases(docs: DataFrame, wanted: np.ndarray, support: int, bits: int, shard_bytes: int) -> DataFrame:
    """(lang, phrase, size, a) of the phrases and words that occur ``support`` times, exact; all those whose bits
    are in ``wanted`` are counted over all documents. Shards send them by part, and a part adds them up by their words."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)
    schema = pa.schema([("lang", pa.string()), ("part", pa.int64()), ("phrases", pa.binary()), ("n", pa.binary())])

    def work(words):
        at, kept = np.arange(len(words.hashes), dtype=np.int32), None
        for size in range(1, LONGEST + 1):
            if size > 1:
                at = words.longer(kept, at, size)
            hashes = words.runs(at, size)
            kept = in_bitmap(shared.value, hashes)
            hashes, first, n, _ = tally(hashes[kept], 1)
            places = at[kept][first]
            for part, piece in by_part(hashes, bits):
                phrases = b"\n".join([words.phrase(p, size) for p in places[piece].tolist()])
                yield [words.lang], [part], [zstandard.compress(phrases, 3)], [pack(n[piece].astype("<u4"))]

    def rows(lang, sums):
        often = [(phrase.decode("utf-8", "replace"), a) for phrase, a in sums.items() if a >= support]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(often), pa.string()), pa.array([p for p, _ in often], pa.string()),
             pa.array([p.count(" ") + 1 for p, _ in often], pa.int32()), pa.array([a for _, a in often], pa.int64())],
            names=["lang", "phrase", "size", "a"])

    def add_up(batches):
        current, sums = None, Counter()
        for batch in batches:
            for lang, part, phrases, n in zip(*[batch.column(c).to_pylist() for c in schema.names]):
                if (lang, part) != current:
                    if current:
                        yield rows(current[0], sums)
                    current, sums = (lang, part), Counter()
                for phrase, count in zip(zstandard.decompress(phrases).split(b"\n"), unpack(n)[0].tolist()):
                    sums[phrase] += count
        if current:
            yield rows(current[0], sums)

    found = over_shards(docs, work, schema, "lang string, part long, phrases binary, n binary", shard_bytes)
    return found.repartition("lang", "part").sortWithinPartitions("lang", "part").mapInArrow(
        add_up, "lang string, phrase string, size int, a long")


def _part(start: Column | int, length: Column) -> Column:
    return F.array_join(F.slice("words", start, length), " ")


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words or more, by their lowest cut."""
    counts = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("count"))
    cuts = phrases.where("size > 1").withColumns({
        "words": F.split("phrase", " "), "k": F.explode(F.sequence(F.lit(1), F.col("size") - 1))})
    cuts = cuts.select("lang", "phrase", "a", "k", _part(1, F.col("k")).alias("first"),
                       _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    both = (
        cuts.join(counts.select("lang", F.col("part").alias("first"), F.col("count").alias("l")), ["lang", "first"])
        .join(counts.select("lang", F.col("part").alias("rest"), F.col("count").alias("r")), ["lang", "rest"])
        .join(totals, "lang")
    )
    wide = {c: f"cast({c} as decimal(17, 0))" for c in ("a", "n", "l", "r")}
    score = F.expr(f"(cast(1000 as decimal(4, 0)) * {wide['a']} * {wide['n']}) div ({wide['l']} * {wide['r']})")
    lowest = both.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("cut"))
    return lowest.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")


def covered_phrases(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the largest count of a longer phrase around each phrase of two words or more."""
    inner = phrases.where("size > 2").withColumns({
        "words": F.split("phrase", " "), "len": F.explode(F.sequence(F.lit(2), F.col("size") - 1))})
    inner = inner.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("len") + 1)))
    return inner.groupBy("lang", _part(F.col("start"), F.col("len")).alias("phrase")).agg(F.max("a").alias("longer"))


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP, covered: int = COVERED,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language of ``docs`` (lang, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    with tidy_shuffles(spark), arrow_batches(spark):
        sizes = as_table(docs.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("total")), "text-sizes")
        docs = docs.join(sizes, "lang").select("lang", "total", "text")
        words = as_table(word_counts(docs, shard_bytes), "words")
        totals = as_table(words.groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")
        frequent = words.where(F.col("n") >= support).select("h")
        # A part holds what about sixteen shards find, however many there are.
        shards = (sizes.agg(F.sum("total")).first()[0] or 0) // shard_bytes
        bits = min(20, 4 + max(0, shards // 16).bit_length())
        local = as_table(local_phrases(docs, bitmap(frequent), support, bits, shard_bytes), "local-phrases")
        wanted = bitmap(candidates(local, support).unionByName(frequent))
        phrases = as_table(counted_phrases(docs, wanted, support, bits, shard_bytes), "phrases")
    inside = covered_phrases(phrases)
    kept = scored(phrases, totals).join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language of all documents."""
    return collocations(read(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang),
sized AS (SELECT lang, w, unnest([1, 2, 3, 4, 5]) AS m FROM split),
placed AS (SELECT lang, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM sized WHERE len(w) >= m),
phrases AS (
  SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, count(*) AS a
  FROM placed GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(list_slice(w, 1, k), ' ') AS head,
         array_to_string(list_slice(w, k + 1, m), ' ') AS rest
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(generate_series(1, m - 1)) AS k FROM phrases WHERE m > 1)),
scores AS (
  SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, n,
         CAST((1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
  FROM cuts c JOIN phrases x ON x.lang = c.lang AND x.phrase = head
  JOIN phrases y ON y.lang = c.lang AND y.phrase = rest JOIN totals t ON t.lang = c.lang),
lowest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, a, array_to_string(list_slice(w, i, i + len - 1), ' ') AS phrase
  FROM (SELECT *, unnest(generate_series(1, m - len + 1)) AS i
        FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(generate_series(2, m - 1)) AS len
              FROM phrases WHERE m > 2))),
covered AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY lang, phrase)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank,
       s.phrase, s.a, l, r, n, score
FROM lowest s LEFT JOIN covered c ON c.lang = s.lang AND c.phrase = s.phrase
WHERE longer IS NULL OR 100 * longer < 100 * s.a QUALIFY rank <= 2000
"""
