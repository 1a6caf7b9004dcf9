"""Word n-gram Jaccard join by grouped prefixes.

A document's set is that of its distinct five-word shingles, as 64-bit hashes.
All sets are put in one order of shingles: those that are frequent come last.
Two sets of similarity t share one of their first n - ceil(t n) + 1 shingles, so

1. equal sets become one class, and classes with the same size and the same
   prefix become one group;
2. a prefix shingle's list holds the groups that have it. In each list, all
   groups are linked to the most central one (with the fewest rare shingles: what
   copies were made from) and to the head of their block of ``BLOCK``: linear in
   the list, no group meets all others;
3. those group pairs, and each group's members with its most central one, are
   filtered by size and by a bitmap bound on the overlap and verified on whole
   texts; the verified links give components;
4. what is left are pairs in lists whose members are in different components.
   All of these that sizes and bitmaps allow are expanded to members and verified,
   and the components of all links are the result.

Pairs inside one component need no look: step 4 covers every other pair, so no
component is missed, and a large group of near copies costs steps in proportion
to its size. Shingles are counted over all documents, by ranges of hash space;
the most frequent, at most ``MAX_FREQUENT`` (16 MB), are broadcast. They only
order the sets, so the result does not depend on them.

Defined cases: null or empty texts have no set and link with nothing; texts of
fewer than five words have one shingle, their whole sequence; rows that repeat a
doc_id are one document whose links are taken together; rows without doc_id
take the component of an equal set, else null; other columns pass through,
columns with the names of results are replaced.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from flowloom.llm.common import BLANKS, least_count, read, small_batches, tidy_shuffles
from flowloom.llm.components import components
from flowloom.llm.spans import chunks, mix, split_words, word_table
from flowloom.plans.lineage import as_table

SHINGLE = 5
PERCENT = 80
BLOCK = 64
FREQUENT = 4
MAX_FREQUENT = 1 << 20
RANGE = 500_000
CHARS_A_WORD = 6
SENT_AT_ONCE = 400_000
BITS = 1024


def _sets(texts: list[bytes], table: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = split_words(texts, table)
    first, hashes = words.windows(size)
    bounds = np.searchsorted(words.text[first], np.arange(len(texts) + 1))
    counts = np.diff(np.searchsorted(words.text, np.arange(len(texts) + 1)))
    out = []
    for i, text in enumerate(texts):
        if counts[i] >= size or not counts[i]:
            out.append(np.unique(hashes[bounds[i]:bounds[i + 1]]))
        else:
            out.append(split_words([text], table).windows(int(counts[i]))[1])
    return out


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _bitmap(values: np.ndarray) -> np.ndarray:
    """Parity of the number of members in each of BITS bins, 64 to a number."""
    parity = np.bincount((values % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def frequent_shingles(docs: DataFrame, size: int = SHINGLE, least: int = FREQUENT) -> tuple[DataFrame, int]:
    """(key, n) of the shingles that ``least`` documents or more hold, and the number of bits of a range.

    Hash space is cut into ranges of about ``RANGE`` shingles. A task sorts its
    shingles and sends each range the 32 bits that follow as packed numbers, equal
    ones once with their count; a range counts them. A key is both together.
    """
    chars = docs.agg(F.sum(F.char_length("text"))).first()[0] or 0
    bits = min(20, max(0, (chars // CHARS_A_WORD // RANGE).bit_length()))
    table = word_table(BLANKS)

    def packed(held):
        values, n = np.unique(np.concatenate(held) >> np.uint64(32 - bits), return_counts=True)
        bounds = np.searchsorted(values >> np.uint64(32), np.arange((1 << bits) + 1, dtype=np.uint64))
        low = (values & np.uint64(0xFFFFFFFF)).astype("<u4")
        rows = {"range": [], "ones": [], "more": []}
        for place in np.flatnonzero(np.diff(bounds)).tolist():
            part, many = low[bounds[place]:bounds[place + 1]], n[bounds[place]:bounds[place + 1]]
            rows["range"].append(place)
            rows["ones"].append(part[many == 1].tobytes())
            rows["more"].append(np.concatenate((part[many > 1], many[many > 1].astype("<u4"))).tobytes())
        return pa.RecordBatch.from_pydict(rows, schema=pa.schema([
            ("range", pa.int32()), ("ones", pa.binary()), ("more", pa.binary())]))

    def send(batches):
        held, total = [], 0
        for batch in batches:
            for _, texts in chunks(batch.column("text").to_pylist()):
                held += _sets(texts, table, size)
                total += sum(map(len, held[len(held) - len(texts):]))
                if total > SENT_AT_ONCE:
                    yield packed(held)
                    held, total = [], 0
        if held:
            yield packed(held)

    def counted(place, ones, more):
        values = [np.frombuffer(b"".join(ones), "<u4")]
        n = [np.ones(len(values[0]), np.int64)]
        for data in more:
            both = np.frombuffer(data, "<u4").reshape(2, -1)
            values.append(both[0])
            n.append(both[1].astype(np.int64))
        values, n = np.concatenate(values), np.concatenate(n)
        order = np.argsort(values, kind="stable")
        starts = np.flatnonzero(np.diff(values[order], prepend=-1)) if len(values) else np.zeros(0, np.int64)
        total = np.add.reduceat(n[order], starts) if len(starts) else np.zeros(0, np.int64)
        many = total >= least
        keys = np.int64(place) << 32 | values[order][starts[many]].astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(total[many])], names=["key", "n"])

    def count(batches):
        place, ones, more = None, [], []
        for batch in batches:
            for at, one, several in zip(*[batch.column(c).to_pylist() for c in ("range", "ones", "more")]):
                if at != place:
                    if place is not None:
                        yield counted(place, ones, more)
                    place, ones, more = at, [], []
                ones.append(one)
                more.append(several)
        if place is not None:
            yield counted(place, ones, more)

    sent = docs.select("text").mapInArrow(send, "range int, ones binary, more binary")
    return sent.repartition("range").sortWithinPartitions("range").mapInArrow(count, "key long, n long"), bits


def features(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n, odd, sig1, sig2, bits, prefix) of every row: size of the set, how many of its shingles are
    not frequent, hashes and bitmap of the set, prefix shingles (frequent ones last, the most frequent at the end)."""
    spark = docs.sparkSession
    frequent, range_bits = frequent_shingles(docs, size)
    counts = as_table(frequent, "frequent-shingles")
    top = counts.where(F.col("n") >= least_count(counts, MAX_FREQUENT)).toArrow().sort_by("key")
    shared = spark.sparkContext.broadcast((top.column("key").to_numpy().view(np.uint64), top.column("n").to_numpy()))
    shift = np.uint64(32 - range_bits)
    table = word_table(BLANKS)

    def describe(batches):
        known, ranks = shared.value
        for batch in batches:
            out = {"n": [], "odd": [], "sig1": [], "sig2": [], "bits": [], "prefix": []}
            for _, texts in chunks(batch.column("text").to_pylist()):
                for members in _sets(texts, table, size):
                    length = prefix_length(len(members), percent) if len(members) else 0
                    if len(known) and len(members):
                        keys = members >> shift
                        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                        rank = np.where(known[at] == keys, ranks[at], 0)
                        first = members[np.argsort(rank, kind="stable")[:length]]
                        out["odd"].append(int((rank == 0).sum()))
                    else:
                        first = members[:length]
                        out["odd"].append(len(members))
                    out["n"].append(len(members))
                    out["sig1"].append(int(np.bitwise_xor.reduce(mix(members)).view(np.int64)) if length else 0)
                    out["sig2"].append(int(mix(members + np.uint64(length)).sum(dtype=np.uint64).view(np.int64)))
                    out["bits"].append(_bitmap(members))
                    out["prefix"].append(first.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out["n"], pa.int32()), pa.array(out["odd"], pa.int32()),
                 pa.array(out["sig1"], pa.int64()),
                 pa.array(out["sig2"], pa.int64()), pa.array(out["bits"], pa.list_(pa.int64())),
                 pa.array(out["prefix"], pa.list_(pa.int64()))],
                names=["doc_id", "n", "odd", "sig1", "sig2", "bits", "prefix"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        describe, f"doc_id {kind}, n int, odd int, sig1 long, sig2 long, bits array<long>, prefix array<long>")


def _size_fits(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _needed(a: Column, b: Column, percent: int) -> Column:
    """Smallest overlap of sets of sizes a and b that is similar enough."""
    return F.ceil(percent * (a + b) / F.lit(100.0 + percent) - 1e-9)


def _bits_allow(a: str, b: str, n_a: Column, n_b: Column, percent: int) -> Column:
    """Whether bitmaps allow enough overlap: every bin of differing parity holds a member that is not
    shared, so the overlap is at most half of what the sizes have beyond these."""
    differing = reduce(add, [F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(BITS // 64)])
    return F.floor((n_a + n_b - differing) / 2) >= _needed(n_a, n_b, percent)


def _near(pairs: DataFrame, described: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and bitmaps allow."""
    def side(name):
        return described.select(F.col("doc_id").alias(name), F.col("n").alias(f"n_{name}"),
                                F.col("bits").alias(f"bits_{name}"))
    a, b = F.col("n_a"), F.col("n_b")
    return (
        pairs.join(side("a"), "a").join(side("b"), "b").where(_size_fits(a, b, percent))
        .where(_bits_allow("bits_a", "bits_b", a, b, percent)).select("a", "b").distinct()
    )


def verified(pairs: DataFrame, described: DataFrame, docs: DataFrame, size: int = SHINGLE,
             percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of doc_ids whose sets are similar enough: sizes and bitmaps are compared first, then
    whole texts are brought together."""
    near = as_table(_near(pairs, described, percent), "near-pairs")
    wanted = near.select(F.col("a").alias("doc_id")).unionByName(near.select(F.col("b").alias("doc_id"))).distinct()
    texts = as_table(docs.join(wanted, "doc_id", "left_semi"), "near-texts")
    table = word_table(BLANKS)

    def compare(batches):
        for batch in batches:
            left, right = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()
            distinct = list(dict.fromkeys([*left, *right]))
            sets = dict(zip(distinct, (s for _, part in chunks(distinct) for s in _sets(part, table, size))))
            similar = []
            for x, y in zip(left, right):
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                similar.append(100 * both >= percent * (len(sets[x]) + len(sets[y]) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(similar, pa.bool_()))

    def side(name):
        return texts.select(F.col("doc_id").alias(name), F.col("text").alias(f"text_{name}"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    together = near.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
    return together.mapInArrow(compare, f"a {kind}, b {kind}").distinct()


def _list_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Every group of a list with the list's most central one (of which fewest shingles are rare) and with the
    head of its block of like groups; heads with the head before."""
    in_order = W.partitionBy("token").orderBy("odd", "n", "gid")
    numbered = lists.withColumn("place", F.row_number().over(in_order) - 1)
    numbered = numbered.withColumns({
        "centre": F.first(F.struct("gid", "n")).over(in_order),
        "back": F.lag(F.struct("gid", "n"), BLOCK).over(in_order), "block": F.floor(F.col("place") / BLOCK)})
    head = F.first(F.struct("gid", "n")).over(W.partitionBy("token", "block").orderBy("odd", "n", "gid"))
    near = numbered.withColumn("head", F.when(F.col("place") % BLOCK == 0, F.col("back")).otherwise(head))
    return (
        near.select(F.explode(F.array("centre", "head")).alias("a"), F.col("gid").alias("b"), "n")
        .where("a.gid <> b").where(_size_fits(F.col("a.n"), F.col("n"), percent)).select(
            F.col("a.gid").alias("a"), "b").distinct()
    )


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(gid, doc_id, component) of group members."""
    return members.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "gid", "doc_id", F.coalesce("component", "doc_id").alias("component"))


def _open_pairs(lists: DataFrame, members: DataFrame, labels: DataFrame, described: DataFrame,
                percent: int) -> DataFrame:
    """Member pairs (a, b) of one list, or of one group, that are in different components and that sizes and
    bitmaps allow. Groups of one member are compared by bitmap at once, others when they are expanded."""
    member = as_table(_labelled(members, labels).join(
        described.select("doc_id", "n", "bits").dropDuplicates(["doc_id", "n"]), "doc_id"), "members")
    groups = member.groupBy("gid").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                       F.count("*").alias("many"))
    marked = lists.join(groups, "gid")
    mixed = marked.groupBy("token").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high")
    own = member.where("gid = doc_id").select("gid", "bits").dropDuplicates(["gid"])
    left = as_table(marked.join(mixed.select("token"), "token", "left_semi").join(own, "gid"), "open-lists")
    n1, n2 = F.col("n1"), F.col("n2")

    def renamed(df, end):
        return df.select("token", *[F.col(c).alias(c + end) for c in ("gid", "n", "low", "high", "many", "bits")])
    pair = (
        (F.col("gid1") < F.col("gid2")) & _size_fits(n1, n2, percent)
        & ((F.col("low1") != F.col("high1")) | (F.col("low2") != F.col("high2")) | (F.col("low1") != F.col("low2")))
        & ((F.col("many1") > 1) | (F.col("many2") > 1) | _bits_allow("bits1", "bits2", n1, n2, percent))
    )
    first, second = renamed(left, "1"), renamed(left, "2").withColumnRenamed("token", "token2")
    across = first.join(second, (F.col("token") == F.col("token2")) & pair).select("gid1", "gid2").distinct()
    within = groups.where("low <> high").select(F.col("gid").alias("gid1"), F.col("gid").alias("gid2"))

    def side(end, name):
        return member.select(F.col("gid").alias("gid" + end), F.col("doc_id").alias(name), F.col("component").alias("c" + end),
                             F.col("n").alias("n" + end), F.col("bits").alias("bits" + end))
    with_first = across.unionByName(within).join(side("1", "a"), "gid1")
    others = side("2", "b").withColumnRenamed("gid2", "gid")
    apart = (F.col("c1") != F.col("c2")) & ((F.col("gid1") != F.col("gid2")) | (F.col("a") < F.col("b")))
    return with_first.join(others, (F.col("gid2") == F.col("gid")) & apart & _bits_allow(
        "bits1", "bits2", n1, n2, percent)).select("a", "b").distinct()


def _same_document(filled: DataFrame, classes: DataFrame, signature: list[str]) -> DataFrame:
    """Links (a, b) between the classes of rows that repeat a doc_id with other sets."""
    whole = F.struct(*signature)
    repeated = filled.groupBy("doc_id").agg(F.min(whole).alias("x"), F.max(whole).alias("y")).where("x <> y")
    own = filled.join(repeated.select("doc_id"), "doc_id", "left_semi").join(classes, signature).select("doc_id", "first")
    return own.join(own.groupBy("doc_id").agg(F.min("first").alias("b")), "doc_id").select(F.col("first").alias("a"), "b")


def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    small_batches(spark)
    with tidy_shuffles(spark):
        described = as_table(features(docs, size, percent).withColumns({
            "p1": F.xxhash64("prefix"), "p2": F.xxhash64(F.lit(1), "prefix")}), "shingle-features")
        signature, prefix = ["n", "sig1", "sig2"], ["n", "p1", "p2"]
        filled = described.where("n > 0 and doc_id is not null")
        classes = as_table(filled.groupBy(*signature).agg(F.min("doc_id").alias("first")), "classes")
        firsts = filled.select("doc_id", "odd", *signature, "p1", "p2").join(
            classes.select(*signature, F.col("first").alias("doc_id")), [*signature, "doc_id"], "left_semi")
        keyed = as_table(firsts.select("doc_id", "odd", *prefix).distinct(), "prefixes")
        groups = keyed.groupBy(*prefix).agg(F.min(F.struct("odd", "doc_id"))["doc_id"].alias("gid"))
        members = as_table(keyed.join(groups, prefix).select("gid", "doc_id"), "groups")
        entries = filled.select("doc_id", "odd", *prefix, "prefix").join(
            groups.select(*prefix, F.col("gid").alias("doc_id")), [*prefix, "doc_id"], "left_semi").select(
            F.explode("prefix").alias("token"), "n", "odd", F.col("doc_id").alias("gid"))
        lists = as_table(entries.withColumn("many", F.count("*").over(W.partitionBy("token"))).where(
            "many > 1").drop("many").distinct(), "lists")
        first = _list_pairs(lists, percent).unionByName(
            members.where("gid <> doc_id").select(F.col("gid").alias("a"), F.col("doc_id").alias("b")))
        links = as_table(verified(first, described, docs, size, percent).unionByName(
            _same_document(filled, classes, signature)), "links-1")
        labels = as_table(components(links), "labels-1")
        more = as_table(verified(_open_pairs(lists, members, labels, described, percent), described, docs, size, percent),
                        "links-2")
        labels = as_table(components(labels.select(F.col("id").alias("a"), F.col("component").alias("b"))
                                     .unionByName(more)), "labels-2")
    by_class = classes.join(labels.withColumnRenamed("id", "first"), "first", "left").select(
        *signature, F.coalesce("component", "first").alias("_component"))
    own = F.when(F.col("n") == 0, F.col("doc_id"))
    return described.select("doc_id", *signature).join(by_class, signature, "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("_component", own).alias("component_id"))


def keep_one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents that are the smallest of their component, and those without doc_id."""
    kept = jaccard_components(docs, size, percent).where("doc_id = component_id").select("doc_id").distinct()
    return docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").select(*docs.columns).unionByName(
        docs.where("doc_id is null"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    return jaccard_components(read(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared >= 80 * (p.n + q.n - shared)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reached r JOIN both_ways l ON l.a = r.b)
SELECT r.a AS doc_id, coalesce(max(n), 0) AS n_shingles, min(r.b) AS component_id
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.a GROUP BY r.a
"""
