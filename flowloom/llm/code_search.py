"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is cut into segments of 16 bits, and every segment is a hash table's key.
A code within distance m (r + 1) - 1 of a query, m the number of segments,
differs by at most r bits in some segment. So round r probes, for each query
that is still open, all keys that differ by r bits in a segment, measures the
whole distance of what it finds, and closes a query when its kth distance is
covered by that bound. Every round's join takes only codes that are not farther
than the query's present kth.

Equal codes are one: at most k ids of a code, the smallest, enter the index, cut
within tasks before the shuffle, so a vector that a third of all rows share is a
code like any. Equal queries are searched once. What is kept between rounds are
k rows for a query.

Defined cases: rows whose id or vector is null have no code: they are neither
found nor searched for; a missing or null element is a 0 bit, NaN a 1 bit; a query finds
itself; ties go by the smaller id; repeated rows of one id with one code are
one; fewer than k rows give as many ranks; other columns are not used.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from flowloom.llm.common import read, tidy_shuffles
from flowloom.plans.lineage import as_table

BITS = 64
SEGMENT = 16
K = 10
EVERY = 100


def _names(bits: int, prefix: str = "s") -> list[str]:
    return [f"{prefix}{i}" for i in range(-(-bits // SEGMENT))]


def sign_codes(vectors: DataFrame, id_column: str, vector: str, bits: int = BITS) -> DataFrame:
    """(id, s0, s1, ...): bit j of a code is whether element j is at least 0."""
    def segment(i):
        places = range(i * SEGMENT, min(bits, (i + 1) * SEGMENT))
        return reduce(add, [F.when(F.get(vector, F.lit(j)) >= 0, 1 << (j % SEGMENT)).otherwise(0) for j in places])
    names = _names(bits)
    return vectors.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(id_column).alias("id"), *[segment(i).cast("int").alias(n) for i, n in enumerate(names)])


def _distance(bits: int) -> Column:
    return reduce(add, [F.bit_count(F.col(q).bitwiseXOR(F.col(s))) for q, s in zip(_names(bits, "q"), _names(bits))])


def _masks(radius: int) -> Column:
    """All segment values of ``radius`` bits (one constant)."""
    values = [m for m in range(1 << SEGMENT) if m.bit_count() == radius]
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def _tables(codes: DataFrame, names: list[str]) -> Column:
    """A row for each segment: its number and key."""
    return F.explode(F.array(*[F.struct(F.lit(i).alias("table"), F.col(n).alias("key")) for i, n in enumerate(names)]))


def top_k(codes: DataFrame, queries: DataFrame, k: int = K, bits: int = BITS) -> DataFrame:
    """(query_id, rank, id, distance): the k nearest codes of each query, exactly.

    ``codes`` and ``queries`` are (id, s0, s1, ...).
    """
    spark = codes.sparkSession
    names, query_names = _names(bits), _names(bits, "q")
    least = W.partitionBy(*names).orderBy("id")
    with tidy_shuffles(spark):
        entries = as_table(codes.distinct().withColumn("place", F.row_number().over(least)).where(
            F.col("place") <= k).drop("place"), "codes")
        index = as_table(entries.select("id", *names, _tables(entries, names).alias("t")).select(
            "t.table", "t.key", "id", *names), "code-index")
        asked = as_table(queries.select(
            F.col("id").alias("query_id"), *[F.col(s).alias(q) for s, q in zip(names, query_names)]), "queries")
        active = asked.select(*query_names).distinct().withColumn("bound", F.lit(bits))
        best, closed = None, None
        for radius in range(SEGMENT + 1):
            covered = len(names) * (radius + 1) - 1
            probes = active.select(*query_names, "bound", _tables(active, query_names).alias("t")).select(
                *query_names, "bound", F.col("t.table").alias("table"), F.col("t.key").alias("base"),
                F.explode(_masks(radius)).alias("mask"))
            probes = probes.withColumn("key", F.col("base").bitwiseXOR(F.col("mask"))).drop("base", "mask")
            # Far more probes than the plan expects come from a query, so they must not be broadcast.
            found = probes.hint("merge").join(index, ["table", "key"]).withColumn("distance", _distance(bits)).where(
                "distance <= bound").select(*query_names, "id", "distance")
            if best is not None:
                found = found.unionByName(best.join(active.select(*query_names), query_names, "left_semi"))
            nearest = W.partitionBy(*query_names).orderBy("distance", "id")
            best = as_table(found.distinct().withColumn("rank", F.row_number().over(nearest)).where(
                F.col("rank") <= k).select(*query_names, "id", "distance"), "nearest")
            state = best.groupBy(*query_names).agg(F.count("*").alias("many"), F.max("distance").alias("kth"))
            state = as_table(active.drop("bound").join(state, query_names, "left").withColumn(
                "bound", F.when(F.col("many") >= k, F.col("kth")).otherwise(bits)), "open-queries")
            done = F.lit(radius == SEGMENT) | ((F.col("many") >= k) & (F.col("kth") <= covered))
            ready = best.join(state.where(done).select(*query_names), query_names, "left_semi")
            closed = ready if closed is None else closed.unionByName(ready)
            active = state.where(~done).select(*query_names, "bound")
            if not active.take(1):
                break
    order = W.partitionBy("query_id", *query_names).orderBy("distance", "id")
    return asked.distinct().join(closed, query_names).withColumn("rank", F.row_number().over(order)).select(
        "query_id", F.col("rank").cast("long").alias("rank"), "id", F.col("distance").cast("long").alias("distance"))


def op1_code_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, distance: the ten nearest sign codes of every hundredth vector."""
    codes = sign_codes(read(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    found = top_k(codes, codes.where(F.col("id") % EVERY == 0))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


OP1_SQL = f"""
WITH codes AS (SELECT vec_id, [embedding[i] >= 0 FOR i IN range(1, {BITS + 1})] AS code FROM embeddings),
near AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([CASE WHEN q.code[i] <> c.code[i] THEN 1 ELSE 0 END FOR i IN range(1, {BITS + 1})]) AS BIGINT) AS distance
  FROM codes q, codes c WHERE q.vec_id % {EVERY} = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM near)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= {K}
"""
