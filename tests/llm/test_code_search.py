import random

import pytest

from flowloom.llm.code_search import sign_codes, top_k

SCHEMA = "vec_id long, embedding array<float>, distance int, bound int, s0 string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 0, 0, None) for r in rows], SCHEMA)


def brute_force(rows, queries, k):
    code = {i: [x is not None and not x < 0 for x in v] + [False] * (64 - len(v)) for i, v in rows if i is not None and v is not None}
    out = []
    for q in queries:
        near = sorted((sum(a != b for a, b in zip(code[q], c)), i) for i, c in code.items())[:k]
        out += [(q, rank, i, d) for rank, (d, i) in enumerate(near, 1)]
    return sorted(out)


def run(spark, rows, queries, k):
    codes = sign_codes(vectors(spark, rows), "vec_id", "embedding")
    found = top_k(codes, codes.where(codes.id.isin(queries)), k)
    return sorted((r.query_id, r["rank"], r.id, r.distance) for r in found.collect())


@pytest.mark.parametrize("k", [1, 10])
def test_equals_brute_force(spark, k):
    rng = random.Random(k)
    rows = [(i, [rng.gauss(0, 1) for _ in range(64)]) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(60)]          # a vector of many rows
    rows += [(2000 + i, [x if j != i else -x for j, x in enumerate(rows[7][1])]) for i in range(20)]
    rows += [(3000, [1.0] * 10), (3001, [None] * 64), (3002, [float("nan")] + [-1.0] * 63)]
    rows += [(4000, None), (None, [1.0] * 64), (5, rows[5][1])]  # nulls and a repeated row
    queries = [5, 7, 1003, 3000, 3001, 2001]
    assert run(spark, rows, queries, k) == brute_force(rows, queries, k)


def test_fewer_rows_than_k_and_empty(spark):
    rows = [(1, [1.0] * 64), (2, [-1.0] * 64)]
    assert run(spark, rows, [1], 10) == [(1, 1, 1, 0), (1, 2, 2, 64)]
    assert run(spark, [], [1], 10) == []
    assert run(spark, rows, [77], 10) == []
