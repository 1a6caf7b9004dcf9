import random
import re

import pytest

from flowloom.llm.components import components
from flowloom.llm.jaccard_join import BLOCK, jaccard_components, keep_one_of_each, prefix_length
from tests.llm.helpers import documents, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            same = rows[i][0] == rows[j][0] and rows[i][0] is not None and a and b
            if same or (a and b and 100 * len(a & b) >= 80 * len(a | b)):
                parent[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for j, (d, _) in enumerate(rows) if find(j) == find(i) and d is not None]
        out.append((doc, len(sets[i]), min(ids) if ids and sets[i] else doc))
    return sorted(out, key=repr)


def run(spark, rows):
    found = jaccard_components(documents(spark, rows)).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr)


def near_copies(seed, count, length, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    for _ in range(count):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
        yield " ".join(copy)


def test_equals_brute_force(spark):
    rng = random.Random(5)
    shared = words(0, 60)
    texts = [None, "", " \t\n ", "one", "ONE", "one two three four", "one two  three\nfour", "é É", "é é", "É É"]
    texts += list(near_copies(1, 2 * BLOCK + 20, 150, 4)) + list(near_copies(2, 30, 400, 25)) + list(near_copies(3, 40, 30, 2))
    texts += [f"{words(10_000 + 100 * i, 40)} {shared}" for i in range(60)]
    texts += [" ".join(rng.choices("abc", k=12)) for _ in range(60)]
    texts += [words(50_000, 20_000), words(50_000, 20_000) + " more", words(50_000, 17_000)]
    rng.shuffle(texts)
    rows = list(enumerate(texts, start=3))
    rows += [(None, words(0, 9)), (1, words(0, 9)), (2, "repeated id"), (2, words(0, 9)), (2, "repeated id"), (None, "nobody")]
    assert run(spark, rows) == brute_force(rows)


def test_one_of_each_group_stays(spark):
    rows = [(1, words(0, 30)), (2, words(0, 30)), (3, words(0, 31)), (4, words(50, 30)), (5, None), (6, ""), (None, words(90, 30))]
    kept = keep_one_of_each(documents(spark, rows))
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(map(repr, [1, 4, 5, 6, None]))
    assert "gid" in kept.columns


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("n", [1, 2, 4, 5, 9, 10, 99, 100])
def test_prefix_is_long_enough(n):
    overlap = min(o for o in range(1, n + 1) if 100 * o >= 80 * n)
    assert prefix_length(n, 80) == n - overlap + 1


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)] + [(5, 5), (7, None)]
    rng.shuffle(links)
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(200)}
