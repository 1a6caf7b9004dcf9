import random
import re
from collections import Counter
from fractions import Fraction

import duckdb
import pytest

from flowloom.llm import collocations
from flowloom.llm.collocations import OP12_SQL, ShardWords, collocations as mine, op12_collocations
from flowloom.llm.common import read
from tests.conftest import DATA

SCHEMA = "doc_id long, text string, lang string, h long, n long, total long, phrase string, size int, words string"


def documents(spark, rows):
    """Documents from (lang, text), with columns whose names the operator uses itself."""
    return spark.createDataFrame([(i, t, g, -1, -2, -3, "x", -4, "y") for i, (g, t) in enumerate(rows)], SCHEMA)


def split(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute_force(rows, support, top, covered=100):
    counts, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in split(text):
            n[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i:i + size])] += 1
    out = []
    often = {k: a for k, a in counts.items() if a >= support}
    for lang in n:
        found = {p: a for (g, p), a in often.items() if g == lang}
        rows_of = []
        for p, a in found.items():
            if len(p) < 2 or any(len(q) > len(p) and 100 * b >= covered * a and any(
                    q[i:i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, k = min((int(Fraction(1000 * a * n[lang], found[p[:k]] * found[p[k:]])), k) for k in range(1, len(p)))
            rows_of.append((score, a, " ".join(p), found[p[:k]], found[p[k:]]))
        rows_of.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i, p, a, l, r, n[lang], score) for i, (score, a, p, l, r) in enumerate(rows_of[:top], 1)]
    return sorted(out)


def corpus(seed=1):
    rng = random.Random(seed)
    common = ["the", "The", "of", "a", "b", "c", "é", "漢", "x-y"]
    rows = []
    for i in range(300):
        text = ""
        for _ in range(rng.randint(0, 60)):
            text += rng.choice([*common, f"rare{rng.randint(0, 400)}", "new york", "of the city hall now"])
            text += rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "!? ", "\r\n", "\xa0"])
        rows.append((rng.choice(["en", "en", "en", "fr", None, "und"]), text))
    return rows + [("en", None), ("de", ""), ("en", " . , ")] + [("en", "of the city hall now of the city")] * 12


@pytest.mark.parametrize("shard_bytes, support, top", [(32 << 20, 10, 2000), (2000, 10, 2000), (300, 3, 5), (1, 25, 50)])
def test_equals_brute_force(spark, shard_bytes, support, top):
    rows = corpus()
    got = mine(documents(spark, rows).repartition(3), support, top, shard_bytes=shard_bytes).collect()
    assert sorted(tuple(r) for r in got) == brute_force(rows, support, top)


def test_phrases_in_longer_ones(spark):
    rows = [("en", "one two three. one two")] * 4 + [("en", "one two three four")] * 6
    got = mine(documents(spark, rows), 2, 10, covered=60).collect()
    assert got and sorted(tuple(r) for r in got) == brute_force(rows, 2, 10, 60)


def test_long_text_is_split_between_words(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 64)
    text = "the quick brown fox, jumps over. the quick brown fox jumps; " * 30 + "w" * 500 + " the quick brown"
    words = ShardWords("en", 1)
    words.add(text.encode())
    words.add(b"tail")
    words.close()
    spelled = [words.phrase(i, 1).decode() for i in range(len(words.hashes))]
    assert spelled == [w for piece in split(text) for w in piece] + ["tail"]
    same = [a == b for a, b in zip(words.piece, words.piece[1:])]
    pieces = [i for i, piece in enumerate(p for p in [*split(text), ["tail"]] if p) for _ in piece]
    assert same == [a == b for a, b in zip(pieces, pieces[1:])]


def test_scores_beyond_64_bits(spark):
    phrases = spark.createDataFrame([("en", "a", 1, 10**13), ("en", "b", 1, 10**13 + 1), ("en", "a b", 2, 10**13 - 1)],
                                    "lang string, phrase string, size int, a long")
    totals = spark.createDataFrame([("en", 10**15 + 7)], "lang string, n long")
    row = collocations.scored(phrases, totals).first()
    assert row.score == 1000 * (10**13 - 1) * (10**15 + 7) // (10**13 * (10**13 + 1))


def test_empty_table(spark):
    assert mine(documents(spark, [])).collect() == []
    assert mine(documents(spark, [("en", None), (None, "")])).collect() == []


def test_query_equals_sql(spark):
    docs = read(spark, DATA, "documents").select("lang", "text").toArrow()
    con = duckdb.connect()
    con.register("documents", docs)
    want = con.sql(OP12_SQL).fetchall()
    assert want and sorted(tuple(r) for r in op12_collocations(spark, DATA).collect()) == sorted(want)
