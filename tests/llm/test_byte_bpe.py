import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from flowloom.llm import byte_bpe
from flowloom.llm.byte_bpe import VOCABULARY, Cutter, decode, digests, encode, id_arrays, op5_byte_bpe, read_ranks
from tests.llm.helpers import documents


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(public_tokenizers.path(VOCABULARY))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    odd = [" ", "  ", "\n", "\t ", " \n", "a", "B", "é", "ß", "'s", "'ll", "1", "23", "!", "\u00a0", "\u3000", "\x1c", "漢字",
           "😀", "\u0301", "<|endoftext|>", "word", " word", " word.", " été,", " x!?", "don't", "x" * 30]
    mixed = ["".join(rng.choices(odd, k=rng.randint(1, 40))) for _ in range(300)]
    return [None, "", " ", "   ", "\n\n  x", "x  ", "a " * 5000, "y" * 100_000, "end \n", *mixed]


def test_cut_parts_no_match():
    cutter = Cutter(public_tokenizers.PATTERN)
    for text in filter(None, texts()):
        first, rest = cutter.pieces(text)
        assert [w for p in [first, *(" " + r for r in rest)] for w in cutter.words(p)] == cutter.words(text)
        assert all(cutter.after_blank(r) == cutter.words(" " + r) for r in rest)


@pytest.mark.parametrize("hot, block_chars", [(400_000, 4_000_000), (20, 3000), (0, 50_000)])
def test_equals_library_and_round_trip(spark, ranks, library, hot, block_chars):
    rows = list(enumerate(texts())) + [(None, "no id"), (0, "again"), (0, "again")]
    encoded = encode(documents(spark, rows), ranks, hot=hot, block_chars=block_chars)
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests(
        decode(encoded, ranks)).collect()), key=repr)
    want = []
    for doc, text in rows:
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        want.append((doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_empty_table(spark, ranks):
    assert encode(documents(spark, []), ranks).collect() == []


def test_ids_as_arrays(spark, ranks, library):
    rows = id_arrays(encode(documents(spark, [(1, "some words"), (2, None)]), ranks)).collect()
    assert {r.doc_id: r.ids for r in rows} == {1: library.encode_ordinary("some words"), 2: []}


def test_decoded_in_the_same_worker(spark, ranks, data, monkeypatch):
    plan = op5_byte_bpe(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert plan.partition("Exchange")[0].count("MapInArrow") == 1  # a worker for each, in every task
    monkeypatch.setattr(byte_bpe, "SENT_AT_ONCE", 10)  # several batches to a block
    docs = documents(spark, [*enumerate(texts()), (None, "no id"), (0, "again")])
    both = [sorted(map(tuple, rows.collect()), key=repr) for rows in (
        encode(docs, ranks, block_chars=3000, decoded=True), decode(encode(docs, ranks, block_chars=3000), ranks))]
    assert both[0] == both[1] and len(both[0]) == len(texts()) + 2
