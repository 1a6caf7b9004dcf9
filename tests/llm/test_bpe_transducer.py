import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from flowloom.llm.bpe_transducer import (
    VOCABULARY, BatchMerger, Encoder, TextState, Transducer, build_merges, decode, digests, encode, in_order, joined, merge,
    op13_bpe_transducer, read_merges,
)
from flowloom.llm.common import read
from tests.conftest import DATA
from tests.llm.helpers import documents


@pytest.fixture(scope="module")
def merges():
    return read_merges(public_tokenizers.path(VOCABULARY))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


def texts():
    rng = random.Random(5)
    odd = [" ", "  ", "\n", "\t ", " \n", "a", "B", "é", "ß", "'s", "'ll", "'", "1", "23", "!", "\u00a0", "\u3000", "\u00a0", "\u2003 ", "\x1c", "漢字",
           "😀", "\u0301", "<|endoftext|>", "<|endof", "word", " word", " word.", " été,", " x!?", "don't", "x" * 30, "\u0558",
           "\ua7ce"]
    mixed = ["".join(rng.choices(odd, k=rng.randint(1, 40))) for _ in range(400)]
    long = ["y" * 9000, "ab" * 5000 + "!", "1" * 7000 + "a", " " * 6000, " " * 6000 + "x", "\n" * 5000 + " x", "!" * 5000 + "'s" * 900,
            "漢字" * 3000, "é" * 4000 + "1" * 4000, "'re" * 3000, "x" * 4094 + "'ll" + "y" * 5000, "a " * 5000,
            "".join(rng.choices("abcdefgh", k=20_000)), "\u0558" * 5000]
    return [None, "", " ", "<|endoftext|>", "a<|endoftext|>  <|endoftext|>b  ", *long, *mixed]


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


def random_merges(rng, size):
    tokens = [bytes([b]) for b in range(256)]
    usable, pairs = [b"a", b"b", b"c"], []
    while len(pairs) < size:
        left, right = rng.choice(usable), rng.choice(usable)
        if left + right not in usable and len(left + right) < 12:
            pairs.append((left, right))
            usable.append(left + right)
            tokens.append(left + right)
    return build_merges(pairs, {t: i for i, t in enumerate(tokens)})


@pytest.mark.parametrize("seed", range(30))
def test_lookahead_is_sufficient(seed):
    """Of any merge list: the boundaries farther from the end than the lookahead never change."""
    rng = random.Random(seed)
    merges = random_merges(rng, rng.randint(1, 40))
    for _ in range(60):
        data = bytes(rng.choices(b"abc", k=rng.randint(1, 80)))
        state, got = Transducer(merges, step=1), []
        for byte in data:
            got += state.push(bytes([byte]))
        assert got + state.finish() == merge(merges, data)


def test_long_merge_equals_short(merges):
    rng = random.Random(1)
    for _ in range(40):
        data = bytes(rng.choices(b"the aniorsd", k=200))
        whole = merge(merges, data)
        slow = [merges.byte_ids[b] for b in data]
        while True:
            ranked = [(merges.pairs[p], i) for i in range(len(slow) - 1) if (p := slow[i] << 20 | slow[i + 1]) in merges.pairs]
            if not ranked:
                break
            rank, i = min(ranked)
            slow[i:i + 2] = [rank & 0xFFFFF]
        assert whole == slow


def test_batches_equal_single_words(merges):
    rng = random.Random(6)
    words = [bytes(rng.choices(b"the aniorsd.\xc3\xa9", k=rng.randint(1, 60))) for _ in range(3000)] + [b"a", b" the", b"aaaa"]
    got = BatchMerger(merges).merge(words)
    assert [list(memoryview(g).cast("I")) for g in got] == [merge(merges, w) for w in words]
    assert BatchMerger(merges).merge([]) == []


def test_lists_out_of_order_are_refused():
    ids = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257}
    with pytest.raises(ValueError):
        build_merges([(b"ab", b"c"), (b"a", b"b")], ids)


def test_state_is_bounded(merges):
    state = Transducer(merges)
    rng = random.Random(2)
    for _ in range(50):
        state.push(bytes(rng.choices(b"etaoinshr", k=4096)))
        assert len(state.held) <= merges.lookahead + 4096 + 128


def test_bytes_to_text_in_any_steps():
    rng = random.Random(4)
    samples = ["aé漢😀".encode() * 5, b"\xff\xc3\xe2\x82a\xf0\x9f\x98", bytes(rng.choices(range(256), k=400)), b"\xe2\x82", b""]
    for data in samples:
        for size in (1, 2, 3, 7):
            state = TextState()
            got = "".join(state.push(data[i:i + size]) for i in range(0, len(data), size)) + state.finish()
            assert got == data.decode("utf-8", "replace")


@pytest.mark.parametrize("window, part_ids, cached", [(1 << 16, 1 << 18, 1000), (4096, 100, 3), (64, 7, 50)])
def test_encoder_equals_library(merges, library, window, part_ids, cached):
    import numpy as np

    encoder = Encoder(merges, window, part_ids, cached)
    for i, text in enumerate(texts()):
        if i % 9 == 0:
            encoder.warm([t or "" for t in texts()[i:i + 5]])
        parts = list(encoder.parts(text or ""))
        assert [last for last, _ in parts] == [False] * (len(parts) - 1) + [True]
        got = np.frombuffer(b"".join(ids for _, ids in parts), "<u4").tolist()
        assert got == library.encode(text or "", add_special_tokens=False).ids, repr(text)[:80]


@pytest.mark.parametrize("window, part_ids", [(1 << 16, 1 << 18), (100, 50)])
def test_equals_library_and_round_trip(spark, merges, library, window, part_ids):
    rows = list(enumerate(texts())) + [(None, "no id"), (0, "again"), (0, "again")]
    parts = encode(documents(spark, rows), merges, window, part_ids)
    want = sorted(((doc, *expected(library, text)) for doc, text in rows), key=repr)
    got = [tuple(r) for r in digests(decode(parts, merges)).collect()]
    assert sorted(got, key=repr) == want
    stored = parts.persist()
    again = [tuple(r) for r in digests(decode(in_order(stored.repartition(5, "part", "ids")), merges)).collect()]
    assert sorted(again, key=repr) == want
    back = joined(decode(stored, merges)).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=repr) == sorted(((d, t or "") for d, t in rows), key=repr)


def test_empty_table(spark, merges):
    assert digests(decode(encode(documents(spark, []), merges), merges)).collect() == []


def test_ids_without_token(spark, merges):
    wrong = spark.createDataFrame([(1, 0, 0, True, bytearray(b"\xff\xff\x0f\x00"))],
                                  "doc_id long, row long, part int, last boolean, ids binary")
    with pytest.raises(Exception, match="an id has no token"):
        decode(wrong, merges).collect()


def test_query_equals_library(spark, library):
    docs = read(spark, DATA, "documents").select("doc_id", "text").collect()
    assert sorted(tuple(r) for r in op13_bpe_transducer(spark, DATA).collect()) == sorted(
        (r.doc_id, *expected(library, r.text)) for r in docs)
