import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from flowloom.llm.bpe_transducer import read_merges
from flowloom.llm.common import pack, read, unpack
from flowloom.llm.token_alignment import (
    SIDE_A, SIDE_B, align, groups, linked_pairs, merged, op11_token_alignment, text_parts,
)
from tests.conftest import DATA
from tests.llm.helpers import documents

BYTES = {c: b for b, c in zip(
    [*range(33, 127), *range(161, 173), *range(174, 256), *(b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or b > 173))],
    [*map(chr, [*range(33, 127), *range(161, 173), *range(174, 256)]), *map(chr, range(256, 324))])}


@pytest.fixture(scope="module")
def sides():
    with open(public_tokenizers.path(SIDE_B), "rb") as file:
        return read_merges(public_tokenizers.path(SIDE_A)), file.read()


def brute_force(rows):
    """Whole texts, by the libraries, in the words of the contract."""
    a_side = Tokenizer.from_file(public_tokenizers.path(SIDE_A))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(SIDE_B))
    aligned, counts = [], Counter()
    for doc, text in rows:
        if not text:
            aligned.append((doc, None))
            continue
        a, b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
        a_bytes = [bytes(BYTES[c] for c in a_side.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in ((i, b_side.id_to_piece(i)) for i in b)]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            aligned.append((doc, None))
            continue
        ends_a, ends_b = np.cumsum([*map(len, a_bytes)]).tolist(), np.cumsum([*map(len, b_bytes)]).tolist()
        at_a, at_b = {e: i for i, e in enumerate(ends_a)}, {e: i for i, e in enumerate(ends_b)}
        made, links, i, j = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            made.append(",".join(map(str, a[i:at_a[end] + 1])) + "|" + ",".join(map(str, b[j:at_b[end] + 1])))
            i, j = at_a[end] + 1, at_b[end] + 1
            links.append((a[i - 1], b[j - 1]))
        counts.update(links)
        aligned.append((doc, (len(a), len(b), ";".join(made), links)))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out, spelled = [], []
    for doc, found in aligned:
        n_a, n_b, text, links = found or (0, 0, "", [])
        out.append((doc, n_a, n_b, len(links), len(links), sum(counts[x] == most[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if found else ""))
        spelled.append((doc, text))
    return sorted(out, key=repr), counts, sorted(spelled, key=repr)


def texts():
    rng = random.Random(8)
    odd = [" ", "  ", "\n", "\t", "a", "The", " the", " word.", "é", "漢字", "😀", "́", "<s>", "</s>", "<|endoftext|>", "12", "'s",
           " ", "　", "x" * 20, " don't", " été,", "\x01", "<0x41>"]
    mixed = ["".join(rng.choices(odd, k=rng.randint(1, 60))) for _ in range(250)]
    hot = [("the " * rng.randint(1, 300)) + "of" for _ in range(30)]
    return [None, "", " ", "a", "a▁b", "▁", "x\u0000y", "word " * 4000, "y" * 3000, " lead", "trail ", "a  b   c", *mixed, *hot]


@pytest.mark.parametrize("salt_chars, run_links, part", [(64_000_000, 4_000_000, 1 << 18), (3000, 500, 40), (20_000, 1, 1000)])
def test_equals_brute_force(spark, sides, salt_chars, run_links, part):
    rows = [*enumerate(texts()), (None, "no id"), (1, "again the"), (1, "again the")]
    got = align(documents(spark, rows).repartition(4), *sides, salt_chars, run_links, part).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_force(rows)[0]


def test_pairs_and_groups(spark, sides):
    rows = [*enumerate(texts())]
    _, counts, spelled = brute_force(rows)
    got = linked_pairs(documents(spark, rows), *sides, salt_chars=5000, run_links=300).collect()
    assert {(r.a, r.b): r.n for r in got} == counts and len(got) == len(counts)
    for r in got:
        assert r.best == (r.n == max(n for (_, b), n in counts.items() if b == r.b))
    assert sorted(((r.doc_id, r.groups) for r in groups(documents(spark, rows), *sides).collect()), key=repr) == spelled


def test_merge_counts_each_pair():
    rng = random.Random(3)
    blocks, want = [], Counter()
    for part in range(3):
        for _ in range(6):
            pairs = sorted(rng.sample(range(60), rng.randint(1, 40)))
            totals = [rng.randint(1, 9) for _ in pairs]
            want.update({(part, p): n for p, n in zip(pairs, totals)})
            blocks.append((part, pairs[0], pairs, totals))
    blocks.sort(key=lambda b: b[:2])
    got = list(merged(iter(blocks)))
    assert got == [(part, pair, n) for (part, pair), n in sorted(want.items())]


def test_pack_round_trip():
    arrays = [np.array([1, 2**63, 5], np.uint64), np.array([], "<u4"), np.array([7, 2**32 - 1], "<u4")]
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(arrays, unpack(pack(*arrays))))


def test_parts_of_a_text():
    text = "ab cd  ef gh \n ij k" * 20
    for size in (1, 3, 10, 1000):
        assert " ".join(text_parts(text, size)) == text


def test_empty_table(spark, sides):
    assert align(documents(spark, []), *sides).collect() == []
    assert [r.n_a for r in align(documents(spark, [(1, None)]), *sides).collect()] == [0]


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in read(spark, DATA, "documents").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in op11_token_alignment(spark, DATA).collect()), key=repr) == brute_force(docs)[0]
