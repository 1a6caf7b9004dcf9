import hashlib
import math
import random
import re

from flowloom.llm.secrets import (
    ENCODINGS, base_spans, inferred, log_p_value, op9_secret_scans, scan_secrets, statistics,
)
from tests.llm.helpers import documents

ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def brute_force(text):
    """Base spans by patterns as the contract words them."""
    text = text or ""
    names = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                     for w in ("password", "passwd", "secret", "token", "api_?key"))
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


TEXTS = [
    None, "", "Password = 'abc' secret:token:abcdefgh", "TOKEN=token=abcdefgh passwd:\tx123456", "apikey: \"q1w2e3r4\" api_key=12345",
    "AKIAAKIA" + "X" * 20 + " AKIA123", "é 漢 " + "0123456789abcdef" * 2 + "g" + "a" * 24 + " " + "f" * 23,
    "\u017fecret=abcdefgh", "secret = deadbeefdeadbeefdeadbeef00", "word " * 20_000 + "token='" + "ab12" * 10 + "'",
]


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(1)
    parts = ["token", "Secret", "=", ":", " ", '"', "'", "AKIA", "a1b2", "0f" * 8, "Z", "\n", "é", "passwd", "api_key", "apikey"]
    texts = TEXTS + ["".join(rng.choices(parts, k=30)) for _ in range(200)]
    assert all(base_spans(t or "") == brute_force(t) for t in texts)
    found = {r.doc_id: r for r in scan_secrets(documents(spark, list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        want = brute_force(text)
        assert [tuple(s) for s in found[i].base] == want
        assert [tuple(s) for s in found[i].spans if s.kind < 3] == want


def test_random_strings_are_added_and_words_are_not(spark):
    rng = random.Random(4)
    prose = " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(3000))
    keys = ["".join(rng.choices(ALNUM, k=40)) for _ in range(20)]
    plain = ["2024-01-02-some-long-name-of-a-page-3", "abcdefghijklmnopqrstuvwxyz0123456789", "averyveryverylongcompoundword1",
             "1111111111111111111111111111", "SOME_CONSTANT_NAME_OF_A_PROGRAM_2"]
    rows = [(i, f"{prose[:500]} {k} end") for i, k in enumerate(keys)]
    rows += [(100 + i, f"{prose} {p} end") for i, p in enumerate(plain)] + [(None, keys[0]), (7, ""), (7, None)]
    added = {}
    for r in scan_secrets(documents(spark, rows)).collect():
        added.setdefault(r.doc_id, []).extend((s.start, s.past) for s in r.spans if s.kind == 3)
    for i, k in enumerate(keys):
        assert added[i] == [(501, 541)], k
    assert all(added[100 + i] == [] for i in range(len(plain)))
    assert added[None] == [(0, 40)]


def test_encodings_and_statistics():
    names = [name for name, _, _ in ENCODINGS]
    assert names[inferred("0f" * 12)] == "hex" and names[inferred("ABCDEFGH" * 3 + "27")] == "base32"
    assert names[inferred("Aa0" * 8)] == "base64" and inferred("letters" * 4) is None
    chi, changes, serial = statistics("0123456789abcdef", 0)
    assert chi == 0 and changes == 1 and serial > 2
    assert log_p_value(40, 2, 60.0, 25, 0.0, [1.0, 2.0, 4.0], 0.02) < math.log(1e-9)
    assert log_p_value(40, 2, 60.0, 25, 5.0, [1.0, 2.0, 4.0], 0.02) == 0


def test_empty_table(spark):
    assert scan_secrets(documents(spark, [])).collect() == []


def test_whole_query(spark, data):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = op9_secret_scans(spark, data).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = brute_force(docs[r.doc_id])
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in want) for i in range(3)]
