"""Secret scans: base patterns, and a randomness test battery with length-aware false-discovery control.

Base spans come from three patterns. Beyond them, every maximal run of at least
``SHORTEST`` token characters that overlaps no base span is a candidate if an
encoding can be inferred (hex, base32 or base64; letters alone have none).
Each candidate gets a battery of tests over its encoding's alphabet:

* chi-squared uniformity: too uneven to be random, it is no secret; else the
  p-value of being so even if its characters came from the corpus's own letter
  frequencies (a normal approximation of the noncentral distribution);
* runs: the number of changes between lower case, upper case, digits and
  others, against the rate of such changes inside the corpus's words (a bound
  of the binomial tail);
* serial correlation of neighbouring symbols: counting sequences fail it.

The first two p-values are combined by Fisher's method. Then, among candidates of
like length over the whole corpus, the Benjamini-Hochberg step at rate ``RATE``
decides which of them are added as spans of kind ``random``.

One scan of the texts writes spans, raw statistics and character counts; what
reaches the driver is a fixed number of character counts and of histogram bins.

Defined cases: null is empty; texts without spans give an empty list; equal
spans of several kinds all stay; rows that repeat a doc_id are scanned each;
a null doc_id passes through; other columns are not used.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowloom.llm.common import read, small_batches, tidy_shuffles
from flowloom.plans.lineage import as_table

# Fixed patterns and shortest matches of the base kinds, in their order.
KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # as long runs of [0-9a-f] of 24 characters or more
ASSIGN_SHORTEST, ACCESS_SHORTEST = 6, 20

SHORTEST = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
ENCODINGS = [
    ("hex", re.compile(r"(?=.*[0-9])(?=.*[a-fA-F])(?:[0-9a-f]+|[0-9A-F]+)\Z"), "0123456789abcdef"),
    ("base32", re.compile(r"(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*\Z"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base64", re.compile(r"(?=.*[0-9])(?=.*[A-Za-z]).+\Z"),
     "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
]
RATE = 0.001
LENGTHS = [20, 28, 40, 64, 128]
BIN = 0.1
MOST_BINS = 3000
Z_LIMIT = 4.0

STAGED = ("doc_id {}, counts array<long>, base array<struct<start:int,kind:int,past:int>>, "
          "found array<struct<start:int,past:int,code:int,chi:double,changes:int,serial:double>>")
_BASE = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("past", pa.int32())]))
_FOUND = pa.list_(pa.struct([("start", pa.int32()), ("past", pa.int32()), ("code", pa.int32()), ("chi", pa.float64()),
                             ("changes", pa.int32()), ("serial", pa.float64())]))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, leftmost and non-overlapping for each kind."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_SHORTEST]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_SHORTEST]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def _classes() -> np.ndarray:
    """Class of each ASCII code: 0 no token character, 1 lower case, 2 upper case, 3 digit, 4 other."""
    table = np.zeros(256, np.int8)
    for number, characters in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                         "0123456789", "+/_=-"), 1):
        table[list(characters.encode())] = number
    return table


CLASSES = _classes()


def inferred(token: str) -> int | None:
    return next((i for i, (_, pattern, _) in enumerate(ENCODINGS) if pattern.match(token)), None)


def statistics(token: str, code: int) -> tuple[float, int, float]:
    """Chi-squared against even use of the alphabet, class changes, serial correlation in standard errors."""
    body = token.rstrip("=") or token
    alphabet = ENCODINGS[code][2]
    body = body.lower() if ENCODINGS[code][0] == "hex" else body.replace("-", "+").replace("_", "/")
    symbols = np.array([alphabet.find(c) for c in body], np.float64)
    symbols = symbols[symbols >= 0]
    n, k = len(symbols), len(alphabet)
    counts = np.bincount(symbols.astype(np.int64), minlength=k)
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    kinds = CLASSES[np.frombuffer(token.encode("ascii"), np.uint8)]
    around = symbols - symbols.mean()
    spread = float((around ** 2).sum())
    serial = float((around[1:] * around[:-1]).sum()) / spread * math.sqrt(n) if spread else math.inf
    return chi, int((kinds[1:] != kinds[:-1]).sum()), serial


def _character_counts(texts: list[str]) -> np.ndarray:
    """Counts of the 128 ASCII codes, of neighbours inside tokens and of class changes among these."""
    data = np.frombuffer(" ".join(texts).encode("ascii", "replace"), np.uint8)
    kinds = CLASSES[data]
    inside = (kinds[1:] > 0) & (kinds[:-1] > 0)
    return np.concatenate((np.bincount(data, minlength=128)[:128],
                           [inside.sum(), (inside & (kinds[1:] != kinds[:-1])).sum()]))


def _scan(batches):
    counts, schema = np.zeros(130, np.int64), None
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        counts += _character_counts(texts)
        bases, founds = [], []
        for text in texts:
            base = base_spans(text)
            found = []
            for match in CANDIDATE.finditer(text):
                start, past = match.span()
                code = inferred(match[0])
                if code is None or any(s < past and start < e for s, _, e in base):
                    continue
                found.append(dict(zip(("start", "past", "code", "chi", "changes", "serial"),
                                      (start, past, code, *statistics(match[0], code)))))
            bases.append([{"start": s, "kind": k, "past": e} for s, k, e in base])
            founds.append(found)
        ids = batch.column("doc_id")
        schema = pa.schema([pa.field("doc_id", ids.type), ("counts", pa.list_(pa.int64())), ("base", _BASE),
                            ("found", _FOUND)])
        yield pa.RecordBatch.from_arrays(
            [ids, pa.nulls(len(ids), pa.list_(pa.int64())), pa.array(bases, _BASE), pa.array(founds, _FOUND)],
            schema=schema)
    if schema:
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, schema[0].type), pa.array([counts.tolist()], pa.list_(pa.int64())),
             pa.nulls(1, _BASE), pa.nulls(1, _FOUND)], schema=schema)


def unevenness(counts: np.ndarray) -> list[float]:
    """For each encoding, how much one character of the corpus adds to chi-squared over its alphabet."""
    out = []
    for _, _, alphabet in ENCODINGS:
        own = counts[list(alphabet.encode())].astype(np.float64) + 1
        share = own / own.sum()
        out.append(float(len(alphabet) * (share ** 2).sum() - 1))
    return out


def _log_normal_tail(z: float) -> float:
    """Log of the normal distribution below z."""
    if z > -30:
        return math.log(max(math.erfc(-z / math.sqrt(2)) / 2, 1e-300))
    return -z * z / 2 - math.log(-z * math.sqrt(2 * math.pi))


def _log_binomial_tail(k: int, n: int, rate: float) -> float:
    """Log of a bound of the chance of k or more of n at a rate (Chernoff)."""
    share = k / n
    if share <= rate:
        return 0.0
    rest = (1 - share) * math.log((1 - share) / (1 - rate)) if share < 1 else 0.0
    return -n * (share * math.log(share / rate) + rest)


def log_p_value(length: int, code: int, chi: float, changes: int, serial: float,
                uneven: list[float], change_rate: float) -> float:
    """Log p-value of a candidate if it were made of the corpus's characters; 0 if it isn't random."""
    k = len(ENCODINGS[code][2])
    if chi > k - 1 + Z_LIMIT * math.sqrt(2 * (k - 1)) or abs(serial) > Z_LIMIT:
        return 0.0
    mean, spread = k - 1 + length * uneven[code], math.sqrt(2 * (k - 1) + 4 * length * uneven[code])
    total = _log_normal_tail((chi - mean) / spread) + _log_binomial_tail(changes, length - 1, change_rate)
    return min(0.0, total + math.log1p(-total))


def _stratum(length: int) -> int:
    return sum(length >= least for least in LENGTHS) - 1


def scan_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """(doc_id, base, spans) of every row of ``docs`` (doc_id, text): arrays of (start, kind, past),
    kind as the place in KINDS and, for added spans, the number after them."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    with tidy_shuffles(spark):
        staged = as_table(docs.select("doc_id", "text").mapInArrow(_scan, STAGED.format(kind)), "secret-scan")
        sums = staged.where("counts is not null").select(F.posexplode("counts")).groupBy("pos").agg(
            F.sum("col").alias("n")).collect()
    counts = np.zeros(130, np.int64)
    for row in sums:
        counts[row.pos] = row.n
    uneven, change_rate = unevenness(counts), float(counts[129] + 1) / float(counts[128] + 2)

    def tested(batches):
        for batch in batches:
            out = []
            for found in batch.column("found").to_pylist():
                out.append([{"start": f["start"], "past": f["past"], "stratum": _stratum(f["past"] - f["start"]),
                             "bin": min(MOST_BINS, int(-log_p_value(
                                 f["past"] - f["start"], f["code"], f["chi"], f["changes"], f["serial"],
                                 uneven, change_rate) / BIN))} for f in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("base"), pa.array(out, pa.list_(pa.struct([
                    ("start", pa.int32()), ("past", pa.int32()), ("stratum", pa.int32()), ("bin", pa.int32())])))],
                names=["doc_id", "base", "found"])

    rows = staged.where("counts is null").mapInArrow(
        tested, f"doc_id {kind}, base array<struct<start:int,kind:int,past:int>>, "
                "found array<struct<start:int,past:int,stratum:int,bin:int>>")
    least = discoveries(rows, rate)
    limits = F.array(*[F.lit(n) for n in least])
    added = F.transform(
        F.filter("found", lambda f: f["bin"] >= F.get(limits, f["stratum"])),
        lambda f: F.struct(f["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), f["past"].alias("past")))
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def discoveries(rows: DataFrame, rate: float) -> list[int]:
    """Least bin of -log p that is taken in each length stratum (Benjamini-Hochberg on bins)."""
    bins = rows.select(F.explode("found").alias("f")).groupBy("f.stratum", "f.bin").agg(F.count("*").alias("n")).collect()
    least = []
    for stratum in range(len(LENGTHS)):
        own = sorted(((r.bin, r.n) for r in bins if r.stratum == stratum), reverse=True)
        total, above, limit = sum(n for _, n in own), 0, MOST_BINS + 1
        for place, n in own:
            above += n
            if total * math.exp(-place * BIN) <= rate * above:
                limit = place
        least.append(limit)
    return least


def _text(spans):
    names = F.array(*[F.lit(k) for k in [*KINDS, "random"]])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["past"].cast("string"))), ",")


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    found = scan_secrets(read(spark, sf_dir, "documents"))

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_text("base"), 256).alias("base_sha256"), _text("spans").alias("spans"))
