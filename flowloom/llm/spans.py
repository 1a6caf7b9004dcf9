"""Words of a batch of texts and hashes of word windows, by whole arrays.

A batch is one byte buffer, its texts parted by line feeds. A word is a run of
the bytes that a 256-entry table admits (bytes of characters beyond ASCII count
one by one, so such a table holds for code points too). A word's hash is a
polynomial over its bytes, from prefix sums modulo 2**64; a window's hash mixes
the hashes of its words, so it does not depend on what stands between them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BASE = 0x9E3779B97F4A7C15
CHUNK_BYTES = 1 << 19


def _byte_codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    """Powers of BASE and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), CHUNK_BYTES)
            up, down = np.full(size, BASE, np.uint64), np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        return self.up[:n], self.down[:n]


_POWERS, _CODES = _Powers(), _byte_codes()


def word_table(stops: str) -> np.ndarray:
    """Table of the bytes that belong to words: all but those of ``stops`` (ASCII)."""
    table = np.ones(256, bool)
    table[list(stops.encode("ascii"))] = False
    assert not table[10], "texts are parted by line feeds"
    return table


@dataclass
class Words:
    """Words of several texts: their places in ``buffer``, their text's number, their hashes."""

    buffer: bytes
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``size`` (at most 256) words inside one text."""
        n = len(self.starts) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        first = np.flatnonzero(self.text[:n] == self.text[size - 1:])
        total = np.full(n, size, np.uint64)
        for i in range(size):
            total += self.hashes[i:i + n] * (_CODES[i] | np.uint64(1))
        return first, mix(total[first])

    def phrase(self, first: int, size: int) -> bytes:
        return b" ".join(self.buffer[self.starts[i]:self.ends[i]] for i in range(first, first + size))


def split_words(texts: list[bytes], table: np.ndarray) -> Words:
    """Words of texts, A-Z in lower case."""
    buffer = b"\n".join(texts).lower()
    data = np.frombuffer(buffer, np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = table[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    up, down = _POWERS.to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * up[:len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    return Words(buffer, starts, ends, np.searchsorted(offsets, starts, side="right") - 1, hashes, offsets)


def chunks(texts: list, size: int = CHUNK_BYTES):
    """(first index, texts as bytes) of runs of texts with about ``size`` bytes; null is empty."""
    start, held, total = 0, [], 0
    for i, text in enumerate(texts):
        data = b"" if text is None else text.encode("utf-8", "surrogatepass") if isinstance(text, str) else bytes(text)
        if held and total + len(data) > size:
            yield start, held
            start, held, total = i, [], 0
        held.append(data)
        total += len(data)
    if held:
        yield start, held
