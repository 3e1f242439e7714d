"""Whole texts as numpy arrays: words, their 64-bit hashes, and blocks of documents.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r; ASCII letters are
lower-cased first. Hashes are polynomials over 64-bit byte codes with an odd base,
taken from prefix sums, so a block costs a few passes over its bytes and no
Python work per word. Blocks bound the memory: a block closes once it holds
``BLOCK_BYTES``; one longer document makes a block of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
SHINGLE_WORDS = 5

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CODES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
_CODES[65:91] = _CODES[97:123]  # lower-cases A-Z
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}
#: Only glibc has it; other C libraries return freed memory by themselves.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64, kept between blocks."""
    known = _powers.get(base)
    if known is None or len(known) <= n:
        steps = np.full(max(n + 1, BLOCK_BYTES * 2), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of several documents: start and end bytes, document number and hash of each."""

    def __init__(self, docs: Sequence[bytes]):
        joined = b"\n".join(docs)
        self.raw = np.frombuffer(joined, np.uint8)
        sizes = np.fromiter(map(len, docs), np.int64, len(docs))
        self.doc_start = np.concatenate([[0], np.cumsum(sizes + 1)])
        solid = np.zeros(len(self.raw) + 2, np.int8)
        solid[1:-1] = ~_SPACE[self.raw]
        turn = np.diff(solid)
        self.start, self.end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        #: words of document d are first[d] .. first[d + 1] - 1
        self.first = np.searchsorted(self.start, self.doc_start)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(docs)), self.count)

    def hashes(self) -> np.ndarray:
        n = len(self.raw)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_CODES[self.raw] * _power(_BASE, n)[:n], out=total[1:])
        return mix((total[self.end] - total[self.start]) * _power(_INVERSE, n)[self.start])

    def shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash and document of every 5-word window; a shorter document is one window of all its words."""
        h, k = self.hashes(), SHINGLE_WORDS
        factors = _power(_BASE, k)[1 : k + 1]
        windows = np.zeros(max(len(h) - k + 1, 0), np.uint64)
        for i in range(k):
            windows += mix(h[i : len(h) - k + 1 + i]) * factors[i] if len(windows) else 0
        inside = np.zeros(len(windows), bool)
        if len(windows):
            inside = self.doc[: len(windows)] == self.doc[k - 1 :]
        short = np.flatnonzero((self.count > 0) & (self.count < k))
        whole = np.array([np.sum(mix(h[self.first[d] : self.first[d + 1]]) * factors[: self.count[d]], dtype=np.uint64) for d in short], np.uint64)
        hashes = mix(np.concatenate([windows[inside], whole + np.uint64(1)]))
        return hashes, np.concatenate([self.doc[: len(windows)][inside], short])


def blocks(docs: Sequence[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes together."""
    begin = size = 0
    for i, text in enumerate(docs):
        if size and size + len(text) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(docs):
        yield begin, len(docs)


def slices(batches, rows: int = 256):
    """The batches of a task in parts of few rows: bounds the Python objects that a task holds.

    Parts are copies, so that no batch outlives its own parts, and a worker that goes idle gives its memory back.
    """
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.take(pa.array(np.arange(begin, min(begin + rows, batch.num_rows))))
        del batch
    give_back()


def give_back() -> None:
    """Returns freed memory to the system: of Arrow's pool, and of the C heap that numpy and the tokenizers use."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def as_bytes(column) -> list[bytes]:
    """An Arrow text column as UTF-8 bytes; null counts as empty."""
    return [x or b"" for x in column.cast("binary").to_pylist()]
