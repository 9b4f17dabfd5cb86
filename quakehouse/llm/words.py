"""Words of whole texts as hash arrays, for the shingle operators.

A word is a run of bytes other than 0x20 and 0x09-0x0D, with A-Z lowered. All
texts of a block are hashed at once from their UTF-8 bytes; no Python loop runs
over words. Shingle hashes are 64-bit, so two different shingles are taken for
one with a chance of about 1e-19 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.zeros(256, dtype=bool)
_GAP[[32, *range(9, 14)]] = True
_CODE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: bytes of text hashed at once
BLOCK = 2_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (a bijection, so distinct values stay distinct)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int]]:
    """(first row, end) of runs of rows with about BLOCK bytes in all; a longer text is a block of its own."""
    lens = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    first, total = 0, 0
    for i, n in enumerate(lens):
        if i > first and total + n > BLOCK:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(lens):
        yield first, len(lens)


class Words:
    """Hash, start and end byte of each word of some texts, and the first word of each text."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.origin = np.cumsum(sizes + 1) - sizes - 1
        self.raw = raw
        gap = _GAP[raw]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if len(raw) and not gap[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[0::2], edge[1::2]  # the last byte is a gap, so each run ends
        size = self.end - self.start
        if len(size):
            # a word's hash: the sum of code(byte) * base ** place, over all its bytes
            inside = np.flatnonzero(~gap)
            place = np.arange(len(inside)) - np.repeat(np.cumsum(size) - size, size)
            power = np.cumprod(np.full(int(size.max()), _BASE, dtype=np.uint64))
            value = _CODE[_LOWER[raw[inside]]] * power[place]
            self.hash = mix(np.add.reduceat(value, np.cumsum(size) - size))
        else:
            self.hash = np.zeros(0, np.uint64)
        self.first = np.concatenate((np.searchsorted(self.start, self.origin), [len(self.start)]))

    def shingles(self, n: int) -> np.ndarray:
        """For each word the hash of the n words from there (across text ends too; callers cut there)."""
        out = self.hash.copy()
        for k in range(1, n):
            out[:len(out) - k] = mix(out[:len(out) - k] * _M1 + self.hash[k:])
        return out

    def of(self, i: int) -> slice:
        return slice(self.first[i], self.first[i + 1])


def shingle_set(words: np.ndarray, grams: np.ndarray, n: int) -> np.ndarray:
    """Distinct n-word shingles of one text; with fewer words the whole sequence is one. Sorted."""
    if len(words) >= n:
        return np.unique(grams[:len(words) - n + 1])
    if not len(words):
        return np.zeros(0, np.uint64)
    h = words[0]
    with np.errstate(over="ignore"):
        for w in words[1:]:
            h = mix(np.array([h * _M1 + w], np.uint64))[0]
        return mix(np.array([h + np.uint64(len(words))], np.uint64))


def texts_of(batch: pa.RecordBatch, column: int, first: int, end: int) -> list[bytes]:
    return [t or b"" for t in batch.column(column).slice(first, end - first).cast(pa.binary()).to_pylist()]
