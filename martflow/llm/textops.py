"""Array helpers that the text operators share inside their tasks.

Texts are handled as UTF-8 bytes in one numpy array per chunk of documents;
a chunk holds about ``CHUNK_BYTES`` (a longer text is a chunk of its own), so
the arrays made from it stay small whatever the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 256 << 10
U64 = np.uint64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fill_text(column: pa.Array) -> pa.Array:
    """The texts of a batch as large strings; null counts as empty."""
    return pc.fill_null(pc.cast(column, pa.large_string()), "")


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of the rows) per chunk."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[texts.offset:texts.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + CHUNK_BYTES, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes as they are."""
    return _LOWER[data]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the whole 64-bit word."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class SubstringHash:
    """64-bit hashes of any substrings of one byte array, in constant time each.

    A polynomial hash modulo 2**64 with an odd base: prefix sums of
    ``value[byte] * base**i`` are differenced and divided by ``base**start``.
    Equal substrings have equal hashes; callers confirm hits on the bytes.
    """

    BASE = 0x9E3779B97F4A7C15 | 1
    INVERSE = pow(BASE, -1, 1 << 64)
    VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))
    _powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, U64), np.ones(1, U64))

    @classmethod
    def powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls._powers[0]) < n:
            def series(base: int) -> np.ndarray:
                steps = np.full(n, base, dtype=U64)
                steps[0] = 1
                return np.multiply.accumulate(steps)
            made = series(cls.BASE), series(cls.INVERSE)
            if n > 4 * CHUNK_BYTES:
                return made  # a giant text: not kept
            cls._powers = made
        return cls._powers

    def __init__(self, data: np.ndarray):
        n = len(data)
        power, self.inverse = self.powers(n + 1)
        self.sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(self.VALUES[data] * power[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(U64))


def word_spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of word bytes, never across two rows, and the
    index of each row's first word (one more entry: the number of words)."""
    n = len(is_word)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    first = is_word.copy()
    first[1:] &= ~is_word[:-1]
    last = is_word.copy()
    last[:-1] &= ~is_word[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    first[edges] = is_word[edges]
    last[edges - 1] = is_word[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def signed(h: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit words as Spark's long."""
    return h.astype(U64, copy=False).view(np.int64)


def sliding_min_positions(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values, the index of its smallest (the
    rightmost of equal ones); one entry per window."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = values[:n].copy(), np.arange(n)
    for j in range(1, width):
        v = values[j:j + n]
        better = v <= best
        best[better] = v[better]
        at[better] = np.flatnonzero(better) + j
    return at
