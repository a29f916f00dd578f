"""Texts of an Arrow batch as one byte array, its words and hashes of its spans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes handled at a time; a longer text is handled alone.
CHUNK_BYTES = 1 << 20

#: Odd multipliers of the two independent span hashes.
MULTIPLIERS = (0x9E3779B97F4A7C55, 0xC2B2AE3D27D4EB4F)

WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_table() -> np.ndarray:
    """Byte to byte, A-Z to a-z."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def word_table() -> np.ndarray:
    """True for bytes of words: digits, letters and all bytes of non-ASCII characters."""
    table = np.zeros(256, dtype=bool)
    for low, high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
        table[low:high] = True
    return table


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, bytes and offsets of runs of texts of at most ``limit`` bytes, or of one longer text.

    A null is an empty text.
    """
    column = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    ends = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(ends, ends[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[ends[row] : ends[end]], ends[row : end + 1] - ends[row]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and per text the index of its first word (one more entry at the end)."""
    inside = table[data]
    opens, closes = inside.copy(), inside.copy()
    if len(data):
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        filled = offsets[1:] > offsets[:-1]
        first, last = offsets[:-1][filled], offsets[1:][filled] - 1
        opens[first] = inside[first]
        closes[last] = inside[last]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class SpanHashes:
    """Hashes of any spans of a byte (or code point) array, each in constant time."""

    def __init__(self, multiplier: int) -> None:
        self.multiplier = multiplier
        self.inverse = pow(multiplier, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)
        self.sums = np.zeros(1, np.uint64)

    def load(self, data: np.ndarray) -> SpanHashes:
        n = len(data)
        if len(self.powers) < n + 1:
            size = max(n + 1, CHUNK_BYTES + 1)
            for name, base in (("powers", self.multiplier), ("inverses", self.inverse)):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors))
        terms = data.astype(np.uint64)
        terms += np.uint64(1)
        terms *= self.powers[:n]
        self.sums = np.empty(n + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(terms, out=self.sums[1:])
        return self

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))


def word_hash(word: str, multiplier: int = MULTIPLIERS[0]) -> int:
    """The hash that ``SpanHashes.of`` gives for a word."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(SpanHashes(multiplier).load(data).of(np.array([0]), np.array([len(data)]))[0])


def gram_hashes(words: np.ndarray, n: int, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive words, and whether the ``n`` words lie in one text, for every word that can start one."""
    count = max(len(words) - n + 1, 0)
    grams = np.zeros(count, np.uint64)
    for k in range(n):
        grams = mix(grams * np.uint64(3) + words[k : k + count] + np.uint64(k + 1))
    text_end = np.repeat(bounds[1:], np.diff(bounds))[:count]
    return grams, np.arange(count) + n <= text_end
