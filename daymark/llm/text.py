"""Words of Arrow text columns as numpy arrays, and 64-bit hashes of word windows.

Everything works on the UTF-8 bytes of many texts at once. A word is a maximal
run of the bytes that a table of 256 flags marks; only A-Z are lower-cased.
Null texts count as empty. Memory is bounded by the callers, who hand in
slices of at most ``SLICE_BYTES`` (one longer text is a slice of its own).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
SEGMENT = 1 << 22

# Bytes of words `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

# Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z became a-z.
LETTER_OR_DIGIT = np.ones(256, dtype=bool)
LETTER_OR_DIGIT[:0x80] = False
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    LETTER_OR_DIGIT[_low : _high + 1] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


RAW_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * STEP)
BYTE_VALUE = RAW_VALUE[LOWER]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    """Powers of the base and its inverse, as far as any text has needed them."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n >= len(cls.up):
            n = max(n, SLICE_BYTES)
            cls.up, cls.down = _powers(BASE, n), _powers(BASE_INVERSE, n)
        return cls.up, cls.down


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text; a longer text stands alone."""
    offsets = text_offsets(texts)
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), len(texts))
        yield low, high
        low = high


def text_offsets(texts: pa.Array) -> np.ndarray:
    if len(texts) == 0:
        return np.zeros(1, dtype=np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    raw = np.frombuffer(texts.buffers()[1], dtype=kind)
    return raw[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def string_hashes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each string, byte by byte."""
    offsets = text_offsets(strings)
    size = int(offsets[-1] - offsets[0])
    if size == 0:
        none = mix(np.zeros(len(strings), dtype=np.uint64))
        return none, none
    data = np.frombuffer(strings.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    at, to = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    up, down = _Powers.upto(size)
    sums = np.zeros(size + 1, dtype=np.uint64)
    hashes = []
    for values in (RAW_VALUE, mix(RAW_VALUE)):
        np.cumsum(values[data] * up[:size], out=sums[1:])
        hashes.append(mix((sums[to] - sums[at]) * down[at] + (to - at).astype(np.uint64)))
    return hashes[0], hashes[1]


@dataclass
class Words:
    """Words of some texts: text ``d`` has the words ``first[d]`` to ``first[d + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def word(self, i: int) -> bytes:
        return LOWER[self.data[self.starts[i] : self.ends[i]]].tobytes()

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, lower-cased; equal words hash alike everywhere."""
        out = np.empty(len(self), dtype=np.uint64)
        low = 0
        while low < len(self):
            begin = self.starts[low]
            high = int(np.searchsorted(self.starts, begin + SEGMENT))
            high = max(high, low + 1)
            size = int(self.ends[high - 1] - begin)
            up, down = _Powers.upto(size)
            sums = np.zeros(size + 1, dtype=np.uint64)
            np.cumsum(BYTE_VALUE[self.data[begin : begin + size]] * up[:size], out=sums[1:])
            at, to = self.starts[low:high] - begin, self.ends[low:high] - begin
            out[low:high] = (sums[to] - sums[at]) * down[at]
            low = high
        return mix(out)


def find_words(texts: pa.Array, kept: np.ndarray) -> Words:
    offsets = text_offsets(texts)
    base, size = int(offsets[0]), int(offsets[-1] - offsets[0])
    if size == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(np.zeros(0, np.uint8), none, none, np.zeros(len(offsets), np.int64))
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[base : base + size]
    inside = kept[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    borders = offsets[1:-1] - base
    borders = borders[(borders > 0) & (borders < size)]
    starts[borders] = inside[borders]
    ends[borders - 1] = inside[borders - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets - base))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive values; windows of different sizes differ."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = words[:n].copy()
    for i in range(1, size):
        total *= STEP
        total += words[i : i + n]
    return mix(total + np.uint64(size))
