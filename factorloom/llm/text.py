"""Texts as byte arrays inside tasks: words, word hashes and window hashes with numpy.

A batch of texts is looked at as one UTF-8 buffer.  Words are maximal runs of bytes outside a
set of separators; every byte of 0x80 and above belongs to a word, so a word never starts or
ends inside a character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# The separators of the two word rules, as bytes.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
NON_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
# Odd multipliers of the polynomial hashes, modulo 2^64.
_BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
_BLOCK = 1 << 20


def inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1), modulo 2^64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its texts; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.zeros(0, np.uint8) if raw is None else np.frombuffer(raw, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


class Words:
    """The words of several texts: byte spans, and how many each text has.

    ``first[i]`` is the number of words before text ``i``; ``lower`` turns A-Z into a-z.
    """

    def __init__(self, column: pa.Array, separators: bytes, lower: bool):
        data, offsets = buffer_of(column)
        if lower:
            data = _LOWER[data]
        apart = np.zeros(256, dtype=bool)
        apart[np.frombuffer(separators, dtype=np.uint8)] = True
        gap = apart[data]
        before = np.empty(len(data) + 1, dtype=bool)
        before[0] = True
        before[1:] = gap
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        opens = before[:-1].copy()
        opens[inner] = True
        closes = np.empty(len(data), dtype=bool)
        closes[:-1] = gap[1:]
        closes[-1:] = True
        closes[inner - 1] = True
        self.data = data
        self.starts = np.flatnonzero(opens & ~gap)
        self.ends = np.flatnonzero(closes & ~gap) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word, equal for equal words in any batch.

        Computed from running sums of byte times power, a block of words at a time.
        """
        out = np.empty(len(self), dtype=np.uint64)
        if not len(self):
            return out
        cuts = [0]
        while cuts[-1] < len(self):
            here = int(np.searchsorted(self.ends, self.starts[cuts[-1]] + _BLOCK, "right"))
            cuts.append(max(here, cuts[-1] + 1))
        size = int(max(self.ends[b - 1] - self.starts[a] for a, b in zip(cuts, cuts[1:])))
        up, down = powers(_BYTE_BASE, size), powers(inverse(_BYTE_BASE), size)
        for a, b in zip(cuts, cuts[1:]):
            low, high = self.starts[a], self.ends[b - 1]
            sums = np.zeros(high - low + 1, dtype=np.uint64)
            np.cumsum((self.data[low:high].astype(np.uint64) + np.uint64(1)) * up[:high - low],
                      out=sums[1:])
            start, end = self.starts[a:b] - low, self.ends[a:b] - low
            out[a:b] = mix((sums[end] - sums[start]) * down[start]
                           + (end - start).astype(np.uint64))
        return out

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """All words with one space after each, and the n + 1 offsets of the words in that."""
        lengths = self.ends - self.starts
        offsets = np.zeros(len(self) + 1, dtype=np.int64)
        np.cumsum(lengths + 1, out=offsets[1:])
        out = np.full(int(offsets[-1]), 0x20, dtype=np.uint8)
        inside = np.zeros(len(self.data) + 1, dtype=np.int8)
        inside[self.starts] = 1
        inside[self.ends] -= 1
        target = np.ones(len(out), dtype=bool)
        target[offsets[1:] - 1] = False
        out[target] = self.data[np.cumsum(inside[:-1]).astype(bool)]
        return out, offsets


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of all windows of ``width`` items inside one text, and their hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    last = np.repeat(first[1:], np.diff(first))
    starts = np.flatnonzero(np.arange(n) + width <= last[:n])
    if width <= 8:
        total = np.zeros(n, dtype=np.uint64)
        for j, p in enumerate(powers(_WORD_BASE, width)):
            total += hashes[j:j + n] * p
        return starts, mix(total[starts])
    up, down = powers(_WORD_BASE, len(hashes)), powers(inverse(_WORD_BASE), n)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up, out=sums[1:])
    return starts, mix((sums[starts + width] - sums[starts]) * down[starts])


def pieces(column: pa.Array, limit: int = 4 << 20):
    """Row ranges of a batch that hold about ``limit`` bytes of text, one row at least."""
    sizes = np.cumsum(np.diff(buffer_of(column)[1]))
    a = 0
    while a < len(sizes):
        b = int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + limit, "right"))
        b = max(b, a + 1)
        yield a, b
        a = b
