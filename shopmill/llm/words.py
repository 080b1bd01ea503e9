"""Words of many texts at once, and hashes of runs of words, with numpy over Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Space and the control characters 9 to 13.
BLANKS = bytes([32, 9, 10, 11, 12, 13])
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bytes of a word that are hashed with all others at once; longer words are hashed one by one.
SHORT = 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Rabin-Karp hashes are polynomials modulo this prime, at two bases that have nothing to do with each other.
PRIME = (1 << 61) - 1
BASES = (0x16E8FEB86659FD93, 0x0B9B2D2E6C5A8F47)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def reduced(x: np.ndarray) -> np.ndarray:
    """64-bit values modulo the prime."""
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(61))
    return np.where(x >= np.uint64(PRIME), x - np.uint64(PRIME), x)


def times(x: np.ndarray, factor: int) -> np.ndarray:
    """Values below the prime times one factor below it, not yet reduced: below 2^64, and right modulo the prime."""
    half, low = np.uint64(31), np.uint64((1 << 31) - 1)
    a, b = x >> half, x & low
    c, d = np.uint64(factor >> 31), np.uint64(factor & int(low))
    middle = a * d + b * c
    # 2^61 is 1 here, so 2^62 is 2, and 2^31 times the middle's bits from 30 on are those bits.
    return ((a * c) << np.uint64(1)) + (middle >> np.uint64(30)) + ((middle & np.uint64((1 << 30) - 1)) << half) + b * d


class Texts:
    """The words of a column of texts: where they stand, their hashes, and each text's first word.

    ``starts`` and ``ends`` are places in ``data``; text ``i`` has the words
    ``first[i]`` to ``first[i + 1]``. A null text has no words. Words that are
    equal (but for the case of A to Z, with ``lower``) have equal hashes.
    """

    def __init__(self, column: pa.Array, lower: bool):
        offsets, self.data = buffers(column)
        blank = np.zeros(256, bool)
        blank[list(BLANKS)] = True
        inside = ~blank[self.data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        # A text's ends part words, too.
        edges = offsets[(offsets > 0) & (offsets < len(inside))]
        opens[edges] = inside[edges]
        closes[edges - 1] = inside[edges - 1]
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.hashes = self._hash(lower)

    def __len__(self) -> int:
        return len(self.first) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def _hash(self, lower: bool) -> np.ndarray:
        """Hashes of the words: eight bytes after another for short ones, xxh3 for long ones."""
        # A word is read in eights, so the last one needs room behind it.
        data = np.zeros(len(self.data) + 8, np.uint8)
        data[: len(self.data)] = np.frombuffer(LOWER, np.uint8)[self.data] if lower else self.data
        eights = np.ndarray(len(self.data) + 1, "<u8", data, 0, (1,))
        sizes = self.ends - self.starts
        out = np.zeros(len(sizes), np.uint64)
        which = np.flatnonzero(sizes <= SHORT)
        at, left = self.starts[which], sizes[which]
        own = left.astype(np.uint64) * _ODD
        for _ in range(0, SHORT, 8):
            unused = (8 * (8 - np.minimum(left, 8))).astype(np.uint64)
            own = mix(own ^ ((eights[at] << unused) >> unused))
            more = left > 8
            out[which[~more]] = own[~more]
            which, at, left, own = which[more], at[more] + 8, left[more] - 8, own[more] * _ODD
            if not len(which):
                break
        for i in np.flatnonzero(sizes > SHORT).tolist():
            out[i] = xxhash.xxh3_64_intdigest(data[self.starts[i] : self.ends[i]])
        return out


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string or binary column; a null has no bytes."""
    column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    own = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    return own - own[0], np.frombuffer(data, np.uint8)[own[0] : own[-1]]


def windows(hashes: np.ndarray, k: int, base: int = BASES[0]) -> np.ndarray:
    """Rabin-Karp hashes of all runs of ``k`` values, put together from runs of powers of two, spread over 64 bits."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    run, size, out, done = reduced(hashes), 1, None, 0
    while True:
        power = pow(base, size, PRIME)
        if k & size:
            part = run[done : done + n]
            out = part.copy() if out is None else reduced(reduced(times(out, power)) + part)
            done += size
        if 2 * size > k:
            return mix(out)
        run = reduced(reduced(times(run[: len(run) - size], power)) + run[size:])
        size *= 2


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``limit`` bytes of a column, or of a single row."""
    for batch in batches:
        ends = np.cumsum(np.diff(buffers(batch.column(column))[0]))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to
