"""Canonical Huffman codes of bounded length over token ids, packed and read with numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: The longest code; a decoding table has two to this power entries.
MAX_BITS = 20


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Best code lengths up to ``limit`` bits for ids with these counts, by package-merge.

    An id that never occurs has length 0; a single id has length 1.
    """
    present = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(present)
    if n <= 1:
        lengths[present] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} ids need codes of more than {limit} bits")
    order = present[np.argsort(counts[present], kind="stable")]
    weights = np.asarray(counts, np.int64)[order]
    level, leaves = weights, []
    for _ in range(limit - 1):
        leaves.append(np.arange(len(level)) < n if level is weights else is_leaf)
        packages = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([weights, packages])
        by_weight = np.argsort(merged, kind="stable")
        is_leaf = by_weight < n
        level = merged[by_weight]
    leaves.append(np.ones(n, bool) if level is weights else is_leaf)
    found, take = np.zeros(n, np.int64), 2 * (n - 1)
    for is_leaf in reversed(leaves):
        chosen = int(is_leaf[:take].sum())
        found[:chosen] += 1
        take = 2 * (take - chosen)
    lengths[order] = found
    return lengths


@dataclass
class Code:
    """Canonical code words by id, and the table that decodes them."""

    lengths: np.ndarray
    max_bits: int = MAX_BITS

    def __post_init__(self):
        ids = np.flatnonzero(self.lengths)
        ids = ids[np.argsort(self.lengths[ids], kind="stable")]
        widths = self.lengths[ids].astype(np.int64)
        spans = np.left_shift(1, self.max_bits - widths)
        firsts = np.concatenate([[0], np.cumsum(spans)])
        self.words = np.zeros(len(self.lengths), np.uint64)
        self.words[ids] = firsts[:-1] >> (self.max_bits - widths)
        size = 1 << self.max_bits
        self.table_id = np.zeros(size, np.uint32)
        self.table_bits = np.ones(size, np.uint8)
        self.table_id[: firsts[-1]] = np.repeat(ids, spans)
        self.table_bits[: firsts[-1]] = np.repeat(widths, spans)

    def encode(self, ids: np.ndarray, every: int) -> tuple[bytes, np.ndarray]:
        """The packed bits, and the bit offset of each ``every``-th id."""
        widths = self.lengths[ids].astype(np.int64)
        ends = np.cumsum(widths)
        starts = ends - widths
        bits = int(ends[-1]) if len(ends) else 0
        packed = np.zeros(bits // 32 + 2, np.uint64)
        slot, shift = starts >> 5, (64 - (starts & 31) - widths).astype(np.uint64)
        placed = self.words[ids] << shift
        # Ids of one 32-bit slot are neighbours, and their bits do not overlap.
        heads = np.flatnonzero(np.diff(slot, prepend=-1))
        if len(heads):
            sums = np.bitwise_or.reduceat(placed, heads)
            packed[slot[heads]] |= sums >> np.uint64(32)
            packed[slot[heads] + 1] |= sums & np.uint64(0xFFFFFFFF)
        return packed.astype(">u4").tobytes()[: (bits + 7) // 8], starts[::every]

    def decode(self, payloads: list[bytes], offsets: list[np.ndarray], counts: list[int], every: int) -> list[np.ndarray]:
        """The ids of several blocks; all checkpointed runs advance together."""
        sizes = np.array([len(p) for p in payloads], np.int64)
        base = np.concatenate([[0], np.cumsum(sizes)[:-1]]) * 8
        data = np.frombuffer(b"".join([*payloads, bytes(8)]), np.uint8).astype(np.uint32)
        window = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
        runs = [len(o) for o in offsets]
        at = np.concatenate([o + b for o, b in zip(offsets, base)]).astype(np.int64)
        left = np.concatenate([np.minimum(every, c - every * np.arange(r)) for c, r in zip(counts, runs)])
        last = (len(window) - 1) * 8
        out = np.zeros((every, len(at)), np.uint32)
        drop = np.uint32(32 - self.max_bits)
        for step in range(int(left.max(initial=0))):
            at = np.minimum(at, last)
            index = (window[at >> 3] << (at & 7).astype(np.uint32)) >> drop
            out[step] = self.table_id[index]
            at += self.table_bits[index]
        flat = out.T[np.arange(every)[None, :] < left[:, None]]
        return np.split(flat, np.cumsum(counts)[:-1])
