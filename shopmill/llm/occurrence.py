"""T-occurrence search: sets that hold at least T of a query set's elements (DivideSkip)."""

from __future__ import annotations

import heapq
import math

import numpy as np

#: Weighs a binary probe of a long list against reading a short one.
PROBE_COST = 0.01
#: Entries up to which lists are merged with a heap; longer ones by a run-merging sort.
HEAP_ENTRIES = 2048


class Search:
    """Links between sets whose Jaccard similarity is ``percent`` or more, as components.

    ``sizes`` are the sets' sizes; ``sets`` hold the elements that other sets
    may share (elements of a single set may be left out, they do not count in
    an intersection). ``roots`` are components known before. The sets are
    queries one after another, smallest first, against an inverted index of
    those before them; members of a query's own component are passed over,
    which loses no component.
    """

    def __init__(self, sizes: np.ndarray, sets: list[np.ndarray], roots: np.ndarray, percent: int = 75):
        self.order = np.argsort(sizes, kind="stable")
        self.sizes = sizes[self.order].astype(np.int64)
        self.percent = percent
        sets = [sets[i] for i in self.order]
        lengths = np.array([len(s) for s in sets], np.int64)
        values = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        owners = np.repeat(np.arange(len(sets)), lengths)
        _, lists, counts = np.unique(values, return_inverse=True, return_counts=True)
        shared = counts[lists] > 1
        # Lists of one entry lead nowhere.
        number = np.cumsum(counts > 1) - 1
        lists, owners = number[lists[shared]], owners[shared]
        self.lists = np.split(lists, np.searchsorted(owners, np.arange(1, len(sets))))
        by_list = np.argsort(lists, kind="stable")
        self.entries = owners[by_list]
        self.keys = lists[by_list] * len(sets) + self.entries
        self.bounds = np.concatenate([[0], np.cumsum(counts[counts > 1])])
        self.group = np.unique(roots[self.order], return_inverse=True)[1]

    def needed(self, size: int, other: int) -> int:
        """The least intersection of two sets of these sizes that are similar enough."""
        p = self.percent
        return -(-p * (size + other) // (100 + p))

    def run(self) -> np.ndarray:
        """A component number for each set, in the order given."""
        for x in range(len(self.sizes)):
            self._query(x)
        out = np.empty(len(self.order), np.int64)
        out[self.order] = self.group
        return out

    def _query(self, x: int) -> None:
        size, lists = int(self.sizes[x]), self.lists[x]
        least = -(-self.percent * size // 100)
        if len(lists) < least:
            return
        low = int(np.searchsorted(self.sizes, least))
        if low >= x:
            return
        lengths = self.bounds[lists + 1] - self.bounds[lists]
        lists = lists[np.argsort(lengths, kind="stable")]
        longest = int(lengths.max())
        skip = min(least - 1, int(least / (PROBE_COST * math.log2(longest) + 1)))
        short, long = lists[: len(lists) - skip], lists[len(lists) - skip :]
        self._near_misses(x, low, short, lists)
        found, counts = self._merge(short, x, low)
        for y, count in sorted(zip(found.tolist(), counts.tolist()), key=lambda f: -f[1]):
            need = self.needed(size, int(self.sizes[y]))
            if count + skip >= need and self.group[y] != self.group[x] and count + self._probe(y, long) >= need:
                self._join(x, y)

    def _near_misses(self, x: int, low: int, short: np.ndarray, lists: np.ndarray) -> None:
        """Try the set before x in a few lists: a copy is mostly found at once, and its component then passed over."""
        for k in short[:3]:
            at = int(np.searchsorted(self.keys, k * len(self.sizes) + x)) - 1
            if at < self.bounds[k] or (y := int(self.entries[at])) < low or self.group[y] == self.group[x]:
                continue
            if self._probe(y, lists) >= self.needed(int(self.sizes[x]), int(self.sizes[y])):
                self._join(x, y)

    def _merge(self, short: np.ndarray, x: int, low: int) -> tuple[np.ndarray, np.ndarray]:
        """Sets before x, of other components, in the short lists, and in how many."""
        begins, sizes = self.bounds[short], self.bounds[short + 1] - self.bounds[short]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(begins - (ends - sizes), sizes)
        entries = self.entries[at]
        there = (entries < x) & (entries >= low) & (self.group[entries] != self.group[x])
        left = np.add.reduceat(there, ends - sizes)
        entries = entries[there]
        if len(entries) <= HEAP_ENTRIES:
            runs = [r.tolist() for r in np.split(entries, np.cumsum(left)[:-1]) if len(r)]
            entries = np.array(list(heapq.merge(*runs)), np.int64)
        else:
            entries = np.sort(entries, kind="stable")
        heads = np.flatnonzero(np.diff(entries, prepend=-1))
        return entries[heads], np.diff(heads, append=len(entries))

    def _probe(self, y: int, lists: np.ndarray) -> int:
        """In how many of the lists set y stands, by binary search."""
        wanted = lists * len(self.sizes) + y
        at = np.searchsorted(self.keys, wanted)
        return int((self.keys[np.minimum(at, len(self.keys) - 1)] == wanted).sum())

    def _join(self, x: int, y: int) -> None:
        self.group[self.group == self.group[x]] = self.group[y]
