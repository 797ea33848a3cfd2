"""An FM-index over one shard's symbols: suffixes sorted, their last symbols in a wavelet tree, every SAMPLE-th position kept.

Phrases are searched backwards, all at once: each step takes one symbol of every phrase and narrows its range of suffixes by two
ranks. A range's places are found by walking to the nearest kept position. All is vectorised over phrases and occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: One position in so many is kept.
SAMPLE = 16
#: Occurrences that are located together.
TOGETHER = 1 << 19


def suffixes(text: np.ndarray) -> np.ndarray:
    """Starts of text's suffixes in their order, by doubling: only suffixes that still tie are sorted again."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    slots, key, rank, reach = np.arange(n), text[order].astype(np.int64), np.empty(n, np.int64), 1
    while len(slots):
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        heads = np.maximum.accumulate(np.where(new, slots, 0))
        rank[order[slots]] = heads  # the first slot of its ties
        alone = new.copy()
        alone[:-1] &= new[1:]
        slots, heads = slots[~alone], heads[~alone]
        tied = order[slots]
        after = tied + reach
        follow = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = heads * (n + 1) + follow
        by = np.argsort(key)
        order[slots], key, reach = tied[by], key[by], 2 * reach
    return order


class Bits:
    """A bit row with ranks: ones before each 64 bits are stored, the rest is counted."""

    def __init__(self, bit: np.ndarray):
        packed = np.packbits(bit, bitorder="little")
        self.words = np.zeros(len(bit) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])
        self.ones = int(self.before[-1])
        self.zeros = len(bit) - self.ones

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each i."""
        at, low = i >> 6, (i & 63).astype(np.uint64)
        return self.before[at] + np.bitwise_count(self.words[at] & ((np.uint64(1) << low) - np.uint64(1)))

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class FMIndex:
    """text: symbols from 1 to symbols - 1; 0 is the end's own."""

    def __init__(self, text: np.ndarray, symbols: int):
        text = np.append(text, 0).astype(np.int64)
        order = suffixes(text)
        row = text[order - 1]
        self.n, self.levels, self.planes = len(text), max(1, int(symbols - 1).bit_length()), []
        self.less = np.zeros(symbols + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=symbols), out=self.less[1:])
        kept = order % SAMPLE == 0
        self.kept, self.places = Bits(kept), order[kept]
        for level in range(self.levels - 1, -1, -1):
            bit = (row >> level & 1).astype(bool)
            self.planes.append(Bits(bit))
            row = np.concatenate([row[~bit], row[bit]])
        self.origin = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, plane in zip(range(self.levels - 1, -1, -1), self.planes, strict=True):
            ones = plane.rank(i)
            i = np.where(symbol >> level & 1, plane.zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol is among the last symbols of the first i suffixes."""
        return self._down(symbol, i) - self.origin[symbol]

    def before(self, i: np.ndarray) -> np.ndarray:
        """The suffix that begins one symbol earlier, for each suffix i."""
        symbol, at = np.zeros(len(i), np.int64), i
        for plane in self.planes:
            bit, ones = plane.get(at), plane.rank(at)
            symbol, at = symbol << 1 | bit, np.where(bit, plane.zeros + ones, at - ones)
        return self.less[symbol] + at - self.origin[symbol]

    def find(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each phrase. A phrase stands at the right end of its row."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for step in range(phrases.shape[1]):
            live = live[(lengths[live] > step) & (lo[live] < hi[live])]
            if not len(live):
                break
            symbol = phrases[live, phrases.shape[1] - 1 - step]
            both = self.rank(np.concatenate([symbol, symbol]), np.concatenate([lo[live], hi[live]]))
            lo[live], hi[live] = self.less[symbol] + both[: len(live)], self.less[symbol] + both[len(live) :]
        return lo, hi

    def locate(self, i: np.ndarray) -> np.ndarray:
        """Where each suffix begins in the text."""
        at, place, steps, left = i, np.empty(len(i), np.int64), 0, np.arange(len(i))
        while len(left):
            known = self.kept.get(at)
            place[left[known]] = self.places[self.kept.rank(at[known])] + steps
            left, at = left[~known], self.before(at[~known])
            steps += 1
        return place

    def occurrences(self, phrases: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(number of a phrase, its place) of all occurrences, in parts of at most TOGETHER."""
        lo, hi = self.find(phrases, lengths)
        some = np.flatnonzero(lo < hi)
        total = np.concatenate([[0], np.cumsum(hi[some] - lo[some])])
        for a in range(0, int(total[-1]), TOGETHER):
            k = np.arange(a, min(a + TOGETHER, int(total[-1])))
            of = np.searchsorted(total, k, "right") - 1
            yield some[of], self.locate(lo[some][of] + k - total[of])
