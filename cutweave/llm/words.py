"""Words of text columns as arrays: bounds and 64-bit hashes of all words of a batch at once, inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_END = np.zeros(256, bool)
_END[list(b".!?")] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_WINDOW = 1 << 20
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, _WINDOW + 4096), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


@dataclass
class Words:
    """raw: the bytes, lower-cased; start, end: bounds of each word; doc: its row; first: for each row, the number of its first
    word, and the number of all words at the end."""

    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    text: np.ndarray

    def hashes(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """A hash of each word's bytes, or of the given spans, which must not overlap and must ascend."""
        start, end = (self.start, self.end) if start is None else (start, end)
        out = np.zeros(len(start), np.uint64)
        cuts = np.searchsorted(start, np.arange(0, len(self.raw) + _WINDOW, _WINDOW))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a < b:
                s, e = start[a:b] - start[a], end[a:b] - start[a]
                seg = self.raw[start[a] : end[b - 1]]
                power, inverse = _power_tables(len(seg) + 1)
                total = np.zeros(len(seg) + 1, np.uint64)
                np.cumsum((seg.astype(np.uint64) + np.uint64(1)) * power[: len(seg)], out=total[1:])
                out[a:b] = mix((total[e] - total[s]) * inverse[s])
        return out

    def stripped(self) -> tuple[np.ndarray, np.ndarray]:
        """The words' bounds without ASCII punctuation at either side; empty where nothing else is left."""
        start, end = self.start.copy(), self.end.copy()
        at = np.arange(len(start))
        while len(at := at[(start[at] < end[at])]) and len(at := at[_PUNCT[self.raw[end[at] - 1]]]):
            end[at] -= 1
        at = np.arange(len(start))
        while len(at := at[(start[at] < end[at])]) and len(at := at[_PUNCT[self.raw[start[at]]]]):
            start[at] += 1
        return start, end

    def sentences(self) -> np.ndarray:
        """For each word, whether it begins a sentence: first of a row, or after ., ! or ? at a word's end, or on a new line."""
        begins = np.zeros(len(self.start), bool)
        if len(begins):
            lines = np.concatenate([[0], np.cumsum(self.raw == 10)])
            begins[self.first[:-1][self.first[:-1] < self.first[1:]]] = True
            begins[1:] |= _END[self.raw[self.end[:-1] - 1]] | (lines[self.start[1:]] > lines[self.end[:-1]])
        return begins


def words_of(texts: pa.Array) -> Words:
    """The words of a string array; NULL counts as empty."""
    texts = pa.array(texts.fill_null("")).cast(pa.large_string()) if texts.null_count else texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    text = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0] if len(texts) else np.zeros(1, np.int64)
    inside = ~_SPACE[text]
    begin, finish = inside.copy(), inside.copy()
    edge = np.zeros(len(text) + 1, bool)
    edge[offsets] = True
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    finish[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    first = np.searchsorted(start, offsets)
    return Words(_LOWER[text], start, end, np.repeat(np.arange(len(texts)), np.diff(first)), first, text)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about most bytes; one row at least."""
    sizes = batch.column(column).cast(pa.large_string())
    offsets = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset : sizes.offset + len(sizes) + 1]
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
