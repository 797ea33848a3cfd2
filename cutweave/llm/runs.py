"""Runs of bytes of a class in text columns: bounds of all runs of a batch at once, and the runs as one string array, inside tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: A-Z, a-z and all that is not ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True
#: Letters and 0-9.
ALNUM = LETTERS.copy()
ALNUM[48:58] = True


@dataclass
class Runs:
    """raw: the bytes, A-Z lower-cased; start, end: bounds of each run; doc: its row; first: for each row, the number of its
    first run, and the number of all runs at the end; text: each row's first byte, and the number of all bytes at the end."""

    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    text: np.ndarray
    inside: np.ndarray

    def strings(self) -> pa.Array:
        """Each run as a string."""
        offsets = np.zeros(len(self.start) + 1, np.int64)
        np.cumsum(self.end - self.start, out=offsets[1:])
        return pa.LargeStringArray.from_buffers(len(self.start), pa.py_buffer(offsets), pa.py_buffer(self.raw[self.inside]))


def runs_of(texts: pa.Array, kind: np.ndarray) -> Runs:
    """The longest runs of bytes of a kind in a string array; NULL counts as empty."""
    texts = pa.array(texts.fill_null("")).cast(pa.large_string()) if texts.null_count else texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    text = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = kind[text]
    begin, finish = inside.copy(), inside.copy()
    edge = np.zeros(len(text) + 1, bool)
    edge[offsets] = True
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    finish[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    first = np.searchsorted(start, offsets)
    return Runs(_LOWER[text], start, end, np.repeat(np.arange(len(texts)), np.diff(first)), first, offsets, inside)
