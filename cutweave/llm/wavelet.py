"""Token ids as wavelet matrices, one compressed file per shard.

File: magic, length of the header, a JSON header, then sections. The alphabet is the ids that the shard holds, the most frequent
first, so that the upper planes are nearly empty; a token is its place there. There is a bit-plane for each bit of a place, most significant first, and each plane orders the tokens by the
bits before it (zeros first, stable). Planes are stored in blocks of BLOCK bits, each compressed alone, with the number of ones
before each block; so access, rank and select touch one block of each plane.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import zstandard

MAGIC = b"CWVM1\0\0\0"
BLOCK = 1 << 16
#: Tokens after which a shard is closed, at the end of a document; a longer document has a shard of its own.
SHARD = 1 << 20


def build(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int], part: int, shard: int) -> bytes:
    """The file of one shard: ids of whole documents one after the other, with their doc ids and lengths."""
    times = np.bincount(ids, minlength=1 << 16)
    alphabet = np.argsort(-times, kind="stable")[: np.count_nonzero(times)]
    place = np.zeros(1 << 16, np.uint16)
    place[alphabet] = np.arange(len(alphabet))
    levels = max(1, int(len(alphabet) - 1).bit_length()) if len(alphabet) else 1
    pack, row, sections, zeros, ones_before, sizes = zstandard.ZstdCompressor(level=1), place[ids], [], [], [], []
    for level in range(levels - 1, -1, -1):
        bit = (row & np.uint16(1 << level)) != 0
        planes = np.packbits(bit, bitorder="little")
        blocks = [pack.compress(planes[i : i + BLOCK // 8].tobytes()) for i in range(0, len(planes), BLOCK // 8)]
        ones = np.add.reduceat(np.bitwise_count(planes), np.arange(0, len(planes), BLOCK // 8), dtype=np.int64) if len(planes) else np.zeros(0, np.int64)
        ones_before.append(np.concatenate([[0], np.cumsum(ones)]).astype(int).tolist())
        sizes.append([len(b) for b in blocks])
        sections += blocks
        zeros.append(len(bit) - ones_before[-1][-1])
        if level:
            row = np.concatenate([row[np.flatnonzero(~bit)], row[np.flatnonzero(bit)]])
    head = json.dumps({"n": len(ids), "levels": levels, "zeros": zeros, "ones": ones_before, "sizes": sizes, "docs": len(lengths), "null_docs": [i for i, d in enumerate(doc_ids) if d is None], "part": part, "shard": shard, "alphabet": len(alphabet)}).encode()
    side = pack.compress(alphabet.astype("<u2").tobytes() + np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array(lengths, "<u8").tobytes())
    return b"".join([MAGIC, struct.pack("<II", len(head), len(side)), head, side, *sections])


def head_of(data: bytes) -> dict:
    """The header alone."""
    return json.loads(data[16 : 16 + struct.unpack_from("<I", data, 8)[0]])


class Shard:
    """A shard read from its file's bytes. Positions count from 0 and ends are exclusive."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a wavelet shard")
        head, side = struct.unpack_from("<II", data, 8)
        self.head = json.loads(data[16 : 16 + head])
        self.data, self.unpack = memoryview(data), zstandard.ZstdDecompressor()
        raw, a, d = self.unpack.decompress(data[16 + head : 16 + head + side]), 2 * self.head["alphabet"], 8 * self.head["docs"]
        self.alphabet = np.frombuffer(raw[:a], "<u2")
        self.turn = np.argsort(self.alphabet)
        nulls = set(self.head["null_docs"])
        self.doc_ids = [None if i in nulls else int(x) for i, x in enumerate(np.frombuffer(raw[a : a + d], "<i8"))]
        self.lengths = np.frombuffer(raw[a + d :], "<u8").astype(np.int64)
        self.starts, at = [], 16 + head + side
        for sizes in self.head["sizes"]:
            self.starts.append([at, *(at + np.cumsum(sizes)).tolist()] if sizes else [at])
            at = self.starts[-1][-1]
        self.block = lru_cache(maxsize=64)(self._block)

    def __len__(self) -> int:
        return self.head["n"]

    def _block(self, plane: int, k: int) -> np.ndarray:
        s = self.starts[plane]
        bits = np.unpackbits(np.frombuffer(self.unpack.decompress(self.data[s[k] : s[k + 1]]), np.uint8), bitorder="little")
        return bits[: min(BLOCK, len(self) - k * BLOCK)]

    def _ones(self, plane: int, i: int) -> int:
        """Ones of a plane before position i."""
        k = i // BLOCK
        return self.head["ones"][plane][k] + (int(np.count_nonzero(self.block(plane, k)[: i % BLOCK])) if i % BLOCK else 0)

    def _find(self, plane: int, bit: int, k: int) -> int:
        """Position of the k-th one (or zero) of a plane, from 0."""
        before = np.asarray(self.head["ones"][plane])
        if not bit:
            before = np.minimum(np.arange(len(before)) * BLOCK, len(self)) - before
        b = int(np.searchsorted(before, k, "right")) - 1
        return b * BLOCK + int(np.flatnonzero(self.block(plane, b) == bit)[k - int(before[b])])

    def _place(self, token: int) -> int | None:
        p = int(np.searchsorted(self.alphabet, token, sorter=self.turn))
        return int(self.turn[p]) if p < len(self.alphabet) and self.alphabet[self.turn[p]] == token else None

    def access(self, i: int) -> int:
        """The token at position i."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        place = 0
        for plane, zeros in enumerate(self.head["zeros"]):
            bit = int(self.block(plane, i // BLOCK)[i % BLOCK])
            ones = self._ones(plane, i)
            place, i = place << 1 | bit, zeros + ones if bit else i - ones
        return int(self.alphabet[place])

    def _range(self, place: int, lo: int, hi: int) -> tuple[int, int]:
        for plane, zeros in enumerate(self.head["zeros"]):
            a, b = self._ones(plane, lo), self._ones(plane, hi)
            lo, hi = (zeros + a, zeros + b) if place >> (self.head["levels"] - 1 - plane) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of token in positions lo to hi."""
        place = self._place(token)
        if place is None:
            return 0
        lo, hi = self._range(place, lo, len(self) if hi is None else hi)
        return hi - lo

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence of token, from 0; -1 if there are fewer."""
        if k < 0 or k >= self.count(token):
            return -1
        place = self._place(token)
        i = self._range(place, 0, 0)[0] + k
        for plane in range(self.head["levels"] - 1, -1, -1):
            bit = place >> (self.head["levels"] - 1 - plane) & 1
            i = self._find(plane, bit, i - self.head["zeros"][plane] if bit else i)
        return i

    def decode(self) -> np.ndarray:
        """All tokens in order."""
        n, row = len(self), np.zeros(len(self), np.uint16)
        for plane in range(self.head["levels"] - 1, -1, -1):
            packed = b"".join(self.unpack.decompress(self.data[s:e]) for s, e in zip(self.starts[plane], self.starts[plane][1:], strict=False))
            bit = np.unpackbits(np.frombuffer(packed, np.uint8), count=n, bitorder="little").view(bool)
            zeros, level = self.head["zeros"][plane], self.head["levels"] - 1 - plane
            if not level:
                row = bit.astype(np.uint16)
                continue
            up = np.empty(n, np.uint16)
            up[np.flatnonzero(~bit)] = row[:zeros]
            up[np.flatnonzero(bit)] = row[zeros:] | np.uint16(1 << level)
            row = up
        return self.alphabet[row] if len(self.alphabet) else row

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc id, start in the shard, ids) of each document."""
        ids, at = self.decode(), 0
        for doc, n in zip(self.doc_ids, self.lengths.tolist(), strict=True):
            yield doc, at, ids[at : at + n]
            at += n


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
