"""Token ids of texts by a public byte-level BPE file, inside tasks.

Byte-level BPE splits a text before each single space that stands between two non-space characters, and the parts are encoded
independently; so texts are cut there and the ids of a part are kept. Texts with other runs of white space are encoded whole.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np

TOKENIZER = "byte_bpe_50k.json"
#: Parts whose ids are kept in each Python worker. Beyond it the store starts anew; this bounds memory, not the result.
KEPT = 1_000_000
_PACK = [struct.Struct(f"<{n}H").pack for n in range(32)]
_loaded: dict[str, "Encoder"] = {}


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.newline = self._whole("\n")
        self.marks = {m: self._whole(m) for m in ".,"}
        self.word = self.tokenizer.model.tokenize
        # the model's own letters for bytes: those of ASCII letters are the letters themselves
        (space, _), = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(" ")
        self.space = space
        self.latin = {b: ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(b))[0][0] for b in range(0x80, 0x250)}
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2").tobytes()

    def _learn(self, part: str) -> bytes | None:
        """The ids of a part; None if it is empty or holds white space besides the line end that it begins with.

        Latin letters, with a comma or full stop after them or not, are one unit for the model, and the mark another.
        """
        line = part[:1] == "\n"
        word = part[1:] if line else part
        stem = word if word.isalpha() else word[:-1]
        mark = b"" if stem is word else self.marks.get(word[-1:])
        if mark is not None and stem.isalpha() and (stem.isascii() or max(stem) < "\u0250"):
            if mark and (ids := self.known.get("\n" + stem if line else stem)):
                return ids + mark
            ids = [t.id for t in self.word(("" if line else self.space) + (stem if stem.isascii() else stem.translate(self.latin)))]
            return (self.newline if line else b"") + _PACK[len(ids)](*ids) + mark if len(ids) < len(_PACK) else self._whole(part if line else " " + part)
        if word.split() != [word]:
            return None
        return self._whole(part if line else " " + part)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 16-bit integers."""
        if len(self.known) > KEPT:
            self.known = {}
        known, out = self.known, []
        for text in texts:
            if not text:
                out.append(b"")
                continue
            # a part that begins a line is known by the line end before it, any other by itself
            parts = text.replace("\n", " \n").split(" ")
            first, parts[0] = parts[0], parts[-1]
            ids = list(map(known.get, parts))
            whole, at = len(first.split()) != 1 or len(first.strip()) != len(first), -1
            for _ in range(0 if whole else ids.count(None)):
                at = ids.index(None, at + 1)
                if (got := known.get(parts[at]) or self._learn(parts[at])) is None:
                    whole = True
                    break
                known[parts[at]] = ids[at] = got
            if whole:
                out.append(self._whole(text))
            else:
                ids[0] = self._whole(first)
                out.append(b"".join(ids))
        return out


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file, loaded once."""
    if path not in _loaded:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _loaded[path] = Encoder(path)
    return _loaded[path]


def release() -> None:
    """Lets go of the encoders that a reused worker holds, for operators that need the memory."""
    _loaded.clear()


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def in_pieces(values: list, sizes: list[int], most: int) -> Iterator[slice]:
    """Consecutive slices of at most most in sum, or of one value that is larger."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(values):
        yield slice(start, len(values))
