"""Token ids of whole texts with a byte-level BPE of the tokenizers library.

A byte-level BPE never merges across the borders that its pre-tokenizer sets. Some
borders can be told from neighbouring bytes alone: before a single space between
visible characters, between an ASCII letter and punctuation, around a lone line feed.
So a text is a sequence of pieces that are encoded independently; a worker encodes each
distinct piece once and keeps the ids in a table of fixed size. Texts holding white
space beyond ASCII, where the borders may fall elsewhere, are encoded whole.
"""

from __future__ import annotations

import os
import re
import sys
from types import ModuleType

import numpy as np

from sluice.llm.text import Texts, byte_values, rolling

SLOT_BITS = 20
# Ids kept by a worker; beyond it the table starts anew.
KEPT_IDS = 4_000_000
# Texts are encoded in slices of so many bytes.
ENCODE_SLICE = 1 << 20

_wide_space = re.compile(r"[^\S \t\n\r\f\v]")
# Classes of a byte, as bits: blank, ASCII letter, punctuation but for the apostrophe
# (which may begin a contraction), line feed or the like, possible start of wide white space.
_BLANK, _LETTER, _MARK, _BREAK, _WIDE = 1, 2, 4, 8, 16
_class = np.zeros(256, np.uint8)
_class[[0x20, *range(9, 14), *range(0x1C, 0x20), 0]] |= _BLANK
_class[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] |= _LETTER
_class[[x for x in range(0x21, 0x7F) if not chr(x).isalnum() and x != 0x27]] |= _MARK
_class[9:14] |= _BREAK
_class[[0xE1, 0xE2, 0xE3]] |= _WIDE

# The characters by which a byte-level vocabulary writes bytes: visible Latin-1 ones stand
# for themselves, the others follow from U+0100 on.
_own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_written = {b: 0x100 + i for i, b in enumerate(x for x in range(256) if x not in _own)}
_blank_mark = chr(_written[0x20])


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    """The array with room for `size` values, by at least a half more if it has to grow."""
    if size <= len(array):
        return array
    out = np.zeros(max(size, len(array) * 3 // 2), array.dtype)
    out[: len(array)] = array
    return out


def _held() -> dict[str, dict]:
    """State that a process keeps by vocabulary file. The code here travels by value, so what its classes or
    modules held would be sent along with every function, and be made anew in every task."""
    return sys.modules.setdefault("_sluice_encoders", ModuleType("_sluice_encoders")).__dict__.setdefault("held", {})


class Encoder:
    """Encodes many texts at once; one state per worker and vocabulary file (`at`).

    The library does not give back all memory of a vocabulary, about 4 MB each time it is read.
    """

    @classmethod
    def at(cls, path: str) -> Encoder:
        if path not in _held():
            _held()[path] = vars(cls(path))
        encoder = cls.__new__(cls)
        encoder.__dict__ = _held()[path]
        return encoder

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self._clear()

    def _clear(self) -> None:
        self.key = np.zeros(1 << SLOT_BITS, np.uint64)
        self.place = np.full(1 << SLOT_BITS, -1, np.int32)
        # Growing arrays: their first `pieces` + 1 edges and `held` ids are in use.
        self.edges = np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.pieces = self.held = 0

    def _keep(self, lists: list[list[int]]) -> np.ndarray:
        """Adds the ids of new pieces; their numbers."""
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        first, total = self.pieces, self.held + int(sizes.sum())
        self.edges = _grown(self.edges, first + len(lists) + 1)
        self.ids = _grown(self.ids, total)
        self.edges[first + 1 : first + len(lists) + 1] = self.held + np.cumsum(sizes)
        self.ids[self.held : total] = np.fromiter((i for x in lists for i in x), np.uint32, total - self.held)
        self.pieces, self.held = first + len(lists), total
        return np.arange(first, self.pieces)

    def _piece(self, piece: bytes) -> list[int]:
        text = piece.decode()
        word = text[1:] if text[0] == " " else text
        if word.isalpha() and max(word) < "ɐ":
            plain = text.replace(" ", _blank_mark) if text.isascii() else piece.decode("latin-1").translate(_written)
            return [t.id for t in self.model.tokenize(plain)]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids in row order, and the edges of the rows among them."""
        data, n = texts.data, len(texts.data)
        cut = np.zeros(n + 1, bool)
        if n > 2:
            kind = _class[data]
            seen = (kind & _BLANK) == 0
            a, b = kind[:-1], kind[1:]
            cut[1:n] = ((a & _LETTER) & (b >> 1 & _LETTER)) | ((a >> 1 & _LETTER) & (b & _LETTER))
            lone = np.flatnonzero(~seen[1:-1] & seen[:-2] & seen[2:]) + 1
            lone = lone[(data[lone] == 0x20) | ((kind[lone] & _BREAK) != 0)]
            cut[lone] = True
            cut[lone[data[lone] != 0x20] + 1] = True
            for row in self._odd_rows(texts, kind):
                cut[texts.offsets[row] + 1 : texts.offsets[row + 1]] = False
        cut[texts.offsets] = True
        starts = np.flatnonzero(cut[:n])
        ends = np.append(starts[1:], n) if len(starts) else starts
        keys = rolling(byte_values(data), starts, ends)
        if self.held > KEPT_IDS:
            self._clear()
        slot = (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        place = np.where(self.key[slot] == keys, self.place[slot], -1)
        missing = np.flatnonzero(place < 0)
        if len(missing):
            new, first, which = np.unique(keys[missing], return_index=True, return_inverse=True)
            at = missing[first]
            lists = [self._piece(data[s:e].tobytes()) for s, e in zip(starts[at].tolist(), ends[at].tolist())]
            added = self._keep(lists)
            self.key[slot[at]], self.place[slot[at]] = new, added
            place[missing] = added[which]
        sizes = self.edges[place + 1] - self.edges[place]
        total = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=total[1:])
        ids = self.ids[np.repeat(self.edges[place] - total[:-1], sizes) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, texts.offsets)]

    def _odd_rows(self, texts: Texts, kind: np.ndarray) -> list[int]:
        """Rows with white space beyond ASCII: U+0085, U+00A0, U+1680 to U+3000."""
        at = np.flatnonzero(kind & _WIDE)
        lead = np.flatnonzero(texts.data[:-1] == 0xC2)
        lead = lead[np.isin(texts.data[lead + 1], np.array([0x85, 0xA0], np.uint8))]
        rows = np.unique(np.searchsorted(texts.offsets, np.concatenate([at, lead]), "right") - 1)
        return [r for r in rows.tolist() if _wide_space.search(texts.row(r).decode())]


def with_end(ids: np.ndarray, edges: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with `end` after each row."""
    return np.insert(ids, edges[1:], end), edges + np.arange(len(edges))
