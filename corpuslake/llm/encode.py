"""Whole texts to token ids with the tokenizers library, each distinct piece once.

A text is cut only where the tokenizer itself always ends a pre-token: before a
run of plain white space, and between ASCII letters and ASCII punctuation other
than the apostrophe. Pieces are therefore independent, so a task encodes every
distinct piece once and looks the others up; documents are gathered from the
looked-up ids. A text with a special token's opening ``<|`` is one piece.
"""

from __future__ import annotations

import os
import re

import numpy as np

from . import kernels as K

MAX_PIECES = 400_000          # of the look-up table of a task; it starts anew beyond

_LETTERS = K.byte_class(bytes(range(65, 91)) + bytes(range(97, 123)))
_LOWER = K.byte_class(bytes(range(97, 123)))
_DIGITS = K.byte_class(b"0123456789")
_PUNCT = K.byte_class(bytes(b for b in range(0x21, 0x7F)
                            if not chr(b).isalnum() and b != 0x27))
_BLANK = K.byte_class(b" \t\n\r")
_SOLID = _LETTERS | _DIGITS | _PUNCT | K.byte_class(b"'")
# one pre-token of letters up to U+00FF, which every version of Unicode classes alike
_PLAIN = re.compile("[ ]?[A-Za-zÀ-ÖØ-öø-ÿ]+")


def blank_starts(data: np.ndarray, blank: np.ndarray) -> np.ndarray:
    """Where a run of ``blank`` begins after what is surely no white space."""
    out = np.zeros(len(data), bool)
    if len(data) > 1:
        before = _SOLID[data[:-1]].copy()
        before[1:] |= (data[1:-1] >= 0x80) & (data[:-2] == 0xC3)      # U+00C0 to U+00FF
        out[1:] = blank[data[1:]] & before
    return out


def piece_bounds(cut: np.ndarray, off: np.ndarray):
    """Starts and ends of the pieces, and how many each document has."""
    cut = cut.copy()
    cut[off[:-1][off[:-1] < off[1:]]] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(cut))
    return start, end, np.diff(np.searchsorted(start, off))


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others,
    in order, for the code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PieceEncoder:
    """Ids of the documents of a chunk, an end id after each.

    ``lower`` is for tokenizers that lower-case and drop white space.
    """

    def __init__(self, path: str, end_id: int, lower: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.alphabet = byte_letters()
        self.blank = self.alphabet[32]
        self.end_id, self.lower, self.hasher = end_id, lower, K.Hasher()
        self._reset()

    def _reset(self):
        self.keys = np.zeros(0, np.uint64)      # hashes of the known pieces, ascending,
        self.entry = np.zeros(0, np.int64)      # and their entries
        self.flat = np.full(1, self.end_id, np.uint32)
        self.at = np.array([0, 1])              # entry 0 is the end id

    def _encode(self, raw: bytes) -> list[int]:
        text = raw.decode()
        if _PLAIN.fullmatch(text):
            if self.lower:
                raw = text.strip().lower().encode()
            return [t.id for t in self.model.tokenize(raw.decode("latin-1").translate(self.alphabet))]
        return self.tok.encode(text, add_special_tokens=False).ids

    def _add(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Encodes new pieces; their entries."""
        buf = data.tobytes()
        text, tokenize = buf.decode("latin-1"), self.model.tokenize
        letters = _LETTERS if not self.lower else _LOWER
        solid = np.concatenate([[0], np.cumsum(~letters[data])])
        blank = end - start > 1
        blank[blank] = data[start[blank]] == 32
        # ASCII letters alone, one blank before them or none
        plain = (solid[end] == solid[start + blank]) & (end > start)
        if self.lower:
            plain &= ~blank
        ids, size = [], []
        for a, b, p, w in zip(start.tolist(), end.tolist(), plain.tolist(), blank.tolist()):
            if p:
                new = [t.id for t in tokenize(self.blank + text[a + 1:b] if w else text[a:b])]
            else:
                new = self._encode(buf[a:b])
            ids += new
            size.append(len(new))
        n = len(self.at) - 1
        self.flat = np.concatenate([self.flat, np.array(ids, np.uint32)])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(size, dtype=np.int64)])
        return np.arange(n, n + len(size))

    def _entries(self, h: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Entries of pieces by their distinct hashes, ascending; unknown ones are added."""
        at = np.searchsorted(self.keys, h)
        known = np.zeros(len(h), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == h[inside]
        entry = np.zeros(len(h), np.int64)
        entry[known] = self.entry[at[known]]
        new = ~known
        if new.any():
            entry[new] = self._add(data, start[new], end[new])
            self.keys = np.insert(self.keys, at[new], h[new])
            self.entry = np.insert(self.entry, at[new], entry[new])
        return entry

    def __call__(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)`` of the chunk's documents."""
        if len(self.keys) > MAX_PIECES:
            self._reset()
        n_docs = len(off) - 1
        raw = data
        cut = blank_starts(data, _BLANK)
        if len(data) > 1:
            a, b = data[:-1], data[1:]
            cut[1:] |= (_LETTERS[a] & _PUNCT[b]) | (_PUNCT[a] & _LETTERS[b])
        special = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C)) if len(data) else []
        if self.lower:
            data = K.lower_ascii(data)
        for d in set((np.searchsorted(off, special, side="right") - 1).tolist()):
            cut[off[d]:off[d + 1]] = False
            data = data.copy() if data is raw else data
            data[off[d]:off[d + 1]] = raw[off[d]:off[d + 1]]
        start, end, per_doc = piece_bounds(cut, off)
        if self.lower and len(start):           # white space before a piece says nothing
            solid = np.append(np.flatnonzero(~_BLANK[data]), len(data))
            start = np.minimum(solid[np.searchsorted(solid, start)], end)
        h, inverse = np.unique(self.hasher.ranges(self.hasher.prefix(data), start, end), return_inverse=True)
        one = np.zeros(len(h), np.int64)
        one[inverse] = np.arange(len(start))    # any piece of each hash
        entry = self._entries(h, data, start[one], end[one])
        at = self.at
        # an end piece after each document's own
        seq = np.insert(entry[inverse], np.cumsum(per_doc), 0)
        size = (at[1:] - at[:-1])[seq]
        bounds = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.arange(bounds[-1]) + np.repeat(at[:-1][seq] - bounds[:-1], size)]
        return ids, bounds[np.concatenate([[0], np.cumsum(per_doc + 1)])]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
