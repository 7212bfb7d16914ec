"""Vectorised text kernels used inside tasks (numpy over Arrow string buffers).

All operators read whole texts through :func:`text_chunks`, which cuts a batch
into runs of whole documents of about a megabyte, so the working arrays stay
small whatever the batch size; one longer document is a chunk of its own.
Hashes are 64-bit, deterministic and the same on every machine.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
SMALL_CHUNK = 1 << 18        # where many arrays of a chunk are alive together
_GAMMA = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93            # odd, so it has an inverse modulo 2**64


def release() -> None:
    """Gives freed memory back to the system: Python workers live on between
    tasks, and what one stage needed would stay with them through all others."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):       # another C library: nothing to do
        pass


def tidy(run):
    """``run`` over a task's batches, and :func:`release` when they are done."""

    def stream(batches):
        yield from run(batches)
        release()

    return stream


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit numbers of a fixed seed."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(_GAMMA))


def byte_class(members: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[np.frombuffer(members, dtype=np.uint8)] = True
    return out


SPACE = byte_class(b" \t\n\v\f\r")


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and ``n + 1`` offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def text_chunks(column, limit: int = CHUNK_BYTES):
    """``(first row, bytes, offsets)`` of runs of whole documents."""
    data, off = text_buffers(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def lower_ascii(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return data + upper.astype(np.uint8) * np.uint8(32)


def code_points(data: np.ndarray) -> np.ndarray:
    """For every byte, whether it begins a code point."""
    return (data & 0xC0) != 0x80


def segment_sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


class Hasher:
    """Hashes of byte ranges from one running sum over the bytes.

    ``sum(T[b_i] * B**i)`` modulo 2**64 is a prefix sum; a range's difference,
    brought back to exponent zero by the inverse of ``B`` and mixed, depends on
    its bytes alone.
    """

    def __init__(self):
        self.byte = stream(256, 77)
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            n = 1 << int(n - 1).bit_length()
            for name, b in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, b, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        self._grow(n + 1)
        s = np.zeros(n + 1, np.uint64)
        np.cumsum(self.byte[data] * self.up[:n], out=s[1:])
        return s

    def ranges(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (prefix[end] - prefix[start]) * self.down[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(_GAMMA))


def runs(member: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``member`` bytes; documents' borders part them."""
    n = len(member)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = member.copy(), member.copy()
    first[1:] &= ~member[:-1]
    last[:-1] &= ~member[1:]
    begins = off[:-1][off[:-1] < off[1:]]
    first[begins] = member[begins]
    ends = off[1:][off[:-1] < off[1:]] - 1
    last[ends] = member[ends]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of the words ``[^\\x20\\x09-\\x0D]+``."""
    start, end = runs(~SPACE[data], off)
    per_doc = np.diff(np.searchsorted(start, off))
    return start, end, np.repeat(np.arange(len(off) - 1), per_doc)


def windows(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all ``k``-word windows inside one document, and their first words."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[:n] == doc[k - 1:])
    c = np.zeros(len(at), np.uint64)
    for i, q in enumerate(stream(k, 4242) | np.uint64(1)):
        c += h[at + i] * q
    return mix(c), at


def shingle_sets(h: np.ndarray, doc: np.ndarray, n_docs: int, k: int):
    """``(codes, bounds)``: each document's distinct ``k``-word shingles, ascending.

    A document with fewer words has its whole word sequence as the one shingle,
    one without words none.
    """
    code, at = windows(h, doc, k)
    owner = doc[at]
    n_words = np.bincount(doc, minlength=n_docs)
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(short):
        first = np.searchsorted(doc, short)
        c = n_words[short].astype(np.uint64) * np.uint64(_GAMMA)
        for i, q in enumerate(stream(k, 4242) | np.uint64(1)):
            has = n_words[short] > i
            c += np.where(has, h[np.minimum(first + i, len(h) - 1)], np.uint64(0)) * q
        code = np.concatenate([code, mix(c)])
        owner = np.concatenate([owner, short])
    order = np.lexsort((code, owner))
    code, owner = code[order], owner[order]
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
    code, owner = code[fresh], owner[fresh]
    return code, np.searchsorted(owner, np.arange(n_docs + 1))
