"""Shingle sets and their signatures, vectorised over the texts of an Arrow batch.

Texts come with one blank between words, so a shingle is a run of bytes; its 64-bit
hash is a difference of running sums over the bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PIECE = 1 << 18        # bytes of texts worked on together (or one longer text)
_STEP = 0x9E3779B97F4A7C15
_BASE = 0x2545F4914F6CDD1D         # odd, so powers of it can be divided by
_EMPTY = np.iinfo(np.uint64).max


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x + np.uint64(salt * _STEP & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def texts_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column, nulls empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return (data[at[0]:at[-1]], at - at[0]) if len(at) else (data, np.zeros(1, np.int64))


def pieces(column):
    """``(first row, bytes, offsets)`` of runs of whole texts of about ``PIECE`` bytes."""
    data, at = texts_of(column)
    lo = 0
    while lo < len(at) - 1:
        hi = max(int(np.searchsorted(at, at[lo] + PIECE, side="right")) - 1, lo + 1)
        yield lo, data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
        lo = hi


def shingle_sets(data: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(codes, bounds)``: every text's distinct ``k``-word shingles, ascending.

    Fewer words are one shingle; a text without words has none.
    """
    n = len(at) - 1
    blank = data == 32
    head = ~blank
    head[1:] &= blank[:-1]
    begins = at[:-1][at[:-1] < at[1:]]
    head[begins] = ~blank[begins]
    start = np.flatnonzero(head)
    per = np.diff(np.searchsorted(start, at))
    owner = np.repeat(np.arange(n), per)
    last = np.append(start[1:], len(data)) - 1           # the blank behind a word, or the text's end
    ends = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
    stop = np.where(ends, at[owner + 1], last) if len(owner) else last[:0]
    count = np.where(per > 0, np.maximum(per - k + 1, 1), 0)
    first = (np.cumsum(per) - per)[np.repeat(np.arange(n), count)] \
        + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    who = np.repeat(np.arange(n), count)
    tail = first + np.minimum(per[who], k) - 1
    up, down = (np.cumprod(np.append(np.uint64(1), np.full(len(data), b, np.uint64)))
                for b in (_BASE, pow(_BASE, -1, 1 << 64)))
    letters = mixed(np.arange(1, 257, dtype=np.uint64), 7)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(letters[data] * up[:-1], out=total[1:])
    a, b = start[first], stop[tail]
    code = mixed((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64) * np.uint64(_STEP))
    order = np.lexsort((code, who))
    code, who = code[order], who[order]
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[1:] != code[:-1]) | (who[1:] != who[:-1])
    code, who = code[fresh], who[fresh]
    return code, np.searchsorted(who, np.arange(n + 1))


def identities(code: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """24 bytes that tell sets apart (two sums and the size); None for empty sets."""
    parts = []
    for salt in (1, 2):
        s = np.zeros(len(code) + 1, np.uint64)
        np.cumsum(mixed(code, salt), out=s[1:])
        parts.append(s[bounds[1:]] - s[bounds[:-1]])
    size = np.diff(bounds)
    rows = np.stack([*parts, size.astype(np.uint64)], axis=1)
    return [r.tobytes() if n else None for r, n in zip(rows, size)]


def one_permutation(code: np.ndarray, bounds: np.ndarray, m: int) -> np.ndarray:
    """One-permutation min-hashes (texts x ``m``): every member is hashed once, falls into
    one of ``m`` bins, and a bin keeps its least hash.

    An empty bin takes the value of the first filled one along a sequence of bins that
    depends on the bin alone, so equal sets agree everywhere and a bin of two sets agrees
    with the probability of their similarity. Rows of empty sets stay empty.
    """
    n = len(bounds) - 1
    h = mixed(code, 3)
    size = np.diff(bounds)
    own = np.full((n, m), _EMPTY, np.uint64)
    cell = (((h >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
    np.minimum.at(own.reshape(-1), np.repeat(np.arange(n), size) * m + cell, mixed(h, 5))
    out = own.copy()
    bins, attempt = np.arange(m, dtype=np.uint64), 0
    row, col = np.nonzero((out == _EMPTY) & (size > 0)[:, None])
    while len(row):
        attempt += 1
        donor = (mixed(bins, 1000 + attempt) % np.uint64(m)).astype(np.int64)
        out[row, col] = own[row, donor[col]]
        still = out[row, col] == _EMPTY
        row, col = row[still], col[still]
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` consecutive entries."""
    total = np.zeros((len(sig), bands), np.uint64)
    for r in range(rows):
        total = mixed(total + sig[:, r::rows], r + 1)
    return mixed(total + np.arange(bands, dtype=np.uint64), 99)
