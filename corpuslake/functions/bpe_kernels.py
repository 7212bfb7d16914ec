"""Vectorised byte-pair kernels run inside Spark tasks (numpy over Arrow).

A batch of token sequences is held flat: ``v`` (token ids) and ``seg`` (the
sequence each id belongs to, non-decreasing). Merging never crosses a
sequence border. These helpers are the per-task part of the BPE jobs; Spark
partitions the rows and ships the (bounded) merge table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20        # values (bytes of strings) of the arrays that a kernel works on at a time

_INF = np.iinfo(np.int64).max


def pair_keys(v: np.ndarray) -> np.ndarray:
    """Adjacent pair (a, b) packed as ``a << 32 | b``."""
    a = v[:-1].astype(np.int64)
    b = v[1:].astype(np.int64)
    return (a << 32) | b


def _leftmost_nonoverlapping(idx: np.ndarray) -> np.ndarray:
    """From sorted match positions keep a left-to-right non-overlapping set.

    Consecutive positions (only possible for a pair (x, x)) overlap; inside
    each run of consecutive positions every second one is kept.
    """
    if len(idx) < 2:
        return idx
    k = np.arange(len(idx))
    brk = np.ones(len(idx), dtype=bool)
    brk[1:] = idx[1:] != idx[:-1] + 1
    run_start = np.maximum.accumulate(np.where(brk, k, 0))
    return idx[((k - run_start) % 2) == 0]


def _apply_at(v, seg, idx, new_ids):
    v = v.copy()
    v[idx] = new_ids
    drop = np.zeros(len(v), dtype=bool)
    drop[idx + 1] = True
    keep = ~drop
    return v[keep], seg[keep]


def merge_pair(v, seg, left: int, right: int, new_id: int):
    """Replace every (left, right) by ``new_id``, left to right, no overlap."""
    if len(v) < 2:
        return v, seg
    m = (v[:-1] == left) & (v[1:] == right) & (seg[:-1] == seg[1:])
    idx = np.flatnonzero(m)
    if len(idx) == 0:
        return v, seg
    idx = _leftmost_nonoverlapping(idx)
    return _apply_at(v, seg, idx, new_id)


class MergeTable:
    """Merge rules ``(left, right) -> new_id``; rank = position in list, or as given."""

    def __init__(self, lefts, rights, new_ids, ranks=None):
        keys = (np.asarray(lefts, np.int64) << 32) | np.asarray(rights, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        ranks = np.arange(len(keys)) if ranks is None else ranks
        self.rank = np.asarray(ranks, np.int64)[order]
        self.new = np.asarray(new_ids, np.int64)[order]

    def __len__(self):
        return len(self.keys)

    def lookup(self, keys: np.ndarray):
        if len(self.keys) == 0:
            z = np.zeros(len(keys), dtype=np.int64)
            return np.zeros(len(keys), dtype=bool), z, z
        pos = np.searchsorted(self.keys, keys)
        pos = np.minimum(pos, len(self.keys) - 1)
        found = self.keys[pos] == keys
        return found, self.rank[pos], self.new[pos]


def encode_flat(v: np.ndarray, seg: np.ndarray, nseg: int, table: MergeTable, below=None):
    """Per sequence: repeatedly merge its lowest-rank pair until none applies.

    ``below`` gives each sequence a rank that its merges stay under. Returns
    (values, seg) with the same sequence numbering. Finished sequences leave
    the working set, so long ones do not slow short ones.
    """
    done_v, done_s = [], []
    v = v.astype(np.int64, copy=False)
    seg = seg.astype(np.int64, copy=False)
    while len(v) > 0:
        if len(v) < 2 or len(table) == 0:
            done_v.append(v)
            done_s.append(seg)
            break
        same = seg[:-1] == seg[1:]
        found, rank, new = table.lookup(pair_keys(v))
        found &= same
        if below is not None:
            found &= rank < below[seg[:-1]]
        active = np.zeros(nseg, dtype=bool)
        active[seg[:-1][found]] = True
        fin = ~active[seg]
        if fin.any():
            done_v.append(v[fin])
            done_s.append(seg[fin])
        if not found.any():
            break
        segmin = np.full(nseg, _INF, dtype=np.int64)
        np.minimum.at(segmin, seg[:-1][found], rank[found])
        m = found & (rank == segmin[seg[:-1]])
        idx = _leftmost_nonoverlapping(np.flatnonzero(m))
        v, seg = _apply_at(v, seg, idx, new[idx])
        keep = active[seg]
        v, seg = v[keep], seg[keep]
    if not done_v:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    v = np.concatenate(done_v)
    seg = np.concatenate(done_s)
    order = np.argsort(seg, kind="stable")
    return v[order], seg[order]


def slices(batches, col: str, most: int = SLICE):
    """The batches cut into parts of at most ``most`` values of ``col`` (a longer row alone).

    An Arrow batch is bounded by its number of rows; numpy arrays of several times its
    size would otherwise grow with the length of the rows.
    """
    for rb in batches:
        arr = rb.column(col)
        if pa.types.is_list(arr.type) or pa.types.is_large_list(arr.type):
            size = pc.fill_null(pc.list_value_length(arr), 0).to_numpy(zero_copy_only=False)
            inner = arr.type.value_type
            if pa.types.is_string(inner) or pa.types.is_large_string(inner):
                chars = pc.fill_null(pc.binary_length(arr.flatten()), 0).to_numpy(zero_copy_only=False)
                ends = np.concatenate([[0], np.cumsum(chars + 1, dtype=np.int64)])
                at = ends[np.concatenate([[0], np.cumsum(size, dtype=np.int64)])]
            else:
                at = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        else:
            size = pc.fill_null(pc.binary_length(arr), 0).to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        lo = 0
        while lo < rb.num_rows:
            hi = max(int(np.searchsorted(at, at[lo] + most, side="right")) - 1, lo + 1)
            # taken, as offsets of slices are not regarded by every kernel
            yield rb if hi - lo == rb.num_rows else rb.take(pa.array(np.arange(lo, hi)))
            lo = hi


def list_to_flat(arr: pa.Array):
    """ListArray -> (values, seg, n) with seg the row of each value."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    vals = arr.flatten().to_numpy(zero_copy_only=False)
    seg = arr.value_parent_indices().to_numpy(zero_copy_only=False) if n else np.zeros(0)
    return vals, seg.astype(np.int64), n


def flat_to_list(v: np.ndarray, seg: np.ndarray, n: int, typ=pa.int32()) -> pa.Array:
    """(values, seg) -> ListArray with ``n`` rows (empty rows allowed)."""
    counts = np.bincount(seg, minlength=n) if len(seg) else np.zeros(n, np.int64)
    offsets = np.zeros(n + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                    pa.array(v.astype(np.int64), pa.int64()).cast(typ))


def utf8_bytes_flat(strings: pa.Array):
    """String/Binary array -> (byte values, seg, n) straight from Arrow buffers."""
    if isinstance(strings, pa.ChunkedArray):
        strings = strings.combine_chunks()
    b = strings.cast(pa.large_binary()) if not pa.types.is_large_binary(strings.type) else strings
    n = len(b)
    bufs = b.buffers()
    offsets = np.frombuffer(bufs[1], dtype=np.int64, count=n + 1 + b.offset)[b.offset:]
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    vals = data[offsets[0]:offsets[-1]].astype(np.int64)
    lens = np.diff(offsets)
    seg = np.repeat(np.arange(n, dtype=np.int64), lens)
    return vals, seg, n


def gather_tokens(dict_v, dict_seg, n_dict, occ_idx):
    """Token arrays of dictionary entries, repeated in occurrence order.

    Returns (values, lengths per occurrence).
    """
    counts = np.bincount(dict_seg, minlength=n_dict) if len(dict_seg) else np.zeros(n_dict, np.int64)
    starts = np.zeros(n_dict + 1, dtype=np.int64)
    np.cumsum(counts, out=starts[1:])
    lens = counts[occ_idx]
    total = int(lens.sum())
    if total == 0:
        return np.zeros(0, np.int64), lens
    first = starts[occ_idx]
    out_start = np.zeros(len(occ_idx), dtype=np.int64)
    np.cumsum(lens[:-1], out=out_start[1:])
    gather = np.repeat(first - out_start, lens) + np.arange(total)
    return dict_v[gather], lens
