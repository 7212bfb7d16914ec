"""C11 with incremental pair counts: a round reads only what it may change.

State, all written tables:

* *postings*, one row per distinct chunk and distinct pair in it, ``(key, cid, n,
  f_doc, f_idx, ids)``: the chunk's ids when the posting was made, sorted by pair in
  every file, so that a lookup by pair prunes to the pages that hold it. A pair can
  only come up in the round that makes the newer of its two symbols, so all postings
  of a pair lie in that round's table, and old postings never need a change: the
  merges since are replayed on the few chunks that are read. Chunks of more than
  ``LONG`` ids are named in postings and kept once, beside.
* *counts* of all pairs, ``(key, n)``, as signed changes of every round beside a
  base that is summed up anew every ``compact_every`` rounds.

A round is one map over the postings of the accepted pairs: it takes each chunk once,
rewrites it, and writes the changes of counts and the postings of pairs with a new
symbol. No chunk is shuffled.
First occurrences, which a difference cannot take back, are looked up for the pairs
tied at the top alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import bpe_kernels as K
from ..session import scratch_path, write_table

LONG = 64              # ids of a chunk that a posting carries along
_POSTING = "key long, cid long, n long, f_doc long, f_idx int, ids array<int>"
_OUT = "kind string, " + _POSTING
_ARROW = pa.schema([("kind", pa.string()), ("key", pa.int64()), ("cid", pa.int64()), ("n", pa.int64()),
                    ("f_doc", pa.int64()), ("f_idx", pa.int32()), ("ids", pa.list_(pa.int32()))])


def _pairs(v: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all adjacent pairs and the rows they are in."""
    same = seg[:-1] == seg[1:]
    return K.pair_keys(v)[same], seg[:-1][same]


def _postings(rb: pa.RecordBatch, v, seg, count: int, newer: int) -> pa.RecordBatch | None:
    """Postings of every row's distinct pairs that hold a symbol from ``newer`` on."""
    key, row = _pairs(v, seg)
    fresh = np.maximum(key >> 32, key & 0xFFFFFFFF) >= newer
    both = np.unique(np.stack([row[fresh], key[fresh]], axis=1), axis=0) if fresh.any() else np.zeros((0, 2), np.int64)
    if not len(both):
        return None
    row, key = both[:, 0], both[:, 1]
    order = np.argsort(key, kind="stable")
    row, key = row[order], key[order]
    take = pa.array(row)
    lists = K.flat_to_list(v, seg, count)
    size = np.bincount(seg, minlength=count)
    lists = pa.compute.if_else(pa.array(size <= LONG), lists, pa.nulls(count, lists.type)).take(take)
    return pa.RecordBatch.from_arrays(
        [pa.array(["posting"] * len(key), pa.string()), pa.array(key)] + [rb.column(c).take(take) for c in ("cid", "n", "f_doc")]
        + [rb.column("f_idx").take(take), lists], schema=_ARROW)


def _changes(keys: np.ndarray, weights: np.ndarray) -> pa.RecordBatch | None:
    """Summed changes of counts."""
    key, at = np.unique(keys, return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, at, weights)
    key, total = key[total != 0], total[total != 0]
    m = len(key)
    return pa.RecordBatch.from_arrays([pa.array(["count"] * m, pa.string()), pa.array(key), pa.nulls(m, pa.int64()),
                                       pa.array(total), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()),
                                       pa.nulls(m, pa.list_(pa.int32()))], schema=_ARROW) if m else None


def _index_batches(it):
    """Postings and counts of the byte pairs."""
    for rb in it:
        v, seg, count = K.list_to_flat(rb.column("ids"))
        if len(v) < 2:
            continue
        key, row = _pairs(v, seg)
        weight = rb.column("n").to_numpy(zero_copy_only=False)
        yield from (b for b in (_changes(key, weight[row]), _postings(rb, v, seg, count, 0)) if b is not None)


def _rewrite_batches(it, table: K.MergeTable, new):
    """Changes and postings from applying the ``new`` merges to chunks brought up to date by ``table``.

    A chunk comes once for every accepted pair that it held at some time. The row of the
    first accepted pair that it holds now stands for it; a chunk that holds none is left out.
    """
    accepted = np.array([(a << 32) | b for a, b, _ in new], np.int64)
    order = np.argsort(accepted)
    for rb in it:
        v, seg, count = K.list_to_flat(rb.column("ids"))
        v, seg = K.encode_flat(v, seg, count, table)
        if len(v) < 2:
            continue
        weight = rb.column("n").to_numpy(zero_copy_only=False)
        gone, where = _pairs(v, seg)
        at = np.minimum(np.searchsorted(accepted[order], gone), len(new) - 1)
        held = accepted[order][at] == gone
        first = np.full(count, len(new))
        np.minimum.at(first, where[held], order[at[held]])
        asked = rb.column("key").to_numpy(zero_copy_only=False)
        mine = (first < len(new)) & (accepted[np.minimum(first, len(new) - 1)] == asked)
        gone, where = gone[mine[where]], where[mine[where]]
        v, seg = v[mine[seg]], seg[mine[seg]]
        for left, right, made in new:
            v, seg = K.merge_pair(v, seg, left, right, made)
        key, row = _pairs(v, seg)
        both = _changes(np.concatenate([gone, key]), np.concatenate([-weight[where], weight[row]]))
        yield from (b for b in (both, _postings(rb, v, seg, count, new[0][2])) if b is not None)


def _first_batches(it, table: K.MergeTable):
    """``(key, f_doc, f_idx, f_pair)``: where each posting's pair is first met in its chunk now, if at all."""
    for rb in it:
        v, seg, count = K.list_to_flat(rb.column("ids"))
        v, seg = K.encode_flat(v, seg, count, table)
        if len(v) < 2:
            continue
        wanted = rb.column("key").to_numpy(zero_copy_only=False)
        hit = np.flatnonzero((seg[:-1] == seg[1:]) & (K.pair_keys(v) == wanted[seg[:-1]]))
        row, at = np.unique(seg[hit], return_index=True)
        place = hit[at] - np.searchsorted(seg, row)
        take = pa.array(row)
        yield pa.RecordBatch.from_arrays([rb.column("key").take(take), rb.column("f_doc").take(take),
                                          rb.column("f_idx").take(take), pa.array(place.astype(np.int32))],
                                         names=["key", "f_doc", "f_idx", "f_pair"])


class _State:
    """Postings by round, pair counts and merges so far."""

    def __init__(self, chunks: DataFrame, first_id: int, compact_every: int):
        self.spark, self.first_id, self.compact_every = chunks.sparkSession, first_id, compact_every
        self.root = scratch_path(self.spark, "bpe-rounds")
        whole = write_table(chunks.select("n", "f_doc", "f_idx", "ids").where(F.size("ids") >= 2)
                            .withColumn("cid", F.monotonically_increasing_id()), "bpe-chunks")
        kept = whole.where(F.size("ids") > LONG).select("cid", F.col("ids").alias("whole"))
        self.long = kept if kept.limit(1).count() else None
        self.merges: list[tuple[int, int, int]] = []
        self.made_in: list[int] = []                     # round of each merge's symbol
        self._write(whole.mapInArrow(_index_batches, _OUT), 0)
        self.base, self.since = None, [0]

    def _path(self, round_: int) -> str:
        return f"{self.root}/r{round_}"

    def _write(self, out: DataFrame, round_: int) -> None:
        out.sortWithinPartitions("kind", "key").write.parquet(self._path(round_))

    def _kind(self, kind: str, rounds) -> DataFrame:
        return self.spark.read.schema(_OUT).parquet(*[self._path(r) for r in rounds]).where(F.col("kind") == kind).drop("kind")

    def table(self) -> K.MergeTable:
        return K.MergeTable([m[0] for m in self.merges], [m[1] for m in self.merges], [m[2] for m in self.merges])

    def counts(self) -> DataFrame:
        parts = self.base if not self.since else self._kind("count", self.since).select("key", "n")
        if self.base is not None and self.since:
            parts = parts.unionByName(self.base)
        out = parts.groupBy("key").agg(F.sum("n").alias("n")).where("n > 0")
        if len(self.since) >= self.compact_every:
            out = self.base = write_table(out, "bpe-counts")
            self.since = []
        return out

    def lookup(self, keys: list[int]) -> DataFrame:
        """Postings of the given pairs, each from the round that made its newer symbol."""
        newer = [max(k >> 32, k & 0xFFFFFFFF) - self.first_id for k in keys]
        return self._kind("posting", sorted({self.made_in[i] if i >= 0 else 0 for i in newer})).where(F.col("key").isin(keys))

    def with_long(self, postings: DataFrame) -> DataFrame:
        if self.long is None:
            return postings
        cols = postings.columns
        return postings.join(self.long, "cid", "left").withColumn("ids", F.coalesce("ids", "whole")).select(*cols)

    def firsts(self, postings: DataFrame) -> DataFrame:
        """``(key, first)``: the first occurrence of each posted pair in corpus order."""
        from .bpe import _pack
        table = self.table()
        at = self.with_long(postings).mapInArrow(lambda it: _first_batches(it, table),
                                                 "key long, f_doc long, f_idx int, f_pair int")
        return at.groupBy("key").agg(F.min(_pack(F.col("f_doc"), F.col("f_idx"), F.col("f_pair"))).alias("first"))

    def merge(self, new: list[tuple[int, int, int]], trace: list | None) -> None:
        table, round_ = self.table(), (self.made_in[-1] if self.made_in else 0) + 1
        read = self.lookup([(a << 32) | b for a, b, _ in new])
        seen = Observation()
        if trace is not None:
            read = read.observe(seen, F.count(F.lit(1)).alias("rows"))
        self._write(self.with_long(read).mapInArrow(lambda it: _rewrite_batches(it, table, new), _OUT), round_)
        self.merges += new
        self.made_in += [round_] * len(new)
        self.since.append(round_)
        if trace is not None:
            trace.append({"merges": [m[2] for m in new], "rows_read": seen.get["rows"]})


def train_incremental(chunks: DataFrame, n_merges: int, first_id: int = 256, batch: bool = True, top_k: int = 64,
                      compact_every: int = 8, empty_error: bool = True, trace: list | None = None):
    """The merges ``[(left, right, new_id)]`` learned from a chunk table ``(n, f_doc,
    f_idx, ids)``; new ids count up from ``first_id``.

    Only the ``top_k + 1`` commonest pairs of a round reach the driver. Without pairs
    left it raises (``empty_error``) or stops. ``trace`` gets one entry per round with
    the number of postings read.
    """
    from .bpe import _select_batch
    state = _State(chunks, first_id, compact_every)
    while len(state.merges) < n_merges:
        counts = state.counts()
        top = counts.orderBy(F.desc("n"), "key").limit(top_k + 1).collect()
        if not top:
            if empty_error:
                raise ValueError(f"no pairs left after {len(state.merges)} merges")
            break
        most = top[0]["n"]
        tied = [r["key"] for r in top if r["n"] == most]
        if len(tied) > top_k:                            # more may be tied than were fetched
            posted = state._kind("posting", range(len(set(state.made_in)) + 1))
            firsts = state.firsts(posted.join(counts.where(F.col("n") == most).select("key"), "key"))
            tied = [r["key"] for r in firsts.orderBy("first").limit(top_k + 1).collect()]
            ranked = [(k, most) for k in tied]
        else:
            if len(tied) > 1:
                tied = [r["key"] for r in state.firsts(state.lookup(tied)).orderBy("first").collect()]
            ranked = [(k, most) for k in tied]
            rest = top[len(tied):]
            # of pairs tied further down the order is not known: the first of them ends the list
            for i, r in enumerate(rest):
                ranked.append((r["key"], r["n"]))
                if i + 1 < len(rest) and rest[i + 1]["n"] == r["n"]:
                    break
        pairs = [(k >> 32, k & 0xFFFFFFFF, n) for k, n in ranked]
        accepted = _select_batch(pairs, batch)[:n_merges - len(state.merges)]
        last = first_id + len(state.merges)
        state.merge([(a, b, last + i) for i, (a, b, _) in enumerate(accepted)], trace)
    return state.merges
