"""Byte-level BPE as Spark jobs.

Training (C11) works on the *distinct chunk* table: equal chunks evolve
identically, so each distinct chunk is kept once with its multiplicity
``n`` and the position of its first occurrence ``(f_doc, f_idx)``. A round
is one Spark aggregate over the pairs of that table; the driver only sees
the top ranked pairs (bounded). Merges follow the sequential rule exactly:
highest count, ties to the pair seen first in corpus order.

Encoding (C12) and decoding (C13) are per-row maps: the pre-split runs in
the JVM (``regexp_extract_all``), the merge loop runs vectorised in numpy
inside ``mapInArrow`` with the merge table shipped to the tasks. The table
is bounded by ``vocab_size``, so nothing grows with the corpus and no
shuffle is needed.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import bpe_kernels as K
from ..functions import fixed
from ..functions.text import pre_split, split_specials
from ..session import cut_lineage

MERGES_SCHEMA = T.StructType([
    T.StructField("rank", T.IntegerType(), False),
    T.StructField("left", T.IntegerType(), False),
    T.StructField("right", T.IntegerType(), False),
    T.StructField("new_id", T.IntegerType(), False),
])

# Default of the arguments that bound the merge table or vocabulary a task is sent;
# a larger one is refused, never cut.
MAX_VOCAB = 2_000_000


# --------------------------------------------------------------------------
# chunk tables

_DEC = "decimal(38,0)"
_P31 = 2 ** 31


def _lit(v: int) -> Column:
    return F.lit(v).cast(_DEC)


def _pack(doc: Column, *ints: Column) -> Column:
    """Order-preserving exact number for (doc: long, then non-negative ints
    below 2^31): doc * 2^(31 k) + ... fits decimal(38,0) for k <= 2."""
    out = doc.cast(_DEC)
    for c in ints:
        out = out * _lit(_P31) + c.cast(_DEC)
    return out


def _bytes_batches(it, text_col: str, out_col: str, keep):
    for rb in K.slices(it, text_col):
        v, seg, n = K.utf8_bytes_flat(rb.column(text_col))
        ids = K.flat_to_list(v, seg, n)
        cols = [rb.column(c) for c in keep] + [ids]
        yield pa.RecordBatch.from_arrays(cols, names=list(keep) + [out_col])


def with_byte_ids(df: DataFrame, text_col: str, out_col: str = "ids") -> DataFrame:
    """UTF-8 bytes of a string column as ``array<int>`` (0..255)."""
    keep = [c for c in df.columns]
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(lambda it: _bytes_batches(it, text_col, out_col, keep), schema)


def chunk_occurrences(df: DataFrame, text_col: str = "text", order_col: str = "doc_id",
                      pattern: str = fixed.GPT2_SPLIT_PATTERN, chunker=None) -> DataFrame:
    """One row per pre-split chunk: ``(doc, idx, chunk)``. ``chunker`` maps
    the text column to an array of chunks (default: the split pattern)."""
    chunks = chunker(F.col(text_col)) if chunker else pre_split(F.col(text_col), pattern)
    return df.select(F.col(order_col).alias("doc"), F.posexplode(chunks).alias("idx", "chunk"))


def chunk_table(df: DataFrame, text_col: str = "text", order_col: str = "doc_id",
                pattern: str = fixed.GPT2_SPLIT_PATTERN, chunker=None) -> DataFrame:
    """Distinct chunks with multiplicity and first position, plus byte ids.

    ``(chunk, n, f_doc, f_idx, ids)``. One shuffle on the chunk string, with
    map-side partial aggregation, so a hot chunk costs one row per task.
    """
    occ = chunk_occurrences(df, text_col, order_col, pattern, chunker)
    # first position packed into one number: a min over it stays a hash
    # aggregate (a min over a struct would sort every occurrence)
    agg = occ.groupBy("chunk").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.col("doc").cast("long")).alias("f_doc"),
        F.min(_pack(F.col("doc").cast("long"), F.col("idx"))).alias("_f"))
    agg = agg.select("chunk", "n", "f_doc", F.pmod("_f", _lit(_P31)).cast("int").alias("f_idx"))
    return with_byte_ids(agg, "chunk")


# --------------------------------------------------------------------------
# C9 pair statistics

_PAIR_SCHEMA = T.StructType([
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("count", T.LongType()), T.StructField("f_doc", T.LongType()),
    T.StructField("f_idx", T.IntegerType()), T.StructField("f_pair", T.IntegerType()),
])


_DENSE = 2048          # symbols up to which pairs are counted by direct addressing


def _pairs_of(v, seg, n, rb):
    """Per-batch pair partials ``(keys, count, f_doc, f_idx, f_pair)`` of the
    flat ids ``(v, seg)`` whose rows carry ``n``, ``f_doc`` and ``f_idx``."""
    if len(v) < 2:
        return None
    same = seg[:-1] == seg[1:]
    keys = K.pair_keys(v)[same]
    if len(keys) == 0:
        return None
    pseg = seg[:-1][same]
    starts = np.searchsorted(seg, np.arange(n))
    pidx = (np.flatnonzero(same) - starts[pseg]).astype(np.int64)
    w = rb.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
    fd = rb.column("f_doc").to_numpy(zero_copy_only=False).astype(np.int64)
    fi = rb.column("f_idx").to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.lexsort((fi, fd))
    symbols = int(v.max()) + 1
    shared = ((np.diff(fd[rows]) == 0) & (np.diff(fi[rows]) == 0)).any()
    if symbols <= _DENSE and not shared and w.sum() < 2 ** 53 // max(len(keys), 1):
        # few symbols: counts and first places by direct addressing, no sort of the pairs
        code = (keys >> 32) * symbols + (keys & 0xFFFFFFFF)
        count = np.bincount(code, weights=w[pseg], minlength=symbols * symbols)
        if (rows == np.arange(n)).all():
            back = np.arange(len(code) - 1, -1, -1)
        else:
            place = np.empty(n, np.int64)
            place[rows] = np.arange(n)
            back = np.argsort(place[pseg], kind="stable")[::-1]
        at = np.full(symbols * symbols, -1, np.int64)
        at[code[back]] = back                      # written last: the first in corpus order
        held = np.flatnonzero(at >= 0)
        at = at[held]
        return keys[at], count[held].astype(np.int64), fd[pseg[at]], fi[pseg[at]], pidx[at]
    w, fd, fi = w[pseg], fd[pseg], fi[pseg]
    order = np.lexsort((pidx, fi, fd, keys))
    keys, w, fd, fi, pidx = keys[order], w[order], fd[order], fi[order], pidx[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    starts_k = np.flatnonzero(first)
    return keys[starts_k], np.add.reduceat(w, starts_k), fd[starts_k], fi[starts_k], pidx[starts_k]


def _pair_arrays(parts):
    uk, cnt, fd, fi, fp = parts
    return [pa.array((uk >> 32).astype(np.int32)), pa.array((uk & 0xFFFFFFFF).astype(np.int32)),
            pa.array(cnt.astype(np.int64)), pa.array(fd), pa.array(fi.astype(np.int32)),
            pa.array(fp.astype(np.int32))]


def _partial_pairs(it):
    for rb in K.slices(it, "ids"):
        v, seg, n = K.list_to_flat(rb.column("ids"))
        parts = _pairs_of(v, seg, n, rb)
        if parts is not None:
            yield pa.RecordBatch.from_arrays(_pair_arrays(parts), schema=_PAIR_ARROW)


_PAIR_ARROW = pa.schema([("left", pa.int32()), ("right", pa.int32()), ("count", pa.int64()),
                         ("f_doc", pa.int64()), ("f_idx", pa.int32()), ("f_pair", pa.int32())])


def _agg_pairs(part: DataFrame) -> DataFrame:
    return part.groupBy("left", "right").agg(
        F.sum("count").alias("count"),
        F.min(_pack(F.col("f_doc"), F.col("f_idx"), F.col("f_pair"))).alias("first"))


def pair_stats(chunks: DataFrame) -> DataFrame:
    """Counts of adjacent id pairs inside chunks, weighted by multiplicity.

    ``(left, right, count, first)`` where ``first`` orders pairs by their
    first occurrence in corpus order. Partial counts are made per task in
    numpy, then one Spark aggregate combines them.
    """
    part = chunks.select("n", "f_doc", "f_idx", "ids").mapInArrow(_partial_pairs, _PAIR_SCHEMA)
    return _agg_pairs(part)


def extreme_pair(stats: DataFrame, mode: str = "most") -> DataFrame:
    """The pair with the highest (``most``) or lowest (``least``) count, ties
    to the pair seen first; one row, none when there are no pairs."""
    if mode not in ("most", "least"):
        raise ValueError(f"mode={mode!r}")
    by = F.desc("count") if mode == "most" else F.asc("count")
    return stats.orderBy(by, F.asc("first")).limit(1).select("left", "right", "count")


# --------------------------------------------------------------------------
# C10 apply merges

def _apply_batches(it, merges, keep):
    for rb in K.slices(it, "ids"):
        v, seg, n = K.list_to_flat(rb.column("ids"))
        for left, right, new in merges:
            v, seg = K.merge_pair(v, seg, left, right, new)
        ids = K.flat_to_list(v, seg, n)
        cols = [rb.column(c) for c in keep] + [ids]
        yield pa.RecordBatch.from_arrays(cols, names=list(keep) + ["ids"])


def apply_merges(chunks: DataFrame, merges) -> DataFrame:
    """Rewrite ``ids`` with the given merges in order (left to right each)."""
    merges = [(int(a), int(b), int(c)) for a, b, c in merges]
    keep = [c for c in chunks.columns if c != "ids"]
    schema = T.StructType([f for f in chunks.schema.fields if f.name != "ids"]
                          + [T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return chunks.mapInArrow(lambda it: _apply_batches(it, merges, keep), schema)


# --------------------------------------------------------------------------
# C11 training

def _select_batch(top, batch: bool):
    """Merges accepted this round, equal to taking them one at a time.

    Accept ranked pairs while they share no symbol with the accepted ones;
    the first that does blocks; accepted pairs (except the first) tied with
    the blocker's count are dropped; a pair (x, x) ends the batch.
    """
    acc = [top[0]]
    if not batch or top[0][0] == top[0][1]:
        return acc
    used = {top[0][0], top[0][1]}
    blocker = top[-1] if len(top) > 1 else None     # unseen pairs count <= last fetched
    for p in top[1:-1]:
        if p[0] in used or p[1] in used:
            blocker = p
            break
        acc.append(p)
        used.update((p[0], p[1]))
        if p[0] == p[1]:
            blocker = None
            break
    if blocker is not None:
        acc = [acc[0]] + [p for p in acc[1:] if p[2] > blocker[2]]
    return acc


def train_bpe(df: DataFrame, vocab_size: int, text_col: str = "text",
              order_col: str = "doc_id", pattern: str = fixed.GPT2_SPLIT_PATTERN,
              batch: bool = True, top_k: int = 64, trace: list | None = None) -> DataFrame:
    """Learn ``vocab_size - 256`` merges; returns ``merges(rank, left, right, new_id)``.

    Pair counts are kept and changed by signed differences; a round reads only the
    chunks that hold an accepted pair (:mod:`bpe_train`). Exact batching accepts
    several merges per round when that provably equals the one-at-a-time result.
    """
    from .bpe_train import train_incremental

    if vocab_size < 256:
        raise ValueError("vocab_size must be at least 256")
    chunks = chunk_table(df, text_col, order_col, pattern).select("n", "f_doc", "f_idx", "ids")
    return merges_from_rows(df.sparkSession, train_incremental(chunks, vocab_size - 256, 256, batch, top_k, trace=trace))


# --------------------------------------------------------------------------
# C14 vocabulary

def build_vocab(merges: DataFrame, specials: dict | None = None) -> DataFrame:
    """``vocab(token_id, bytes)``: 256 single bytes, each merge the
    concatenation of its parts (resolved level by level with joins), then
    the specials as their UTF-8 text."""
    spark = merges.sparkSession
    base = spark.range(256).select(F.col("id").cast("int").alias("token_id"),
                                   F.unhex(F.lpad(F.hex("id"), 2, "0")).alias("bytes"))
    known = base
    todo = merges.select("left", "right", F.col("new_id").alias("token_id"))
    level = 0
    while True:
        level += 1
        l = known.select(F.col("token_id").alias("left"), F.col("bytes").alias("lb"))
        r = known.select(F.col("token_id").alias("right"), F.col("bytes").alias("rb"))
        step = (todo.join(known.select("token_id"), "token_id", "left_anti")
                .join(l, "left").join(r, "right")
                .select("token_id", F.concat("lb", "rb").alias("bytes")))
        step = cut_lineage(step)
        if step.isEmpty():
            break
        known = cut_lineage(known.unionByName(step))
    if specials:
        sp = spark.createDataFrame([(int(i), s.encode("utf-8")) for s, i in specials.items()],
                                   "token_id int, bytes binary")
        known = known.unionByName(sp)
    return known


# --------------------------------------------------------------------------
# C12 encode

def _encode_batches(it, table_rows, specials, chunk_col, keep, out_col, byte_perm=None):
    perm = None if byte_perm is None else np.asarray(byte_perm, dtype=np.int64)
    table = K.MergeTable([r[0] for r in table_rows], [r[1] for r in table_rows],
                         [r[2] for r in table_rows])
    special_ids = dict(specials or {})
    for rb in K.slices(it, chunk_col):
        lists = rb.column(chunk_col)
        n_rows = len(lists)
        occ = lists.flatten()
        parent = lists.value_parent_indices().to_numpy(zero_copy_only=False) if n_rows else np.zeros(0)
        enc = pc.dictionary_encode(occ)
        occ_idx = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        dictionary = enc.dictionary
        n_dict = len(dictionary)
        is_special = np.zeros(n_dict, dtype=bool)
        sp_vals = []
        if special_ids and n_dict:
            names = dictionary.to_pylist()
            for j, s in enumerate(names):
                if s in special_ids:
                    is_special[j] = True
                    sp_vals.append((j, special_ids[s]))
        v, seg, _ = K.utf8_bytes_flat(dictionary)
        if perm is not None:
            v = perm[v]
        if is_special.any():
            keep_mask = ~is_special[seg]
            v, seg = v[keep_mask], seg[keep_mask]
        dv, dseg = K.encode_flat(v, seg, n_dict, table)
        if sp_vals:
            dv = np.concatenate([dv, np.array([x for _, x in sp_vals], np.int64)])
            dseg = np.concatenate([dseg, np.array([j for j, _ in sp_vals], np.int64)])
            o = np.argsort(dseg, kind="stable")
            dv, dseg = dv[o], dseg[o]
        tok, lens = K.gather_tokens(dv, dseg, n_dict, occ_idx)
        row_len = np.bincount(parent.astype(np.int64), weights=lens, minlength=n_rows).astype(np.int64) \
            if len(parent) else np.zeros(n_rows, np.int64)
        offsets = np.zeros(n_rows + 1, dtype=np.int32)
        np.cumsum(row_len, out=offsets[1:])
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                       pa.array(tok.astype(np.int32), pa.int32()))
        cols = [rb.column(c) for c in keep] + [ids]
        yield pa.RecordBatch.from_arrays(cols, names=list(keep) + [out_col])


def _bounded(df: DataFrame, most: int, what: str) -> DataFrame:
    n = df.count()
    if n > most:
        raise ValueError(f"{what} of {n} rows exceeds the {most} that may be sent to tasks")
    return df


def _merge_rows(merges: DataFrame, max_vocab: int = MAX_VOCAB):
    return [(r["left"], r["right"], r["new_id"]) for r in _bounded(merges, max_vocab, "merge table")
            .orderBy("rank").select("left", "right", "new_id").collect()]


def check_specials(df: DataFrame, text_col: str, specials, allowed) -> DataFrame:
    """C8 pre-flight: documents containing each special token.

    ``allowed``: 'all', 'none', 'none_raise' or a set of specials. Raises
    when a disallowed special occurs (the 'none_raise' default asserts none
    occurs). Returns the count table ``(special, n_docs)``.
    """
    names = list(specials)
    if not names:
        return df.sparkSession.createDataFrame([], "special string, n_docs long")
    counts = df.agg(*[F.count_if(F.instr(F.col(text_col), s) > 0).alias(f"c{i}")
                      for i, s in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(s).alias("special"), F.col(f"c{i}").cast("long").alias("n_docs"))
                     for i, s in enumerate(names)])
    return counts.select(F.explode(rows).alias("x")).select("x.*")


def resolve_allowed(specials: dict, allowed) -> dict:
    if allowed == "all":
        return dict(specials)
    if allowed in ("none", "none_raise"):
        return {}
    if isinstance(allowed, (set, frozenset, list, tuple)):
        return {k: v for k, v in specials.items() if k in allowed}
    raise ValueError(f"allowed_special={allowed!r} not understood")


def encode_bpe(df: DataFrame, merges: DataFrame, text_col: str = "text",
               specials: dict | None = None, allowed="none_raise",
               pattern: str = fixed.GPT2_SPLIT_PATTERN, out_col: str = "ids",
               keep: list | None = None, merge_rows=None, byte_perm=None,
               max_vocab: int = MAX_VOCAB) -> DataFrame:
    """Encode a text column to ``array<int>`` token ids (lowest rank first).

    ``byte_perm`` (C17): a 256-entry permutation applied to the bytes
    before merging (the decoder applies the inverse).

    With ``allowed`` specials, their exact occurrences become their ids and
    the text around them is encoded normally. ``none_raise`` fails when any
    special token occurs in the column (pre-flight aggregate).
    """
    specials = specials or {}
    keep = keep if keep is not None else [c for c in df.columns if c != text_col]
    use = resolve_allowed(specials, allowed)
    if allowed == "none_raise" and specials:
        bad = [r for r in check_specials(df, text_col, specials, allowed).collect() if r.n_docs]
        if bad:
            raise ValueError(f"special tokens in text: {[(r.special, r.n_docs) for r in bad]}")
    elif isinstance(allowed, (set, frozenset, list, tuple)):
        disallowed = {k: v for k, v in specials.items() if k not in use}
        if disallowed:
            bad = [r for r in check_specials(df, text_col, disallowed, allowed).collect() if r.n_docs]
            if bad:
                raise ValueError(f"disallowed special tokens: {[(r.special, r.n_docs) for r in bad]}")
    rows = merge_rows if merge_rows is not None else _merge_rows(merges, max_vocab)
    t = F.col(text_col)
    if use:
        pieces = split_specials(t, list(use))
        chunks = F.flatten(F.transform(pieces, lambda p: F.when(
            p["is_special"], F.array(p["s"])).otherwise(pre_split(p["s"], pattern))))
    else:
        chunks = pre_split(t, pattern)
    staged = df.select(*keep, chunks.alias("_chunks"))
    schema = T.StructType([staged.schema[c] for c in keep]
                          + [T.StructField(out_col, T.ArrayType(T.IntegerType()))])
    return staged.mapInArrow(
        lambda it: _encode_batches(it, rows, use, "_chunks", keep, out_col, byte_perm), schema)


# --------------------------------------------------------------------------
# C13 decode

def _vocab_arrays(vocab_rows):
    dense = {i: b for i, b in vocab_rows}
    size = max(dense) + 1 if dense else 0
    lens = np.zeros(size, dtype=np.int64)
    known = np.zeros(size, dtype=bool)
    for i, b in dense.items():
        lens[i] = len(b)
        known[i] = True
    starts = np.zeros(size + 1, dtype=np.int64)
    np.cumsum(lens, out=starts[1:])
    buf = np.frombuffer(b"".join(dense.get(i, b"") for i in range(size)), dtype=np.uint8)
    return known, lens, starts, buf


def _decode_batches(it, vocab_rows, ids_col, keep, out_col, byte_perm=None):
    known, lens, starts, buf = _vocab_arrays(vocab_rows)
    inv = None
    if byte_perm is not None:
        inv = np.zeros(256, dtype=np.uint8)
        inv[np.asarray(byte_perm, dtype=np.int64)] = np.arange(256, dtype=np.uint8)
    for rb in K.slices(it, ids_col):
        lists = rb.column(ids_col)
        v, seg, n = K.list_to_flat(lists)
        v = v.astype(np.int64)
        if len(v) and (v.min() < 0 or v.max() >= len(known) or not known[v].all()):
            bad = v[(v < 0) | (v >= len(known))]
            if len(bad) == 0:
                bad = v[~known[v]]
            raise ValueError(f"invalid token id: {int(bad[0])}")
        tl = lens[v] if len(v) else np.zeros(0, np.int64)
        total = int(tl.sum())
        out_start = np.zeros(len(v), dtype=np.int64)
        if len(v):
            np.cumsum(tl[:-1], out=out_start[1:])
        gather = np.repeat(starts[v] - out_start, tl) + np.arange(total)
        data = buf[gather] if total else np.zeros(0, np.uint8)
        if inv is not None:
            data = inv[data]
        row_len = np.bincount(seg, weights=tl, minlength=n).astype(np.int64) if len(v) \
            else np.zeros(n, np.int64)
        offsets = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(row_len, out=offsets[1:])
        arr = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n,
                                               [None, pa.py_buffer(offsets.tobytes()),
                                                pa.py_buffer(data.tobytes())])
        cols = [rb.column(c) for c in keep] + [arr]
        yield pa.RecordBatch.from_arrays(cols, names=list(keep) + [out_col])


def decode_bpe(df: DataFrame, vocab: DataFrame, ids_col: str = "ids", out_col: str = "text",
               keep: list | None = None, vocab_rows=None, byte_perm=None,
               max_vocab: int = MAX_VOCAB) -> DataFrame:
    """Token ids back to text: bytes concatenated, invalid UTF-8 replaced.

    The vocabulary is shipped to the tasks (and refused beyond ``max_vocab``
    rows); an unknown id fails the job.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != ids_col]
    if vocab_rows is None:
        vocab_rows = [(r.token_id, bytes(r.bytes)) for r in _bounded(vocab, max_vocab, "vocabulary").collect()]
    schema = T.StructType([df.schema[c] for c in keep]
                          + [T.StructField("_bytes", T.BinaryType())])
    raw = df.select(*keep, ids_col).mapInArrow(
        lambda it: _decode_batches(it, vocab_rows, ids_col, keep, "_bytes", byte_perm), schema)
    return raw.select(*keep, F.make_valid_utf8(F.col("_bytes").cast("string")).alias(out_col))


# --------------------------------------------------------------------------
# C21 / C22 corpus statistics

def corpus_stats(docs: DataFrame, tokens: DataFrame, text_col: str = "text",
                 ids_col: str = "ids", key: str = "doc_id") -> DataFrame:
    """Docs, chars, bytes, tokens, tokens per char / byte, distinct tokens."""
    t = tokens.select(key, F.size(ids_col).alias("_nt"))
    d = docs.select(key, F.length(text_col).alias("_c"), F.octet_length(text_col).alias("_b"))
    j = d.join(t, key, "left")
    base = j.agg(F.count(F.lit(1)).alias("docs"), F.sum("_c").alias("chars"),
                 F.sum("_b").alias("bytes"), F.sum(F.coalesce("_nt", F.lit(0))).alias("tokens"))
    # outer: a plain explode makes the array of a column computed here twice more, to see whether it is empty
    distinct = tokens.select(F.explode_outer(ids_col).alias("t")).agg(
        F.count_distinct("t").alias("distinct_tokens"))
    return _side_by_side(base, distinct)


def _side_by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two one-row aggregates as one row (union + max, no join)."""
    out = a.unionByName(b, allowMissingColumns=True)
    cols = a.columns + b.columns
    out = out.agg(*[F.max(c).cast("long").alias(c) for c in cols])
    return out.select(
        *cols,
        F.round(F.col("tokens") / F.col("chars"), 6).alias("tokens_per_char"),
        F.round(F.col("tokens") / F.col("bytes"), 6).alias("tokens_per_byte"))


def token_frequencies(tokens: DataFrame, vocab: DataFrame, ids_col: str = "ids") -> DataFrame:
    """Count per token id, with its text."""
    counts = tokens.select(F.explode(ids_col).alias("token_id")).groupBy("token_id") \
        .agg(F.count(F.lit(1)).alias("n"))
    return counts.join(vocab, "token_id", "left").select(
        "token_id", "n", F.make_valid_utf8(F.col("bytes").cast("string")).alias("text"))


def merges_from_rows(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame([(i, a, b, c) for i, (a, b, c) in enumerate(rows)], MERGES_SCHEMA)


# --------------------------------------------------------------------------
# C15 render / C16 recover

@F.pandas_udf(T.StringType())
def _escape_controls(s: pd.Series) -> pd.Series:
    def esc(x):
        if x is None:
            return None
        return "".join(f"\\u{ord(ch):04x}" if unicodedata.category(ch).startswith("C") else ch for ch in x)
    return s.map(esc)


def render_token(b) -> F.Column:
    """Bytes shown as text: invalid UTF-8 replaced, control characters as
    ``\\uXXXX`` (Python-side only for rows that contain one)."""
    t = F.make_valid_utf8(b.cast("string"))
    return F.when(t.rlike("\\p{C}"), _escape_controls(t)).otherwise(t)


def render_vocab(vocab: DataFrame, merges: DataFrame) -> DataFrame:
    """``[s0][s1] -> [s] id`` for merged tokens, ``[s] id`` otherwise."""
    v = vocab.select("token_id", render_token(F.col("bytes")).alias("s"))
    l = v.select(F.col("token_id").alias("left"), F.col("s").alias("s0"))
    r = v.select(F.col("token_id").alias("right"), F.col("s").alias("s1"))
    m = merges.select("left", "right", F.col("new_id").alias("token_id")).join(l, "left").join(r, "right")
    j = v.join(m.select("token_id", "s0", "s1"), "token_id", "left")
    line = F.when(F.col("s0").isNotNull(), F.format_string("[%s][%s] -> [%s] %d", "s0", "s1", "s", "token_id")) \
        .otherwise(F.format_string("[%s] %d", "s", "token_id"))
    return j.select("token_id", line.alias("line"))


def _split_rules(rank_rows) -> K.MergeTable:
    """Every way to put a token together from two others, under the token's rank."""
    ranks = {bytes(b): int(r) for b, r in rank_rows}
    rules = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items()
             for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    left, right, new = (list(x) for x in zip(*rules)) if rules else ([], [], [])
    return K.MergeTable(left, right, new, ranks=new)


def _recover_batches(it, rank_rows):
    table = _split_rules(rank_rows)
    byte_id = np.full(256, -1, np.int64)
    for b, r in rank_rows:
        if len(b) == 1:
            byte_id[b[0]] = r
    for rb in it:
        rank = rb.column("rank").to_numpy(zero_copy_only=False).astype(np.int64)
        v, seg, n = K.utf8_bytes_flat(rb.column("bytes"))
        long_ = np.bincount(seg, minlength=n) > 1 if len(seg) else np.zeros(n, bool)
        v, seg = byte_id[v[long_[seg]]], seg[long_[seg]]
        # what the merges before its own make of a token: the two parts that its own merges
        v, seg = K.encode_flat(v, seg, n, table, below=rank)
        parts = np.bincount(seg, minlength=n) if len(seg) else np.zeros(n, np.int64)
        if (parts[long_] != 2).any():
            raise ValueError(f"rank {int(rank[long_ & (parts != 2)][0])} is no merge of two earlier tokens")
        yield pa.RecordBatch.from_arrays(
            [pa.array(rank[long_]), pa.array(v[0::2]), pa.array(v[1::2])], names=["rank", "left", "right"])


def recover_merges(ranks: DataFrame, max_vocab: int = MAX_VOCAB) -> DataFrame:
    """Merges from ``(bytes, rank)`` alone. The merge of a token is the pair
    that its bytes come to under the ranks below its own, so all tokens of a
    batch are encoded at once with a rank limit each. The rank table is shipped
    and refused beyond ``max_vocab`` rows."""
    rank_rows = [(bytes(r.bytes), r.rank) for r in _bounded(ranks, max_vocab, "rank table").collect()]
    return ranks.select(F.col("bytes"), F.col("rank").cast("long").alias("rank")).mapInArrow(
        lambda it: _recover_batches(it, rank_rows), "rank long, left long, right long")
