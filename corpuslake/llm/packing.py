"""Sum-of-squares packing of tokenised documents into sequences.

Documents are tokenised where they are read; from then on only their pieces'
lengths move. Longer documents are cut into pieces of the full length, the
first of which may be shorter, so a document leaves at most one piece to pack.

A task packs a hashed share of the pieces, the longest first: a piece goes into
the open bin that makes the sum over gaps of ``(open bins with this gap) ** 2``
smallest, and opens a new bin only if it fits into none (the rule without this
and in arrival order needs 6 % more sequences on the test texts). Shares have
the same mix of lengths whatever their keys, so each is packed about as well as
all would be together; bins that stay open are then pieces of the next round, packed by
the same rule over fewer tasks, until one task holds all of them or a round no
longer saves a hundredth. Every round's placements are written, so a lost
executor cannot change a placement that others have read.

Defined results: null texts are empty, and an empty text is its end token; rows
are packed one by one, so repeated rows and null ids are pieces like any other.
``sequence_id`` is the row number of the piece at offset 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_table
from . import kernels as K
from .common import crc
from .encode import PieceEncoder, tokenizer_path

ITEMS_PER_TASK = 100_000


def token_pieces(docs: DataFrame, path: str, end_id: int, length: int, text_col: str = "text",
                 id_col: str = "doc_id") -> DataFrame:
    """``(id_col, piece, start, length, ids_crc32)`` of every piece of every row."""

    def run(batches):
        enc = PieceEncoder(path, end_id)
        for b in batches:
            for lo, data, off in K.text_chunks(b.column(1), K.SMALL_CHUNK):
                ids, at = enc(data, off)
                raw = memoryview(ids.astype("<u4").tobytes())
                size = np.diff(at)
                n = -(-size // length)
                doc = np.repeat(np.arange(len(n)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                first = size - (n - 1) * length
                start = np.where(piece == 0, 0, first[doc] + (piece - 1) * length)
                own = np.where(piece == 0, first[doc], length)
                begin = 4 * (at[:-1][doc] + start)
                sums = [crc(raw[s:s + 4 * m]) for s, m in zip(begin.tolist(), own.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(n)).take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                     pa.array(start), pa.array(own), pa.array(sums, pa.int64())],
                    names=["id", "piece", "start", "length", "ids_crc32"])

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return d.mapInArrow(K.tidy(run), "id long, piece int, start long, length long, ids_crc32 long") \
        .withColumnRenamed("id", id_col)


def sum_of_squares(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin number and offset of every item, placed in the order given.

    ``leave[g]`` is what taking a bin out of gap ``g`` adds to the sum of
    squares (prohibitive if there is none), ``enter[g]`` what putting one into
    it adds; a full bin counts nowhere.
    """
    none = 1 << 60
    leave = np.full(capacity + 1, none, np.int64)
    enter = np.ones(capacity + 1, np.int64)
    enter[0] = 0
    count = [0] * (capacity + 1)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, n = [], [], 0

    def change(g: int, by: int):
        if g:
            count[g] += by
            leave[g] = 1 - 2 * count[g] if count[g] else none
            enter[g] = 2 * count[g] + 1

    for s in sizes:
        cost = leave[s:] + enter[:capacity + 1 - s]
        i = int(cost.argmin())
        if cost[i] < none >> 1:
            gap = s + i
            b = open_[gap].pop()
            change(gap, -1)
        else:
            gap, b = capacity, n
            n += 1
        bins.append(b)
        offsets.append(capacity - gap)
        change(gap - s, 1)
        if gap > s:
            open_[gap - s].append(b)
    return bins, offsets


def _round(items: DataFrame, parts: int, capacity: int) -> DataFrame:
    """``(item, seq, offset)``: one packing of ``(item, size)`` over ``parts`` tasks."""

    def run(pdf):
        pdf = pdf.sort_values(["size", "h", "item"], ascending=[False, True, True])
        ids = pdf["item"].to_numpy()
        bins, offsets = sum_of_squares(pdf["size"].tolist(), capacity)
        bins, offsets = np.array(bins), np.array(offsets)
        head = np.zeros(bins.max() + 1, np.int64)
        first = offsets == 0
        head[bins[first]] = ids[first]
        return pdf.__class__({"item": ids, "size": pdf["size"].to_numpy(), "seq": head[bins],
                              "offset": offsets})

    h = F.xxhash64("item")
    return items.select("item", "size", h.alias("h"), F.pmod(h, F.lit(parts)).alias("part")) \
        .groupBy("part").applyInPandas(run, "item long, size long, seq long, offset long")


def pack_sizes(items: DataFrame, capacity: int) -> DataFrame:
    """``(item, seq, offset)`` for ``(item, size)`` rows with ``0 < size < capacity``."""
    placed = None
    while True:
        n = items.count()
        if n == 0:
            empty = items.select("item", F.lit(0).cast("long").alias("seq"),
                                 F.lit(0).cast("long").alias("offset"))
            return placed if placed is not None else empty
        parts = max(1, -(-n // ITEMS_PER_TASK))
        now = write_table(_round(items, parts, capacity), "packed")
        if placed is None:
            placed = now.select("item", "seq", "offset")
        else:
            up = now.select(F.col("item").alias("seq"), F.col("seq").alias("up"),
                            F.col("offset").alias("shift"))
            placed = write_table(placed.join(up, "seq", "left").select(
                "item", F.coalesce("up", "seq").alias("seq"),
                (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset")), "placed")
        fill = now.groupBy("seq").agg(F.sum("size").alias("size"))
        items = fill.where(F.col("size") < capacity).select(F.col("seq").alias("item"), "size")
        if parts == 1 or fill.count() > 0.99 * n:
            return placed


def pack(docs: DataFrame, path: str, end_id: int, length: int, text_col: str = "text",
         id_col: str = "doc_id") -> DataFrame:
    """``(id_col, piece, start, length, ids_crc32, sequence_id, offset)``, a row per piece."""
    pieces = token_pieces(docs, path, end_id, length, text_col, id_col)
    pieces = write_table(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    rest = pieces.where(F.col("length") < length) \
        .select(F.col("row").alias("item"), F.col("length").alias("size"))
    placed = pack_sizes(rest, length)
    out = pieces.join(placed.withColumnRenamed("item", "row"), "row", "left")
    return out.select(id_col, "piece", "start", "length", "ids_crc32",
                      F.coalesce("seq", "row").alias("sequence_id"),
                      F.coalesce("offset", F.lit(0)).cast("long").alias("offset"))


def pack_documents(docs: DataFrame) -> DataFrame:
    """The documents' pieces in sequences of 1,024 ids of the public byte-level vocabulary."""
    return pack(docs, tokenizer_path("byte_bpe_50k.json"), 2, 1024)
