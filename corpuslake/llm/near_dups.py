"""Near duplicates by SuperMinHash: signatures, banding, verification, union-find.

1. Every text becomes its set of distinct word shingles and a SuperMinHash
   signature. An element visits the signature's slots in the order of its own
   random permutation and offers ``rank + r`` to each; as lower ranks always
   win, ranks are taken one at a time over all elements, and a document stops
   as soon as every slot is filled (long texts after one or two ranks).
2. Equal sets are one class, so only one representative goes on.
3. Representatives meet in band buckets. A bucket gives a spanning forest of
   the pairs whose signatures agree often enough; a bucket of more than
   ``BUCKET`` members gives a star without looking, which only widens groups.
   Both are linear in the members, and buckets of equal membership count once.
4. Connected candidates are a group. Whole shingle sets go once to their
   group (a large group is cut into blocks, and every pair of blocks is a task),
   where links are confirmed exactly by a breadth-first search that compares
   every found document with all documents not yet found.
5. Components of the confirmed links are the duplicate classes.

The only way to lose a link is that its two texts share no band or that their
signatures agree far less than their sets do: below 1e-6 of links at the
threshold itself, less above it. Nothing is capped.

Defined results: null, empty and wordless texts have an empty set and link with
nothing; rows with a null id link with nothing and have a null component; rows that
share an id are compared each by its own text, so an id's component is that of each
row; repeated rows repeat their result. Texts of any length are read whole, extra
columns are ignored, an empty table gives an empty one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.linkage import banding, candidate_groups, verified_components
from ..operators.skew import skew_join
from ..session import write_table
from . import kernels as K

BUCKET = 1024          # members compared by signature inside one bucket
BLOCK_DOCS = 512       # documents, and
BLOCK_ITEMS = 1 << 21  # shingles in one block of a group


def super_minhash(code: np.ndarray, bounds: np.ndarray, m: int) -> np.ndarray:
    """Signatures (documents x ``m`` 64-bit values) of the given sets.

    The value in a slot is the smallest ``rank * 2**56 + noise`` offered.
    ``swaps`` holds the Fisher-Yates targets drawn so far: the slot an element
    visits at rank j is found by undoing its j earlier swaps.
    """
    n_docs = len(bounds) - 1
    sig = np.full((n_docs, m), np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(n_docs), np.diff(bounds))
    swaps: list[np.ndarray] = []
    for j in range(m):
        if not len(code):
            break
        x = K.mix(code + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        target = (j + (((x & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32))
                  .astype(np.int16)).astype(np.int16)
        slot = target.copy()
        for i in range(j - 1, -1, -1):
            slot[slot == swaps[i]] = i
        value = (np.uint64(j) << np.uint64(56)) | (x >> np.uint64(8))
        np.minimum.at(sig, (owner, slot.astype(np.int64)), value)
        swaps.append(target)
        open_ = (sig == np.iinfo(np.uint64).max).any(axis=1)
        going = open_[owner]
        if not going.all():
            code, owner = code[going], owner[going]
            swaps = [s[going] for s in swaps]
    return sig


def _shingled(column, k: int, hasher):
    for lo, data, off in K.text_chunks(column, K.SMALL_CHUNK):
        data = K.lower_ascii(data)
        start, end, doc = K.words(data, off)
        h = hasher.ranges(hasher.prefix(data), start, end)
        code, bounds = K.shingle_sets(h, doc, len(off) - 1, k)
        yield lo, len(off) - 1, code, bounds


def fingerprint(code: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """24 bytes that tell sets apart: two sums over their members and their size."""
    sums = []
    for salt in (1, 2):
        s = np.zeros(len(code) + 1, np.uint64)
        np.cumsum(K.mix(code + np.uint64(salt)), out=s[1:])
        sums.append((s[bounds[1:]] - s[bounds[:-1]]).astype(">u8"))
    return [f.tobytes() for f in np.stack([*sums, np.diff(bounds).astype(">u8")], axis=1)]


def signatures(docs: DataFrame, text_col: str, id_col: str, k: int, bands: int,
               rows: int) -> DataFrame:
    """``(id, n_shingles, fp, bands, sig)``; ``fp`` is null for what links with nothing."""

    def run(batches):
        hasher = K.Hasher()
        for b in batches:
            for lo, n, code, bounds in _shingled(b.column(1), k, hasher):
                size = np.diff(bounds)
                sig = super_minhash(code, bounds, bands * rows)
                keys = np.zeros((n, bands), np.uint64)
                for r, q in enumerate(K.stream(rows, 99) | np.uint64(1)):
                    keys += sig[:, r::rows] * q
                keys = K.mix(keys + np.arange(bands, dtype=np.uint64)).astype(np.int64)
                short = K.mix(sig).astype(np.uint16)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, n), pa.array(size, pa.int64()),
                    pa.array([f if s else None for f, s in zip(fingerprint(code, bounds), size)], pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(keys.ravel())),
                    pa.array([s.tobytes() for s in short], pa.binary())],
                    names=["id", "n_shingles", "fp", "bands", "sig"])

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = d.mapInArrow(K.tidy(run), "id long, n_shingles long, fp binary, bands array<long>, sig binary")
    return out.withColumn("fp", F.when(F.col("id").isNotNull(), F.col("fp")))


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", k: int = 5,
                    percent: int = 80) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)``, one row per input row.

    Documents are linked when ``100 * |A & B| >= percent * |A | B|`` on their
    distinct ``k``-word shingles; ``component_id`` is the smallest id reachable.
    """
    bands, rows = banding(percent / 100)
    t, m = percent / 100, bands * rows
    sigs = write_table(signatures(docs, text_col, id_col, k, bands, rows)
                       .withColumn("at", F.monotonically_increasing_id()), "superminhash")
    # one representative for each distinct set, whatever ids its rows have
    reps = sigs.where("fp is not null").groupBy("fp").agg(F.min("id").alias("least"), F.min("at").alias("at"))
    reps = write_table(reps.withColumn("rep", F.monotonically_increasing_id()), "set-reps")
    own = sigs.join(reps.select("rep", "at"), "at").select("rep", "bands", "sig")
    cells = own.select("rep", F.posexplode("bands").alias("band", "h")) \
        .select("rep", F.xxhash64("band", "h").alias("key"))
    agree = math.floor(m * (t - 5 * math.sqrt(t * (1 - t) / m)))
    groups = candidate_groups(cells, own.select("rep", "sig"), agree, m, BUCKET)

    # whole sets of the representatives' rows; of a row that shares an id only with one, the set isn't asked for
    hasher_k = k

    def sets(batches):
        hasher = K.Hasher()
        for b in batches:
            for _, _, code, bounds in _shingled(b.column(1), hasher_k, hasher):
                yield pa.RecordBatch.from_arrays([
                    pa.array(fingerprint(code, bounds), pa.binary()),
                    pa.array([code[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:])], pa.binary())],
                    names=["fp", "codes"])

    wanted = write_table(groups.withColumnRenamed("id", "rep").join(reps.select("rep", "least", "fp"), "rep"), "set-groups")
    texts = docs.select(F.col(id_col).cast("long").alias("least"), F.col(text_col).alias("text"))
    full = texts.join(wanted.select("least"), "least", "left_semi").mapInArrow(K.tidy(sets), "fp binary, codes binary") \
        .join(wanted.select("fp", F.col("rep").alias("id"), "grp"), "fp").dropDuplicates(["fp"]).select("id", "grp", "codes")
    full = write_table(full, "shingle-sets")
    linked = verified_components(full, percent, BLOCK_DOCS, BLOCK_ITEMS).select(F.col("node").alias("rep"), "label")

    # a class is named by the smallest id of its rows
    linked = write_table(linked.join(reps.select("rep", "fp", "least"), "rep"), "set-classes")
    names = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    named = skew_join(linked, names, "label", spread=["rep"]).select("rep", "component_id")
    head = reps.join(named, "rep", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    out = skew_join(sigs.select("id", "n_shingles", "fp", "at"), head, "fp", "left", spread=["at"])
    comp = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", comp.alias("component_id"),
                      F.coalesce(F.col("id") == comp, F.lit(True)).alias("kept"))
