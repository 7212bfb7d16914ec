"""Phrase collocations by dynamic itemset counting over cyclic scans of shards.

The corpus is written once as ``shards`` shards. Step t scans shard ``(t - 1) mod
shards`` and counts phrases of all lengths together:

* words are counted from the first step on;
* a longer phrase is activated once both of its subphrases (without its last and
  without its first word) have reached the threshold, and is counted from the next
  step on, until it has seen every shard once.

Whether a phrase has reached the threshold is read from hashed counters of a fixed
size (``bits`` per length, saturating at the threshold), which sum what the steps
counted so far. Such a counter is never below the phrase's own count, so nothing
frequent is missed; a shared bucket only activates a phrase that needn't be. Exact
counts, keyed by the phrase's text, begin when its own counter has reached the
threshold and likewise cover one full cycle. The last activations fall into the cycle
of their length, so ``max_len + 1`` cycles always end it. Counters are fixed in size:
a corpus of many more distinct phrases than counters is counted as rightly, with less
left out.

Every step is a map over its shard: counts leave a task already summed, and counters
as compressed slices. Only the counters' final slices (at most 72 MB by default,
whatever the corpus) pass through the driver. Exact counts meet in one aggregate.

Defined results: a null language is ``und``, null, empty and wordless texts hold
nothing, repeated rows count each time, ties are ranked by count and by the phrase's
UTF-8 bytes, texts are read whole, extra columns are ignored, no rows or no
candidates give an empty table.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.order import partitioned_offsets
from ..session import scratch_path, write_table
from . import kernels as K

SHARDS = 3
BITS = (23, 25, 25)      # log2 of the counters of one-word, two-word, ... phrases
SLICE = 1 << 16          # counters in one slice
FAN_IN = 256             # slices summed at once
CHUNK = 1 << 19
HELD = 1 << 19           # counted rows that a task holds
NEVER = 255              # step of a counter that has not reached the threshold
_BREAK = K.byte_class(b".,;:!?\n\v\f\r")
_GAP = _BREAK | K.byte_class(b" \t")
_ROW = "kind string, k int, lang string, phrase string, slice int, part long, n long, data binary"


def lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Phrases:
    """Words and phrases of a chunk of texts: ``hash[k]`` of the phrase of ``k + 1``
    words that begins at each word, ``whole[k]`` whether it lies inside one piece."""

    def __init__(self, hasher: K.Hasher, data: np.ndarray, off: np.ndarray, seed: np.ndarray, max_len: int):
        gap = _GAP[data]
        self.start, self.end = K.runs(~gap, off)
        self.size = self.end - self.start
        n = len(self.start)
        self.doc = np.repeat(np.arange(len(off) - 1), np.diff(np.searchsorted(self.start, off)))
        breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])
        joined = np.zeros(n, bool)
        joined[:-1] = (self.doc[1:] == self.doc[:-1]) & (breaks[self.start[1:]] == breaks[self.end[:-1]])
        word = hasher.ranges(hasher.prefix(data), self.start, self.end) + seed[self.doc]
        odd = K.stream(max_len, 171) | np.uint64(1)
        total, inside = word * odd[0], np.ones(n, bool)
        self.hash, self.whole = [K.mix(total)], [inside]
        for k in range(1, max_len):
            total = total.copy()
            total[:n - k] += word[k:] * odd[k]
            inside = inside.copy()
            inside[:n - k] &= joined[k - 1:n - 1]
            inside[max(n - k, 0):] = False
            self.hash.append(K.mix(total))
            self.whole.append(inside)
        # the words alone, one blank apart
        letters = np.flatnonzero(~gap)
        self.at = np.cumsum(self.size + 1) - (self.size + 1)
        self.text = np.full(len(letters) + n, 32, np.uint8)
        self.text[np.arange(len(letters)) + np.repeat(np.arange(n), self.size)] = data[letters]

    def strings(self, where: np.ndarray, k: int) -> pa.Array:
        """Texts of the ``k + 1``-word phrases at the given words."""
        begin = self.at[where]
        size = self.at[where + k] + self.size[where + k] - begin
        off = np.concatenate([[0], np.cumsum(size)])
        flat = self.text[np.arange(off[-1]) + np.repeat(begin - off[:-1], size)]
        return pa.LargeStringArray.from_buffers(len(where), pa.py_buffer(off.astype(np.int64)), pa.py_buffer(flat))


def starts(p: Phrases, ripe: list[np.ndarray], bits) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For every length and word, the steps after which the phrase's counter and its
    exact count begin (``NEVER``: not yet)."""
    active, own = [], []
    for k in range(len(p.hash)):
        if k == 0:
            a = np.zeros(len(p.start), np.uint8)
        else:                                       # both subphrases
            a = np.full(len(p.start), NEVER, np.uint8)
            a[:-1] = np.maximum(own[-1][:-1], own[-1][1:])
            a[~p.whole[k]] = NEVER
        active.append(a)
        own.append(np.maximum(a, ripe[k][p.hash[k] >> np.uint64(64 - bits[k])]))
    return active, own


def step_counts(shard: DataFrame, step: int, shards: int, threshold: int, max_len: int, bits, ripe) -> DataFrame:
    """Counts and counters of one step over ``shard(lang, text)``; see ``_ROW``.

    ``ripe`` is a broadcast list of compressed byte arrays, the step at which each
    counter of a length reached the threshold.
    """

    def in_cycle(since: np.ndarray) -> np.ndarray:
        since = since.astype(np.int64)
        return (since != NEVER) & (since < step) & (step <= since + shards)

    def rows(kind, k, lang=None, phrase=None, at=None, part=0, n=None, data=None):
        m = len(n if n is not None else data)
        return pa.RecordBatch.from_arrays([
            pa.array([kind] * m, pa.string()), pa.array([k] * m, pa.int32()),
            pa.nulls(m, pa.string()) if lang is None else lang.cast(pa.string()),
            pa.nulls(m, pa.string()) if phrase is None else phrase.cast(pa.string()),
            pa.nulls(m, pa.int32()) if at is None else pa.array(at, pa.int32()),
            pa.array([part] * m, pa.int64()), pa.nulls(m, pa.int64()) if n is None else pa.array(n, pa.int64()),
            pa.nulls(m, pa.binary()) if data is None else pa.array(data, pa.binary())],
            names=["kind", "k", "lang", "phrase", "slice", "part", "n", "data"])

    def run(batches):
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        hasher = K.Hasher()
        steps = [np.frombuffer(zlib.decompress(z), np.uint8) for z in ripe.value]
        counter: dict[int, np.ndarray] = {}
        held: list[pa.Table] = []

        def summed(keep: int):
            """Held counts brought together, and sent on where more than ``keep`` rows are left."""
            t = pa.concat_tables(held).group_by(["k", "lang", "phrase"]).aggregate([("n", "sum")]) \
                .rename_columns({"n_sum": "n"})
            held[:] = [t] if t.num_rows <= keep else []
            for b in t.to_batches(max_chunksize=1 << 14) if not held else ():
                yield pa.RecordBatch.from_arrays([
                    pa.array(["count"] * len(b), pa.string()), b.column("k"), b.column("lang").cast(pa.string()),
                    b.column("phrase").cast(pa.string()), pa.nulls(len(b), pa.int32()),
                    pa.array([task] * len(b), pa.int64()), b.column("n"), pa.nulls(len(b), pa.binary())],
                    names=["kind", "k", "lang", "phrase", "slice", "part", "n", "data"])

        for b in batches:
            codes = pc.dictionary_encode(b.column(0))
            langs = codes.dictionary
            seeds = np.array([lang_hash(x) for x in langs.to_pylist()], np.uint64)
            codes = codes.indices.to_numpy(zero_copy_only=False)
            for lo, data, off in K.text_chunks(b.column(1), CHUNK):
                code = codes[lo:lo + len(off) - 1]
                p = Phrases(hasher, K.lower_ascii(data), off, seeds[code], max_len)
                if not len(p.start):
                    continue
                active, own = starts(p, steps, bits)
                for k in range(max_len):
                    h = p.hash[k][p.whole[k] & in_cycle(active[k])]
                    if len(h):
                        cell, n = np.unique(h >> np.uint64(64 - bits[k]), return_counts=True)
                        if k not in counter:
                            counter[k] = np.zeros(1 << bits[k], np.uint8)
                        counter[k][cell] = np.minimum(counter[k][cell].astype(np.int64) + n, threshold)
                    where = np.flatnonzero(p.whole[k] & in_cycle(own[k]))
                    if len(where):
                        d = pc.dictionary_encode(p.strings(where, k))
                        key = d.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(langs) + code[p.doc[where]]
                        key, n = np.unique(key, return_counts=True)
                        held.append(pa.table({"k": pa.array(np.full(len(key), k + 1, np.int32)),
                                              "lang": langs.take(pa.array(key % len(langs))).cast(pa.large_string()),
                                              "phrase": d.dictionary.take(pa.array(key // len(langs))),
                                              "n": pa.array(n.astype(np.int64))}))
                if step <= shards:                  # every word, for the languages' totals
                    n = np.bincount(code[p.doc], minlength=len(langs))
                    yield rows("total", 0, lang=langs, n=n)
                if sum(t.num_rows for t in held) > HELD:
                    yield from summed(HELD // 2)
        if held:
            yield from summed(0)
        for k, c in counter.items():
            some = np.flatnonzero(c.reshape(-1, SLICE).any(axis=1))
            for i in range(0, len(some), 64):
                yield rows("counter", k, at=some[i:i + 64], part=task,
                           data=[zlib.compress(c[s * SLICE:(s + 1) * SLICE].tobytes(), 1) for s in some[i:i + 64]])

    return shard.select("lang", "text").mapInArrow(K.tidy(run), _ROW)


def counter_sums(slices: DataFrame, threshold: int) -> DataFrame:
    """``(k, slice, data)``: sums of all tasks' slices, saturating at the threshold;
    at most ``FAN_IN`` slices meet in a task."""

    def run(pdf):
        total = np.zeros(SLICE, np.int64)
        for d in pdf["data"]:
            total += np.frombuffer(zlib.decompress(d), np.uint8)
        data = zlib.compress(np.minimum(total, threshold).astype(np.uint8).tobytes(), 1)
        return pdf.head(1).assign(data=[data])[["k", "slice", "part", "data"]]

    at = slices.select("k", "slice", "part", "data")
    parts = at.agg(F.max("part")).first()[0]
    while parts is not None:
        at = at.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("k", "slice", "part") \
            .applyInPandas(run, "k int, slice int, part long, data binary")
        if parts < FAN_IN:
            return at.select("k", "slice", "data")
        at, parts = write_table(at, "dic-counters"), parts // FAN_IN
    return at.select("k", "slice", "data")


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_len: int = 3,
                  threshold: int = 10, shards: int = SHARDS, bits=BITS) -> tuple[DataFrame, DataFrame]:
    """``(lang, k, phrase, f)`` of every phrase of up to ``max_len`` words that occurs
    ``threshold`` times or more in its language, and ``(lang, n)``, words by language."""
    if not (1 <= threshold < NEVER and 1 <= max_len <= len(bits) and (max_len + 1) * shards < NEVER):
        raise ValueError("threshold, length or shards beyond what a counter's byte holds")
    spark = docs.sparkSession
    home, out = scratch_path(spark, "dic-shards"), scratch_path(spark, "dic-counts")
    docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard")) \
        .write.partitionBy("shard").option("compression", "zstd").parquet(home)
    texts = spark.read.schema("lang string, text string, shard int").parquet(home)
    count = [np.zeros(1 << bits[k], np.uint8) for k in range(max_len)]
    ripe = [np.full(1 << bits[k], NEVER, np.uint8) for k in range(max_len)]
    last, step = shards, 0
    while step < last:
        step += 1
        shipped = spark.sparkContext.broadcast([zlib.compress(x.tobytes(), 1) for x in ripe])
        path = f"{out}/step={step}"
        step_counts(texts.where(F.col("shard") == (step - 1) % shards), step, shards, threshold, max_len, bits,
                    shipped).write.partitionBy("kind").option("compression", "zstd").parquet(path)
        done = spark.read.schema(StructType.fromDDL(_ROW)).parquet(path)
        for r in counter_sums(done.where("kind = 'counter'"), threshold).collect():
            at = slice(r.slice * SLICE, (r.slice + 1) * SLICE)
            c = count[r.k][at]
            c[:] = np.minimum(c.astype(np.int64) + np.frombuffer(zlib.decompress(r.data), np.uint8), threshold)
            ripe[r.k][at][(c >= threshold) & (ripe[r.k][at] == NEVER)] = step
        since = [int(x[x != NEVER].max()) for x in ripe if (x != NEVER).any()]
        last = max([shards] + [s + shards for s in since])
        shipped.destroy()
    counts = spark.read.schema(StructType.fromDDL(_ROW + ", step int")).parquet(out)
    f = counts.where("kind = 'count'").groupBy("lang", "k", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= threshold)
    return f, counts.where("kind = 'total'").groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_len: int = 3, threshold: int = 10,
                 cover: int = 50, top: int = 2000, shards: int = SHARDS, bits=BITS) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases of 2
    to ``max_len`` words by their weakest cut.

    A cut into two parts with counts l and r scores ``floor(1000000 * a * a / (l * r))``;
    the lowest score counts, ties to the earliest cut. Phrases inside a longer candidate
    that has ``cover`` per cent of their count or more are dropped.
    """
    f, totals = phrase_counts(docs, text_col, lang_col, max_len, threshold, shards, bits)
    f = write_table(f, "dic-phrases")
    cand = f.where("k > 1").withColumnRenamed("f", "a")
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1))
    part = f.select("lang", F.col("phrase").alias("part"), "f")
    cuts = cand.withColumn("cut", cut).withColumn("w", F.split("phrase", " ", -1)) \
        .withColumn("left", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ")) \
        .withColumn("right", F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ")).drop("w")
    cuts = cuts.join(part.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"]) \
        .join(part.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    wide = "cast({} as decimal(15, 0))"
    cuts = cuts.withColumn("score", F.expr(f"cast(1000000 as decimal(7, 0)) * {wide.format('a')} * {wide.format('a')} "
                                           f"div ({wide.format('l')} * {wide.format('r')})"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "k", "a", "l", "r")).alias("b")) \
        .select("lang", "phrase", "b.*").drop("cut")
    inner = cand.where("k > 2").withColumn("w", F.split("phrase", " ", -1)) \
        .withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1))) \
        .withColumn("i", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1))) \
        .select("lang", F.array_join(F.slice("w", F.col("i"), F.col("size")), " ").alias("phrase"), F.col("a").alias("around")) \
        .groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = best.join(inner, ["lang", "phrase"], "left") \
        .where(F.expr(f"around is null or 100 * around < {cover} * a")).drop("around", "k")
    kept = write_table(kept, "collocations")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    ranked = partitioned_offsets(kept, "lang", order, ordinal_col="at").where(F.col("at") < top)
    return ranked.join(totals, "lang").select("lang", (F.col("at") + 1).cast("long").alias("rank"), "phrase", "a", "l", "r",
                                              "n", F.col("score").cast("long").alias("score"))
