"""Quality classifier: hashed word n-grams, follow-the-regularised-leader updates.

A text's features are its words and word pairs, and in a group of their own the
words' shapes (runs of character classes), pairs of shapes and pairs of equal
words, hashed to ``2**BITS`` buckets; each feature has the square root of its
share of its group, so both groups have unit length. FTRL-proximal is run
on a bounded sample of labelled rows: at most ``TRAIN_ROWS`` of them, by hash of
the id. ``SHARDS`` tasks train on a share each, and their weights are averaged;
features are taken before the rows are dealt out, so only bucket numbers move.
A score is the logistic of a sparse dot product.

Defined results: null, empty and wordless texts have no features and score the
bias alone; without labelled rows every score is one half. Repeated rows are
scored alike; of rows that share an id all are training rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import id_crc, sample_by_hash

BITS = 20
TRAIN_ROWS = 40_000
SHARDS = 4
EPOCHS, LEAST_STEPS = 3, 30_000     # passes over a share; more over few rows, up to ten times as many
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-4, 1e-3

_CLASS = np.full(256, 6, np.uint8)                       # other bytes beyond ASCII: letters
_CLASS[:128] = 5
for _n, _members in enumerate([range(97, 123), range(65, 91), range(48, 58), b"#*$%&|<>", b".,;:!?'\"()-"]):
    _CLASS[list(_members)] = _n
_CLASS[128:] = 0


class Featurizer:
    """Feature buckets of the documents of a chunk and their values: ``(buckets, values, bounds)``.

    The upper half of the buckets belongs to the shapes.
    """

    def __init__(self):
        self.hasher = K.Hasher()

    def __call__(self, data: np.ndarray, off: np.ndarray):
        n = len(off) - 1
        kind = _CLASS[data]
        data = K.lower_ascii(data)
        start, end, doc = K.words(data, off)
        word = self.hasher.ranges(self.hasher.prefix(data), start, end)
        # shapes: each word's classes without repetitions
        turn = np.ones(len(kind), bool)
        turn[1:] = kind[1:] != kind[:-1]
        turn[start] = True
        at = np.concatenate([[0], np.cumsum(turn)])
        small = kind[turn]
        shape = self.hasher.ranges(self.hasher.prefix(small), at[start], np.maximum(at[end], at[start] + 1)) \
            if len(start) else word
        same = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) > 1 else np.zeros(0, np.int64)
        pair = lambda h: K.mix(h[same] * np.uint64(0x9E3779B97F4A7C15) + h[same + 1])
        twice = same[word[same] == word[same + 1]]       # a pair of one word, whichever
        keys = []
        for group, parts, owners in ((0, [word, pair(word)], [doc, doc[same]]),
                                     (1, [shape, pair(shape), np.full(len(twice), 12345 << 40, np.uint64)],
                                      [doc, doc[same], doc[twice]])):
            bucket = (np.concatenate(parts) >> np.uint64(65 - BITS)).astype(np.int64) + (group << (BITS - 1))
            keys.append(np.concatenate(owners) * (1 << BITS) + bucket)
        total = [np.bincount(k >> BITS, minlength=n) for k in keys]
        key, times = np.unique(np.concatenate(keys), return_counts=True)
        owner, bucket = key >> BITS, key & ((1 << BITS) - 1)
        share = times / np.where(bucket >> (BITS - 1), total[1][owner], total[0][owner])
        return bucket.astype(np.int32), np.sqrt(share).astype(np.float32), np.searchsorted(owner, np.arange(n + 1))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias after the passes of FTRL-proximal over sparse rows.

    Classes weigh alike: each row counts inversely to its class's share, within limits.
    """
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    zb = nb = 0.0
    share = max(labels.mean(), 1e-9) if len(labels) else 0.5
    weight = {1: min(0.5 / share, 10.0), 0: min(0.5 / max(1 - share, 1e-9), 10.0)}

    def current(z, n):
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(min(max(EPOCHS, LEAST_STEPS // max(len(rows), 1)), 10 * EPOCHS)):
        for (idx, x), y in zip(rows, labels):
            w, wb = current(z[idx], n[idx]), float(current(np.array(zb), np.array(nb)))
            p = 1 / (1 + np.exp(-np.clip(w @ x + wb, -30, 30)))
            g = (p - y) * weight[int(y)]
            gx = g * x
            sigma = (np.sqrt(n[idx] + gx * gx) - np.sqrt(n[idx])) / ALPHA
            z[idx] += gx - sigma * w
            n[idx] += gx * gx
            sb = (np.sqrt(nb + g * g) - np.sqrt(nb)) / ALPHA
            zb, nb = zb + g - sb * wb, nb + g * g
    return current(z, n), float(current(np.array(zb), np.array(nb)))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", held_out=None,
          text_col: str = "text", id_col: str = "doc_id") -> tuple[np.ndarray, float]:
    """Averaged weights and bias; ``held_out`` marks label rows that are not learnt from."""
    lab = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label_col).cast("int").alias("y"),
                        *([held_out.alias("_h")] if held_out is not None else []))
    lab = lab.where(F.col("id").isNotNull() & F.col("y").isin(0, 1))
    if held_out is not None:
        lab = lab.where(~F.col("_h")).drop("_h")
    # at most TRAIN_ROWS rows of two numbers, so this side may be broadcast
    few = F.broadcast(sample_by_hash(lab.dropDuplicates(["id"]), "id", TRAIN_ROWS))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(few, "id")

    def features(batches):
        f = Featurizer()
        for b in batches:
            for lo, data, off in K.text_chunks(b.column(1), K.SMALL_CHUNK):
                idx, x, at = f(data, off)
                both = [pa.array([v[at[i]:at[i + 1]].tobytes() for i in range(len(at) - 1)], pa.binary())
                        for v in (idx, x)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(at) - 1), b.column(2).slice(lo, len(at) - 1)] + both,
                    names=["id", "y", "idx", "x"])

    def fit(batches):
        got = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in range(4)))]
        if not got:
            return
        got.sort(key=lambda r: (int(K.mix(np.array([r[0]]).astype(np.uint64))[0]), r[2]))
        w, bias = ftrl([(np.frombuffer(i, np.int32), np.frombuffer(x, np.float32).astype(np.float64))
                        for _, _, i, x in got], np.array([r[1] for r in got]))
        at = np.flatnonzero(w).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([len(got)], pa.int64()), pa.array([bias]), pa.array([at.tobytes()], pa.binary()),
             pa.array([w[at].astype("<f4").tobytes()], pa.binary())], names=["n", "bias", "at", "w"])

    sparse = rows.select("id", "text", "y").mapInArrow(K.tidy(features), "id long, y int, idx binary, x binary")
    models = sparse.repartition(SHARDS, F.pmod(F.xxhash64("id"), F.lit(SHARDS))) \
        .mapInArrow(K.tidy(fit), "n long, bias double, at binary, w binary").collect()
    weights, bias, total = np.zeros(1 << BITS), 0.0, sum(m["n"] for m in models)
    for m in models:
        weights[np.frombuffer(m["at"], np.int32)] += np.frombuffer(m["w"], "<f4") * (m["n"] / total)
        bias += m["bias"] * m["n"] / total
    return weights.astype(np.float32), bias


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", modulus: int = 3,
             held_remainder: int = 1, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id_col, held_out, score, predicted)``, one row per input row."""
    held = id_crc("doc_id") % modulus == held_remainder
    weights, bias = train(docs, labels, label_col, held, text_col, id_col)
    shipped = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        f, w = Featurizer(), shipped.value
        for b in batches:
            for lo, data, off in K.text_chunks(b.column(1), K.SMALL_CHUNK):
                idx, x, at = f(data, off)
                total = np.concatenate([[0.0], np.cumsum(w[idx] * x, dtype=np.float64)])
                dot = total[at[1:]] - total[at[:-1]]
                score = 1 / (1 + np.exp(-np.clip(dot + bias, -30, 30)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, len(score)), pa.array(score)],
                                                 names=["id", "score"])

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = d.mapInArrow(K.tidy(run), "id long, score double")
    return out.select(F.col("id").alias(id_col), (id_crc("id") % modulus == held_remainder).alias("held_out"),
                      "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
