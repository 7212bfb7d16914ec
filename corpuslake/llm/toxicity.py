"""Toxic passages as maximal scoring segments of token log-odds.

1. Tokens (runs of bytes that are neither white space nor ASCII punctuation,
   A-Z lower-cased) are counted by class over labelled training rows in
   ``2**BITS`` hash buckets, once per row. Their log-odds have an informative
   Dirichlet prior: pseudo-counts in proportion to the whole counts. A bucket
   whose log-odds are at least ``LEAST`` in size and ``Z_LIMIT`` standard errors
   from nothing keeps them, others score zero; every token then pays ``DRIFT``, so
   ordinary text has a negative mean score.
2. All maximal scoring segments of a text are found in linear time (runs of like
   sign first, then one stack of left-minimal candidates).
3. By extreme-value theory the best segment of ``n`` ordinary tokens exceeds S
   with probability ``1 - exp(-K n exp(-lambda S))``; lambda solves the
   moment equation of the ordinary token scores, K is fitted to the best
   segments of ordinary training rows. Each segment's excess over its text's
   expectation, ``lambda S - log(K n)``, where positive, is added up, and a
   logistic curve fitted on the training rows makes a probability of the total.

Training rows are a documented bounded sample: at most ``TRAIN_ROWS`` of each
class, by hash of the id.

Defined results: null, empty and wordless texts have no passages and score as
other texts without any; without rows of both classes every score is zero.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import id_crc, sample_by_hash

BITS = 20
TRAIN_ROWS = 25_000
PRIOR_SHARE = 0.1        # pseudo-counts of the Dirichlet prior, as a share of all counts
Z_LIMIT, LEAST = 3.0, 1.0
SIGNIFICANT = 3.0        # excess of a passage that is reported: a chance of one in twenty
DRIFT = 0.25
CLIP = 6.0

_TOKEN = ~(K.SPACE | K.byte_class(bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())))


def tokens(data: np.ndarray, off: np.ndarray, hasher: K.Hasher):
    """``(buckets, starts, ends, document)`` of the tokens of a chunk."""
    data = K.lower_ascii(data)
    start, end = K.runs(_TOKEN[data], off)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(np.searchsorted(start, off)))
    h = hasher.ranges(hasher.prefix(data), start, end)
    return (h >> np.uint64(64 - BITS)).astype(np.int64), start, end, doc


def log_odds(toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Score of every bucket, before the drift."""
    n1, n0 = toxic.sum(), other.sum()
    if not n1 or not n0:
        return np.zeros(len(toxic))
    prior = PRIOR_SHARE * (n1 + n0)
    alpha = PRIOR_SHARE * (toxic + other) + 1e-9
    a, b = toxic + alpha, other + alpha
    delta = np.log(a / np.maximum(n1 + prior - a, 1e-9)) - np.log(b / np.maximum(n0 + prior - b, 1e-9))
    z = delta / np.sqrt(1 / a + 1 / b)
    return np.where((np.abs(z) >= Z_LIMIT) & (np.abs(delta) >= LEAST), np.clip(delta, -CLIP, CLIP), 0.0)


def maximal_segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, end, score)`` of a score sequence.

    Tokens of like sign are joined to runs; the stack holds segments whose sums
    left of them (``low``) rise and whose ends (``high``) have not been passed.
    """
    if not (score > 0).any():
        return []
    sign = score > 0
    head = np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1]]))
    tail = np.append(head[1:], len(score))
    sums = np.add.reduceat(score, head)
    stack: list[list] = []          # first, end, low, high
    total = 0.0
    for a, b, s in zip(head.tolist(), tail.tolist(), sums.tolist()):
        if s > 0:
            seg = [a, b, total, total + s]
            while True:
                i = len(stack) - 1
                while i >= 0 and stack[i][2] >= seg[2]:
                    i -= 1
                if i < 0 or stack[i][3] >= seg[3]:
                    stack.append(seg)
                    break
                seg = [stack[i][0], seg[1], stack[i][2], seg[3]]
                del stack[i:]
        total += s
    return [(a, b, high - low) for a, b, low, high in stack]


def solve_lambda(values: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of ``sum p exp(lambda s) = 1`` (negative mean, some positive scores)."""
    p = weights / weights.sum()
    if not (values > 0).any() or (p * values).sum() >= 0:
        return 1.0
    f = lambda lam: float((p * np.exp(np.clip(lam * values, -700, 700))).sum()) - 1
    lo, hi = 0.0, 1.0
    while f(hi) < 0 and hi < 64:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return max(hi, 1e-3)


def fit_curve(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through binned totals; the slope is positive."""
    a, b = 1.0, -2.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(w * (p - y) * x).sum() + 0.01 * (a - 1), (w * (p - y)).sum() + 0.01 * b])
        v = w * p * (1 - p)
        h = np.array([[(v * x * x).sum() + 0.01, (v * x).sum()], [(v * x).sum(), v.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        a, b = max(a - step[0], 1e-3), b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


class ToxicModel:
    """Bucket scores, the extreme-value law and the curve."""

    def __init__(self, odds: np.ndarray):
        self.odds = odds.astype(np.float32)
        self.lam, self.k, self.slope, self.offset = 1.0, 1e-3, 1.0, -30.0

    def excess(self, segments, n: int) -> list[float]:
        base = math.log(max(self.k * max(n, 1), 1e-12))
        return [self.lam * s - base for _, _, s in segments]

    def segments(self, data, off, hasher):
        """For each document its number of tokens, segments and their tokens' bounds."""
        bucket, start, end, doc = tokens(data, off, hasher)
        score = self.odds[bucket].astype(np.float64) - DRIFT
        at = np.searchsorted(doc, np.arange(len(off)))
        some = np.concatenate([[0], np.cumsum(score > 0)])[at]
        for d in range(len(off) - 1):
            a, b = at[d], at[d + 1]
            yield (b - a, maximal_segments(score[a:b]) if some[d + 1] > some[d] else [],
                   start[a:b], end[a:b])

    def total(self, n: int, segments) -> float:
        return sum(e for e in self.excess(segments, n) if e > 0)

    def score(self, total: float) -> float:
        return 1 / (1 + math.exp(-min(max(self.slope * total + self.offset, -30.0), 30.0)))


def fit(docs: DataFrame, labels: DataFrame, held_out=None, text_col: str = "text",
        id_col: str = "doc_id") -> ToxicModel:
    lab = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("y"),
                        *([held_out.alias("_h")] if held_out is not None else []))
    lab = lab.where(F.col("id").isNotNull() & F.col("y").isin(0, 1))
    if held_out is not None:
        lab = lab.where(~F.col("_h")).drop("_h")
    lab = lab.dropDuplicates(["id"])
    # at most 2 * TRAIN_ROWS rows of two numbers, so this side may be broadcast
    few = F.broadcast(sample_by_hash(lab.where("y = 1"), "id", TRAIN_ROWS)
                      .unionByName(sample_by_hash(lab.where("y = 0"), "id", TRAIN_ROWS)))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
        .join(few, "id").select("text", "y")

    def count(batches):
        hasher, n = K.Hasher(), np.zeros((3, 1 << BITS), np.int64)
        for b in batches:
            y = b.column(1).to_numpy(zero_copy_only=False)
            for lo, data, off in K.text_chunks(b.column(0), K.SMALL_CHUNK):
                bucket, _, _, doc = tokens(data, off, hasher)
                n[2] += np.bincount(bucket[y[lo + doc] == 0], minlength=1 << BITS)
                once = np.unique(doc * (1 << BITS) + bucket)
                label = y[lo + (once >> BITS)]
                for c in (0, 1):
                    n[c] += np.bincount(once[label == c] & ((1 << BITS) - 1), minlength=1 << BITS)
        at = np.flatnonzero(n.sum(axis=0))
        for i in range(0, len(at), 50_000):
            p = at[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(n[0, p]), pa.array(n[1, p]), pa.array(n[2, p])],
                                             names=["bucket", "other", "toxic", "uses"])

    counted = rows.mapInArrow(K.tidy(count), "bucket long, other long, toxic long, uses long").groupBy("bucket") \
        .agg(*[F.sum(c).alias(c) for c in ("other", "toxic", "uses")]).toArrow()
    n = np.zeros((3, 1 << BITS), np.int64)            # never more than 2**BITS rows
    at = counted.column("bucket").to_numpy()
    for i, c in enumerate(("other", "toxic", "uses")):
        n[i, at] = counted.column(c).to_numpy()
    model = ToxicModel(log_odds(n[1], n[0]))
    if not n[0].sum() or not n[1].sum():
        return model
    model.lam = solve_lambda(model.odds.astype(np.float64) - DRIFT, n[2].astype(np.float64))

    # the best segments of ordinary rows give K; totals of all rows, in bins, the curve
    def best(batches):
        hasher = K.Hasher()
        for b in batches:
            y = b.column(1).to_numpy(zero_copy_only=False)
            out = []
            for lo, data, off in K.text_chunks(b.column(0), K.SMALL_CHUNK):
                for d, (size, seg, _, _) in enumerate(model.segments(data, off, hasher)):
                    out.append((int(y[lo + d]), int(size), [s for _, _, s in seg]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                     pa.array([o[2] for o in out], pa.list_(pa.float64()))], names=["y", "n", "s"])

    found = rows.mapInArrow(K.tidy(best), "y long, n long, s array<double>").toArrow()    # the bounded sample
    sample = list(zip(found.column("y").to_pylist(), found.column("n").to_pylist(),
                      found.column("s").to_pylist()))
    # texts without any positive token say their best segment is at most zero
    gumbel = [model.lam * max(s, default=0.0) - math.log(size) for y, size, s in sample if y == 0 and size]
    if gumbel:
        model.k = math.exp(min(float(np.mean(gumbel)) - 0.5772156649, 0.0))
    x = np.array([model.total(size, [(0, 0, v) for v in s]) for _, size, s in sample])
    y = np.array([r[0] for r in sample], np.float64)
    model.slope, model.offset = fit_curve(x, y, np.ones(len(x)))
    return model


def score_documents(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_remainder: int = 0,
                    text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id_col, held_out, score, predicted, n_passages, passages)``, one row per input row.

    ``passages`` lists the significant segments (excess over ``SIGNIFICANT``) as
    ``start:end:excess`` in code points.
    """
    held = id_crc("doc_id") % modulus == held_remainder
    shipped = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, held, text_col, id_col))

    def run(batches):
        hasher, m = K.Hasher(), shipped.value
        for b in batches:
            for lo, data, off in K.text_chunks(b.column(1), K.SMALL_CHUNK):
                head = np.concatenate([[0], np.cumsum(K.code_points(data))])
                scores, passages = [], []
                for d, (n, seg, start, end) in enumerate(m.segments(data, off, hasher)):
                    ex = m.excess(seg, n)
                    scores.append(m.score(sum(e for e in ex if e > 0)))
                    zero = head[off[d]]
                    passages.append([f"{head[start[s[0]]] - zero}:{head[end[s[1] - 1]] - zero}:{e:.2f}"
                                     for s, e in zip(seg, ex) if e > SIGNIFICANT])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(scores)), pa.array(scores, pa.float64()),
                     pa.array(passages, pa.list_(pa.string()))], names=["id", "score", "passages"])

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = d.mapInArrow(K.tidy(run), "id long, score double, passages array<string>")
    return out.select(F.col("id").alias(id_col), (id_crc("id") % modulus == held_remainder).alias("held_out"),
                      "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                      F.size("passages").cast("long").alias("n_passages"),
                      F.array_join("passages", ",").alias("passages"))
