"""Quality rules as an isolation forest over rule statistics.

Every whole text gives counts (words, symbols, repeated lines and passages, ...)
from which ratios are formed; the forest isolates points by random splits of
random ratios, and a text whose mean path is short is anomalous. The forest is
fitted on ``TREES`` samples of ``SAMPLE`` documents each, as the method asks,
taken by hash from the statistics of all documents. The threshold on the score
is calibrated on all labelled documents: of the thresholds that reject at most
``MAX_GOOD_LOSS`` of the good ones, the one that rejects the most bad ones.
Ratios only, never lengths: a long document is no anomaly for being long.

Defined results: null, empty and wordless texts have no words and fail the base
rules; without labels of both kinds nothing is rejected beyond the base rules.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_table
from . import kernels as K
from .common import sample_by_hash

TREES = 128
SAMPLE = 256
BINS = 2000
MAX_GOOD_LOSS = 0.002

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct",
          "n_lines", "n_letters", "n_top_word", "n_pair_repeats"]
FEATURES = ["mean_word", "symbols", "dup_lines", "repeats", "distinct", "line_words", "letters",
            "top_word", "pair_repeats"]

_SYMBOL = K.byte_class(b"#*$%&|<>")
_LETTER = K.byte_class(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))


def _repeated(code: np.ndarray, owner: np.ndarray):
    """For every element, whether it occurs again, and whether it occurred before, in its owner."""
    order = np.lexsort((code, owner))
    c, o = code[order], owner[order]
    same = np.zeros(len(c), bool)
    same[1:] = (c[1:] == c[:-1]) & (o[1:] == o[:-1])
    multi = same.copy()
    multi[:-1] |= same[1:]
    back = np.empty(len(c), bool)
    again = np.empty(len(c), bool)
    back[order], again[order] = same, multi
    return again, back


def rule_counts(data: np.ndarray, off: np.ndarray, hasher: K.Hasher) -> np.ndarray:
    """One row of ``COUNTS`` for every document of a chunk."""
    n = len(off) - 1
    out = np.zeros((n, len(COUNTS)), np.int64)
    prefix = hasher.prefix(data)
    start, end, doc = K.words(data, off)
    h = hasher.ranges(prefix, start, end)
    inside = ~K.SPACE[data]
    out[:, 0] = np.bincount(doc, minlength=n)
    out[:, 1] = K.segment_sums(inside & K.code_points(data), off)
    out[:, 2] = K.segment_sums(_SYMBOL[data], off)
    # lines: runs without a line feed, those with a word; equal to an earlier one of the document
    ls, le = K.runs(data != 10, off)
    filled = np.concatenate([[0], np.cumsum(inside)])
    full = filled[le] > filled[ls]
    ls, le = ls[full], le[full]
    owner = np.searchsorted(off, ls, side="right") - 1
    _, earlier = _repeated(hasher.ranges(prefix, ls, le), owner)
    out[:, 3] = np.bincount(owner[earlier], minlength=n)
    # words covered by a five-word window that occurs twice or more
    code, at = K.windows(h, doc, 5)
    again, _ = _repeated(code, doc[at])
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, at[again], 1)
    np.add.at(cover, at[again] + 5, -1)
    covered = np.cumsum(cover[:-1]) > 0
    out[:, 4] = np.bincount(doc[covered], minlength=n)
    # distinct words and the commonest word
    order = np.lexsort((h, doc))
    fresh = np.ones(len(h), bool)
    ho, do = h[order], doc[order]
    fresh[1:] = (ho[1:] != ho[:-1]) | (do[1:] != do[:-1])
    out[:, 5] = np.bincount(do[fresh], minlength=n)
    out[:, 6] = np.bincount(owner, minlength=n)
    out[:, 7] = K.segment_sums(_LETTER[data] & K.code_points(data), off)
    first = np.flatnonzero(fresh)
    if len(first):
        times = np.diff(np.append(first, len(h)))
        np.maximum.at(out[:, 8], do[first], times)
    # words equal to the word before
    if len(h) > 1:
        pair = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        out[:, 9] = np.bincount(doc[1:][pair], minlength=n)
    return out


def features(counts: np.ndarray) -> np.ndarray:
    c = counts.astype(np.float64)
    words, chars, lines = (np.maximum(c[:, i], 1) for i in (0, 1, 6))
    return np.stack([c[:, 1] / words, c[:, 2] / chars, c[:, 3] / lines, c[:, 4] / words,
                     np.log(np.maximum(c[:, 5], 1)) / np.log(words + 1),
                     np.minimum(words / lines, 200.0), c[:, 7] / chars,
                     np.maximum(c[:, 8] / words - 20 / words, 0), c[:, 9] / words], axis=1)


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < 10) | (100 * counts[:, 4] > 20 * counts[:, 0])


def with_counts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id_col, *COUNTS)`` of every row."""

    def run(batches):
        hasher = K.Hasher()
        for b in batches:
            for lo, data, off in K.text_chunks(b.column(1), K.SMALL_CHUNK):
                c = rule_counts(data, off, hasher)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(off) - 1)] + [pa.array(c[:, i]) for i in range(c.shape[1])],
                    names=[id_col] + COUNTS)

    d = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("_text"))
    return d.mapInArrow(K.tidy(run), f"{id_col} long, " + ", ".join(f"{c} long" for c in COUNTS))


def grow_tree(x: np.ndarray, rng: np.random.Generator, depth: int):
    """Arrays ``(feature, value, left child, path length)``; a feature of -1 is a leaf."""
    feat, val, left, path = [], [], [], []

    def leaf_length(n):
        return 0.0 if n < 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    todo = [(x, 0)]
    at = 0
    while at < len(todo):
        rows, d = todo[at]
        lo, hi = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(0), np.zeros(0))
        able = np.flatnonzero(hi > lo)
        if d >= depth or len(rows) < 2 or not len(able):
            feat.append(-1)
            val.append(0.0)
            left.append(at)
            path.append(d + leaf_length(len(rows)))
        else:
            f = int(rng.choice(able))
            v = rng.uniform(lo[f], hi[f])
            feat.append(f)
            val.append(v)
            left.append(len(todo))
            path.append(0.0)
            todo += [(rows[rows[:, f] < v], d + 1), (rows[rows[:, f] >= v], d + 1)]
        at += 1
    return np.array(feat), np.array(val), np.array(left), np.array(path)


class Forest:
    """Isolation forest; ``score`` is near 1 for anomalies and about 0.5 or less otherwise."""

    def __init__(self, sample: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        size = min(SAMPLE, max(len(sample) // 2, 1))
        self.depth = max(1, math.ceil(math.log2(max(size, 2))))
        self.norm = max(2 * (math.log(max(size - 1, 1)) + 0.5772156649) - 2 * (size - 1) / size, 1e-9)
        self.trees = []
        for t in range(TREES):
            rows = sample[t * SAMPLE:(t + 1) * SAMPLE]
            if len(rows) < size:
                rows = sample[rng.permutation(len(sample))[:size]]
            self.trees.append(grow_tree(rows, rng, self.depth))

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feat, val, left, path in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feat[node]
                node = np.where(f < 0, node, left[node] + (x[rows, np.maximum(f, 0)] >= val[node]))
            total += path[node]
        return 2.0 ** (-total / len(self.trees) / self.norm)


def fit_forest(counts: DataFrame, id_col: str = "doc_id") -> Forest | None:
    """The forest of ``TREES`` hashed samples of the statistics (bounded by the method)."""
    rows = sample_by_hash(counts.where("n_words >= 10"), id_col, TREES * SAMPLE).select(*COUNTS) \
        .toPandas().to_numpy()
    return Forest(features(rows)) if len(rows) else None


def with_score(counts: DataFrame, forest: Forest | None) -> DataFrame:
    """Counts, ``base_failed`` and the forest's ``anomaly`` score."""
    cols = [f"`{c}` {t}" for c, t in counts.dtypes]
    shipped = counts.sparkSession.sparkContext.broadcast(forest)

    def run(batches):
        for b in batches:
            c = np.stack([b.column(n).to_numpy(zero_copy_only=False) for n in COUNTS], axis=1) \
                if b.num_rows else np.zeros((0, len(COUNTS)), np.int64)
            f = shipped.value
            s = f.score(features(c)) if f is not None else np.zeros(len(c))
            yield pa.RecordBatch.from_arrays(list(b.columns) + [pa.array(base_failed(c)), pa.array(s)],
                                             names=b.schema.names + ["base_failed", "anomaly"])

    return counts.mapInArrow(K.tidy(run), ", ".join(cols) + ", base_failed boolean, anomaly double")


def calibrate(scored: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> float:
    """The rejecting threshold, from a histogram over all labelled documents."""
    lab = labels.select(F.col("doc_id").cast("long").alias(id_col), "quality") \
        .where("quality is not null").dropDuplicates([id_col])
    # documents that the base rules reject already say nothing about the threshold
    hist = scored.where(~F.col("base_failed")).select(id_col, "anomaly").join(lab, id_col) \
        .groupBy(F.floor(F.col("anomaly") * BINS).alias("bin")) \
        .agg(F.sum((F.col("quality") == 1).cast("long")).alias("good"),
             F.sum((F.col("quality") == 0).cast("long")).alias("bad")).toPandas()
    good, bad = np.zeros(BINS + 2, np.int64), np.zeros(BINS + 2, np.int64)
    good[hist["bin"].astype(int)], bad[hist["bin"].astype(int)] = hist["good"], hist["bad"]
    if not good.sum() or not bad.sum():
        return float("inf")
    good, bad = good[::-1].cumsum()[::-1], bad[::-1].cumsum()[::-1]     # rejected at >= bin
    allowed = np.flatnonzero(good <= MAX_GOOD_LOSS * good[0])
    best = allowed[bad[allowed].argmax()]
    same = allowed[bad[allowed] == bad[best]]
    # of equally good thresholds the middle one; from the last rejected to the first kept
    return float((same[0] + same[-1]) / 2 / BINS) if bad[best] else float("inf")


class QualityModel:
    def __init__(self, forest: Forest | None, threshold: float):
        self.forest, self.threshold = forest, threshold


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text",
        id_col: str = "doc_id") -> tuple[QualityModel, DataFrame]:
    """The model and the table of scored statistics of all documents."""
    counts = write_table(with_counts(docs, text_col, id_col), "rule-counts")
    forest = fit_forest(counts, id_col)
    scored = with_score(counts, forest)
    return QualityModel(forest, calibrate(scored, labels, id_col)), scored


def score_documents(docs: DataFrame, labels: DataFrame, text_col: str = "text",
                    id_col: str = "doc_id") -> DataFrame:
    """``(id_col, *COUNTS, base_failed, anomaly, kept)``, one row per input row."""
    model, scored = fit(docs, labels, text_col, id_col)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < model.threshold))


def keep_good(docs: DataFrame, labels: DataFrame, text_col: str = "text",
              id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns.

    Statistics are taken again inside this filter, so no text is shuffled.
    """
    model, _ = fit(docs, labels, text_col, id_col)
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        hasher, m = K.Hasher(), shipped.value
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for lo, data, off in K.text_chunks(b.column(at), K.SMALL_CHUNK):
                c = rule_counts(data, off, hasher)
                ok = ~base_failed(c)
                if m.forest is not None:
                    ok &= m.forest.score(features(c)) < m.threshold
                keep[lo:lo + len(c)] = ok
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(K.tidy(run), docs.schema)
