"""Packing, de-duplication, filtering, sampling and augmentation."""

from __future__ import annotations

import math
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..functions import set_kernels as SK
from ..functions.text import join_ordered
from ..session import write_table
from .linkage import banding, candidate_groups, connected_components, verified_components  # noqa: F401
from .order import global_offsets, with_ordinal
from .skew import skew_join


# ---------------------------------------------------------------- B6 / B5 shards

def assign_shards(df: DataFrame, text_col: str = "text", max_bytes: int = 100_000_000,
                  order: str = "doc_id") -> DataFrame:
    """B6 (prefix mode): ``shard_id = floor(exclusive_prefix_bytes / max) + 1``.

    Fully distributed (D1 running sum); a shard holds at most ``max_bytes``
    plus one document. Adds ``n_bytes`` and ``shard_id``.
    """
    d = df.select(order, F.octet_length(text_col).cast("long").alias("n_bytes"))
    d = global_offsets(d, order, "n_bytes", offset_col="_off", ordinal_col="_ord")
    return _with_shards(df, d.withColumn(
        "shard_id", (F.floor(F.col("_off") / F.lit(max_bytes)) + 1).cast("long")), order)


def _with_shards(df: DataFrame, sized: DataFrame, order: str) -> DataFrame:
    """Shard numbers brought to the wide rows: one join, the only time texts move.
    Rows sharing an ``order`` value go to the first one's shard."""
    s = sized.groupBy(order).agg(F.min("shard_id").alias("shard_id"), F.min("n_bytes").alias("n_bytes"))
    return df.drop("shard_id", "n_bytes").join(s, order)


def next_fit_shards(df: DataFrame, text_col: str = "text", max_bytes: int = 100_000_000,
                    order: str = "doc_id") -> DataFrame:
    """B6 exact: the sequential next-fit of the reference, distributed.

    Walking documents in order, a document opens a new shard when the open
    shard's bytes plus its own exceed ``max_bytes``; an oversize first
    document first flushes an empty shard 1. Adds ``n_bytes`` and
    ``shard_id``.

    With P the exclusive and E = P + size the inclusive byte prefix, the shard
    opened at document i is followed by the one opened at
    ``next(i) = max(i + 1, #{j : E_j <= P_i + max_bytes})``: a rank of query
    values among data values, i.e. one running count over their union (D1).
    The shard starts are the path from document 0 under ``next``; pointer
    doubling lists it in about log2(#shards) rounds of joins
    (starts_{k+1} = starts_k + next^(2^k)(starts_k)), each round written to
    the shared checkpoint folder. No step holds more than one range bucket.
    """
    d = df.select(order, F.octet_length(text_col).cast("long").alias("n_bytes"))
    d = write_table(global_offsets(d, order, "n_bytes", offset_col="_p", ordinal_col="_o"),
                    "nf-docs")
    n = d.count()
    data = d.select((F.col("_p") + F.col("n_bytes")).alias("_v"), F.lit(0).alias("_t"),
                    F.col("_o").alias("_id"), F.lit(1).alias("_w"))
    qry = d.select((F.col("_p") + F.lit(max_bytes)).alias("_v"), F.lit(1).alias("_t"),
                   F.col("_o").alias("_id"), F.lit(0).alias("_w"))
    ranked = global_offsets(data.unionByName(qry), ["_v", "_t", "_id"], "_w",
                            offset_col="_le", ordinal_col="_r")
    jump = write_table(ranked.where(F.col("_t") == 1).select(
        F.col("_id").alias("node"),
        F.least(F.greatest(F.col("_id") + 1, F.col("_le")), F.lit(n)).alias("to")), "nf-jump")
    spark = df.sparkSession
    starts = spark.range(1 if n else 0).select(F.col("id").alias("node"))
    while True:
        new = write_table(starts.join(jump, "node").select(F.col("to").alias("node"))
                          .where(F.col("node") < n), "nf-new")
        if new.isEmpty():
            break
        starts = write_table(starts.unionByName(new), "nf-starts")
        # a jump that ends at or beyond a finished one is never taken again
        a, b = jump.where(F.col("to") < n).alias("a"), jump.alias("b")
        jump = write_table(a.join(b, F.col("a.to") == F.col("b.node")).select(
            F.col("a.node").alias("node"), F.col("b.to").alias("to")), "nf-jump")
    empty_first = d.where(F.col("_o") == 0).select(
        (F.col("n_bytes") > max_bytes).cast("long").alias("e"))
    flag = d.join(starts.select(F.col("node").alias("_o"), F.lit(1).alias("_s")), "_o", "left") \
        .withColumn("_s", F.coalesce("_s", F.lit(0)))
    out = global_offsets(flag, "_o", "_s", offset_col="_before", ordinal_col="_x")
    return _with_shards(df, out.withColumn(
        "shard_id", (F.col("_before") + F.col("_s")
                     + F.coalesce(empty_first.scalar(), F.lit(0))).cast("long")), order)


def shard_texts(df: DataFrame, text_col: str = "text", order: str = "doc_id",
                sep: str = fixed.ENDOFTEXT) -> DataFrame:
    """B5 grouped form: one text per shard, documents in order joined by ``sep``.

    Groups are shards, so each is bounded by the shard size.
    """
    return df.groupBy("shard_id").agg(
        F.count(F.lit(1)).cast("long").alias("n_docs"),
        join_ordered(F.struct(F.col(order).alias("o"), F.col(text_col).alias("text")), sep)
        .alias("text"))


# ---------------------------------------------------------------- B8 exact dedup

def exact_dedup(df: DataFrame, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """Keep the lowest key per identical text. Only (hash, key) is shuffled.

    Rows without a text are no copies of each other and stay, as do rows without a key,
    which cannot be told apart by it. Rows that share a key stay where it is the lowest
    of their own text.
    """
    t = df.withColumn("_h", F.sha2(F.col(text_col), 256))
    known = F.col("_h").isNotNull() & F.col(key).isNotNull()
    keep = t.where(known).groupBy("_h").agg(F.min(key).alias(key))
    kept = t.where(known).join(keep, [key, "_h"], "left_semi").select(*df.columns)
    return kept.unionByName(df.where(F.col(text_col).isNull() | F.col(key).isNull()))


# ---------------------------------------------------------------- B10-B12 filters

def length_filter(df: DataFrame, ids_col: str = "ids", lo: int = 10, hi: int = 2048) -> DataFrame:
    return df.where(F.size(ids_col).between(lo, hi))


def toxicity_filter(df: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Drop documents flagged toxic; unlabelled ones are kept."""
    return df.join(labels.where(F.col("toxic") == 1).select(key), key, "left_anti")


def quality_filter(df: DataFrame, labels: DataFrame | None = None, key: str = "doc_id",
                   score_col: str | None = None, threshold: float = 0.5) -> DataFrame:
    """Keep quality=1 documents (label join) or rows with ``score >= threshold``."""
    if labels is not None:
        return df.join(labels.where(F.col("quality") == 1).select(key), key, "left_semi")
    return df.where(F.col(score_col) >= threshold)


# ---------------------------------------------------------------- B14 mixture

def md5_long(*cols, seed=0) -> Column:
    """Deterministic pseudo-random integer in [0, 2**60) from an md5 of the key."""
    s = F.concat_ws(":", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                           for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("long")


def mixture_sample(df: DataFrame, class_col: str, weights: dict, seed: int = 0,
                   key: str = "doc_id") -> DataFrame:
    """Sample classes in the proportions ``weights`` keeping as many rows as
    feasible: total = min(n_c / w_c); keep a row of class c iff its hash
    falls below ``w_c * total / n_c``. No sort, no driver round trip."""
    spark = df.sparkSession
    w = spark.createDataFrame([(k, float(v)) for k, v in weights.items() if v > 0],
                              f"{class_col} string, weight double")
    counts = df.groupBy(class_col).agg(F.count(F.lit(1)).alias("n")).join(w, class_col)
    total = counts.select(F.min(F.col("n") / F.col("weight"))).scalar()
    frac = counts.select(class_col, (F.least(F.lit(1.0), F.col("weight") * total / F.col("n"))
                                     * float(1 << 60)).alias("_cut"))
    return df.join(F.broadcast(frac), class_col) \
        .where(md5_long(key, seed=seed).cast("double") < F.col("_cut")).drop("_cut")


# ---------------------------------------------------------------- B15 sentences

def sentence_pieces(c) -> Column:
    """Pieces after ``.``, ``!`` or ``?`` followed by whitespace (the
    whitespace dropped, the punctuation kept with its sentence)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.split(c, "(?<=[.!?])" + fixed.WS + "+")


def split_sentences(df: DataFrame, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per sentence, with its position in the document."""
    return df.select(key, F.posexplode(sentence_pieces(text_col)).alias("sent_idx", "sentence")) \
        .where(F.length("sentence") > 0)


# ---------------------------------------------------------------- B7 unicode

@F.arrow_udf(T.StringType())
def _nfc(s: pa.Array) -> pa.Array:
    # Arrow's own utf8_normalize leaves decomposed characters as they are
    return pa.array([x if x is None else unicodedata.normalize("NFC", x) for x in s.to_pylist()], pa.string())


def normalize_unicode(c: Column) -> Column:
    """NFC normalization; ASCII rows (tested in the JVM) pass as they are."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), _nfc(F.when(c.rlike(r"[^\x00-\x7F]"), c))).otherwise(c)


# ---------------------------------------------------------------- B17 augment

def augment_word_delete(df: DataFrame, text_col: str = "text", key: str = "doc_id",
                        p: float = 0.1, seed: int = 0) -> DataFrame:
    """Delete each whitespace-separated word with probability ``p``, keyed by
    a hash of (key, position, seed) so the result is reproducible."""
    words = F.split(F.col(text_col), fixed.WS + "+")
    kept = F.filter(words, lambda w, i: (F.length(w) > 0) & (
        md5_long(F.col(key), i, seed=seed) >= int(p * (1 << 60))))
    return df.withColumn(text_col, F.array_join(kept, " "))


def augment_sentence_shuffle(df: DataFrame, text_col: str = "text", key: str = "doc_id",
                             seed: int = 0) -> DataFrame:
    """Reorder sentences by a hash of (key, position, seed)."""
    sents = F.filter(sentence_pieces(text_col), lambda x: F.length(x) > 0)
    keyed = F.transform(sents, lambda s, i: F.struct(
        md5_long(F.col(key), i, seed=seed).alias("h"), s.alias("s")))
    return df.withColumn(text_col, F.array_join(F.transform(F.array_sort(keyed), lambda x: x["s"]), " "))


# ---------------------------------------------------------------- B13 perplexity

def perplexity_filter(df: DataFrame, scores: DataFrame, key: str = "doc_id",
                      lo: float | None = None, hi: float | None = None,
                      q_lo: float | None = None, q_hi: float | None = None,
                      score_col: str = "perplexity") -> DataFrame:
    """Keep documents whose perplexity lies in ``[lo, hi]``; bounds may
    instead be quantiles of the scores: the score of rank ``floor(q * (n - 1))``,
    exact (D1 ranks, two rows to the driver). Unscored documents are dropped."""
    s = scores.select(key, score_col)
    if q_lo is not None or q_hi is not None:
        ranked = with_ordinal(s, [score_col, key], name="_rank")
        n = ranked.count()
        at = {q: math.floor(q * (n - 1)) for q in (q_lo, q_hi) if q is not None}
        got = {r["_rank"]: r[score_col] for r in
               ranked.where(F.col("_rank").isin(list(at.values()))).collect()}
        lo = got.get(at[q_lo], 0.0) if q_lo is not None else lo
        hi = got.get(at[q_hi], 0.0) if q_hi is not None else hi
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(score_col) >= lo)
    if hi is not None:
        cond = cond & (F.col(score_col) <= hi)
    return df.join(s.where(cond), key, "left_semi")


# ---------------------------------------------------------------- B9 near dup

def _words_of(c) -> Column:
    return F.filter(F.split(F.lower(F.col(c)), fixed.WS + "+"), lambda w: F.length(w) > 0)


def _one_blank(c: str) -> Column:
    """The lower-cased words of a text, one blank apart."""
    return F.array_join(_words_of(c), " ")


def minhash_signatures(df: DataFrame, text_col: str = "text", key: str = "doc_id", k: int = 5,
                       bands: int = 32, rows: int = 4) -> DataFrame:
    """``(key, fp, bands, sig)``: the identity of every text's set of word ``k``-shingles
    (null for an empty one), its band keys and its signature as 16-bit values.

    Signatures are one-permutation min-hashes: one hash per shingle, whatever their length.
    """
    m = bands * rows

    def run(it):
        for rb in it:
            for lo, data, at in SK.pieces(rb.column(1)):
                code, bounds = SK.shingle_sets(data, at, k)
                sig = SK.one_permutation(code, bounds, m)
                n = len(at) - 1
                keys = SK.band_keys(sig, bands, rows).astype(np.int64)
                short = SK.mixed(sig, 11).astype(np.uint16)
                yield pa.RecordBatch.from_arrays([
                    rb.column(0).slice(lo, n), pa.array(SK.identities(code, bounds), pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(keys.ravel())),
                    pa.array([x.tobytes() for x in short], pa.binary())], names=[key, "fp", "bands", "sig"])

    return df.select(F.col(key).cast("long").alias(key), _one_blank(text_col).alias("text")) \
        .mapInArrow(run, f"`{key}` long, fp binary, bands array<long>, sig binary")


def shingle_sets(df: DataFrame, text_col: str, k: int) -> DataFrame:
    """The text column replaced by ``codes``, its distinct shingles as 64-bit values."""
    keep = [c for c in df.columns if c != text_col]

    def run(it):
        for rb in it:
            for lo, data, at in SK.pieces(rb.column(len(keep))):
                code, bounds = SK.shingle_sets(data, at, k)
                yield pa.RecordBatch.from_arrays(
                    [rb.column(i).slice(lo, len(at) - 1) for i in range(len(keep))]
                    + [pa.array([code[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())],
                    names=[*keep, "codes"])

    types = T.StructType([df.schema[c] for c in keep] + [T.StructField("codes", T.BinaryType())])
    return df.select(*keep, _one_blank(text_col).alias(text_col)).mapInArrow(run, types)


def near_dup_minhash(df: DataFrame, text_col: str = "text", key: str = "doc_id",
                     k: int = 5, bands: int | None = None, rows: int | None = None,
                     threshold: float = 0.8, bucket: int = 1024, block_rows: int = 512,
                     block_items: int = 1 << 21) -> DataFrame:
    """MinHash-LSH near-duplicate groups; ``(key, component, keep)``.

    Equal shingle sets are one candidate. Candidates of a band bucket whose
    signatures agree enough form groups; inside a group every link is decided by
    the exact Jaccard of the whole shingle sets (:mod:`linkage`), so within LSH's
    candidates no link is lost and none is guessed. Without ``bands`` and ``rows``
    the banding is that of :func:`linkage.banding`: a link at the threshold shares
    no band in fewer than one case in a million (4.7e-8 at 0.8), above it more
    rarely. ``component`` is the smallest key of the class, ``keep`` marks it; a
    document without links is its own component, and so is every null, empty or wordless
    text, whose set is empty. Keys are integers and identify rows.
    """
    if bands is None or rows is None:
        bands, rows = banding(threshold)
    m = bands * rows
    d = df.select(F.col(key).cast("long").alias("id"), text_col)
    sig = write_table(minhash_signatures(d, text_col, "id", k, bands, rows), "minhash")
    reps = write_table(sig.where("fp is not null").groupBy("fp").agg(F.min("id").alias("rep")), "set-reps")
    own = sig.join(reps.select(F.col("rep").alias("id")), "id").select(F.col("id").alias("rep"), "bands", "sig")
    cells = own.select("rep", F.posexplode("bands").alias("band", "h")).select("rep", F.xxhash64("band", "h").alias("key"))
    agree = math.floor(m * max(threshold - 5 * math.sqrt(threshold * (1 - threshold) / m), 0))
    groups = candidate_groups(cells, own.select("rep", "sig"), agree, m, bucket)
    sets = shingle_sets(d.join(groups, "id").select("id", "grp", text_col), text_col, k)
    labels = verified_components(write_table(sets, "shingles"), round(100 * threshold), block_rows, block_items)
    head = reps.join(labels.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("fp", F.coalesce("label", "rep").alias("component"))
    out = skew_join(sig.select("id", "fp"), head, "fp", "left", spread=["id"])
    component = F.coalesce("component", "id")
    return out.select(F.col("id").cast(df.schema[key].dataType).alias(key), component.alias("component"),
                      (F.col("id") == component).alias("keep"))
