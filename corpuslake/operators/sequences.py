"""Training sequences, splits, shuffles, batches and rank shards.

The global token stream is never materialised as one row or one task:
documents keep their ``ids`` arrays and get their stream offset from the
distributed running sum (D1). A window inside one document is cut out in place;
one that crosses a border is assembled from the slices that overlap it
(``groupBy(window)``, at most L+1 tokens per group).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..session import write_table
from .order import global_offsets, with_ordinal


def _ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + F.lit(b - 1)) / F.lit(b))


def stream_offsets(tokens: DataFrame, ids_col: str = "ids", order: str = "doc_id") -> DataFrame:
    """D1 on a token table: ``start`` of every document in the global stream.

    Only ``(order, row, length)`` is ordered; the token arrays are written once
    and joined back by their row number."""
    t = write_table(tokens.withColumn("_row", F.monotonically_increasing_id()), "token-rows")
    slim = t.select(order, "_row", F.size(ids_col).cast("long").alias("_n"))
    off = global_offsets(slim, [order, "_row"], F.greatest("_n", F.lit(0)), offset_col="start",
                         ordinal_col="doc_ord")
    return t.join(off.select("_row", "start", "doc_ord"), "_row").drop("_row")


def _span(lo: Column, hi: Column) -> Column:
    """``lo..hi``, empty when ``hi < lo`` (a plain sequence would count down)."""
    return F.when(lo <= hi, F.sequence(lo, F.greatest(lo, hi))).otherwise(F.array().cast("array<long>"))


def _windows_from_slices(docs: DataFrame, ids_col: str, n_total: Column, L: int, stride: int,
                         extra_keys=()) -> DataFrame:
    """Windows over a stream given per-document ``start`` (and a side key).

    Windows that lie in one document are cut out of its array in place; only
    those that cross a border (a few per document) are assembled by a groupBy.
    """
    s = F.col("start")
    e = F.col("start") + F.size(ids_col)
    n_win = F.greatest(_ceil_div(n_total - F.lit(L), stride), F.lit(0))
    lo = F.greatest(_ceil_div(s - F.lit(L), stride), F.lit(0))
    hi = F.least(F.floor((e - 1) / F.lit(stride)), n_win - 1)
    in_hi = F.least(F.floor((e - F.lit(L + 1)) / F.lit(stride)), n_win - 1)
    d = docs.where(F.size(ids_col) > 0).select(
        *extra_keys, ids_col, "start", lo.cast("long").alias("_lo"), hi.cast("long").alias("_hi"),
        _ceil_div(s, stride).cast("long").alias("_a"), in_hi.cast("long").alias("_b"))
    inside = d.where(F.col("_a") <= F.col("_b")).select(*extra_keys, F.explode(F.transform(
        F.sequence("_a", "_b"), lambda w: F.struct(
            w.alias("seq_id"),
            F.slice(ids_col, (w * stride - F.col("start") + 1).cast("int"), L).alias("input_ids"),
            F.slice(ids_col, (w * stride - F.col("start") + 2).cast("int"), L).alias("target_ids")))).alias("x"))
    inside = inside.select(*extra_keys, "x.seq_id", "x.input_ids", "x.target_ids")

    border = F.when(F.col("_a") <= F.col("_b"), F.concat(
        _span(F.col("_lo"), F.col("_a") - 1), _span(F.col("_b") + 1, F.col("_hi")))) \
        .otherwise(_span(F.col("_lo"), F.col("_hi")))

    def piece(w):
        a = F.greatest(F.col("start"), w * stride)
        b = F.least(F.col("start") + F.size(ids_col), w * stride + L + 1)
        p = F.slice(ids_col, F.greatest(a - F.col("start") + 1, F.lit(1)).cast("int"),
                    F.greatest(b - a, F.lit(0)).cast("int"))
        return F.struct(w.alias("seq_id"), F.struct(a.alias("a"), p.alias("p")).alias("x"))

    parts = d.select(*extra_keys, F.explode(F.transform(border, piece)).alias("y")) \
        .select(*extra_keys, "y.seq_id", "y.x")
    g = parts.groupBy(*extra_keys, "seq_id").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    flat = F.flatten(F.transform("xs", lambda x: x["p"]))
    across = g.select(*extra_keys, F.col("seq_id").cast("long"), F.slice(flat, 1, L).alias("input_ids"),
                      F.slice(flat, 2, L).alias("target_ids"))
    return inside.unionByName(across)


def sliding_windows(tokens: DataFrame, L: int, stride: int, ids_col: str = "ids",
                    order: str = "doc_id") -> DataFrame:
    """``for i in range(0, N - L, stride)`` over the concatenated stream:
    input ``[i, i+L)``, target ``[i+1, i+L+1)``; windows cross documents."""
    off = stream_offsets(tokens, ids_col, order)
    n_total = off.select(F.sum(F.size(ids_col)).cast("long")).scalar()
    return _windows_from_slices(off, ids_col, F.coalesce(n_total, F.lit(0)), L, stride)


def sliding_windows_per_group(tokens: DataFrame, L: int, stride: int, ids_col: str = "ids",
                              key: str = "doc_id") -> DataFrame:
    """D3: each document windowed on its own (only when longer than L)."""
    starts = F.when(F.size(ids_col) > L, F.sequence(F.lit(0), F.size(ids_col) - L - 1, F.lit(stride))) \
        .otherwise(F.array().cast("array<int>"))
    cut = F.transform(starts, lambda i: F.struct(F.slice(ids_col, i + 1, L).alias("input_ids"),
                                                 F.slice(ids_col, i + 2, L).alias("target_ids")))
    d = tokens.select(key, F.posexplode(cut).alias("win_idx", "x"))
    return d.select(key, F.col("win_idx").cast("long"), "x.input_ids", "x.target_ids")


def split_by_chars(df: DataFrame, ratio: float = 0.9, text_col: str = "text") -> DataFrame:
    """``idx = int(ratio * len(text))``; train = prefix, val = the rest."""
    idx = F.floor(F.lit(ratio) * F.length(text_col)).cast("int")
    return df.withColumn("train_text", F.call_function("substr", F.col(text_col), F.lit(1), idx)) \
        .withColumn("val_text", F.call_function("substr", F.col(text_col), idx + 1))


def split_by_tokens(tokens: DataFrame, ratio: float, L: int, stride: int, ids_col: str = "ids",
                    order: str = "doc_id") -> DataFrame:
    """Cut the global stream at ``int(ratio * N)``; windows on each side
    separately (a straddling document is sliced in two)."""
    off = stream_offsets(tokens, ids_col, order)
    n_total = F.coalesce(tokens.select(F.sum(F.size(ids_col)).cast("long")).scalar(), F.lit(0))
    cut = F.floor(F.lit(ratio) * n_total).cast("long")
    e = F.col("start") + F.size(ids_col)
    train = off.where(F.col("start") < cut).select(
        F.lit("train").alias("split"),
        F.slice(ids_col, 1, F.greatest(F.least(e, cut) - F.col("start"), F.lit(0)).cast("int"))
        .alias(ids_col),
        F.col("start"))
    val = off.where(e > cut).select(
        F.lit("val").alias("split"),
        F.slice(ids_col, (F.greatest(cut - F.col("start"), F.lit(0)) + 1).cast("int"),
                F.greatest(e - F.greatest(F.col("start"), cut), F.lit(0)).cast("int")).alias(ids_col),
        (F.greatest(F.col("start"), cut) - cut).alias("start"))
    tw = _windows_from_slices(train, ids_col, cut, L, stride, ["split"])
    vw = _windows_from_slices(val, ids_col, n_total - cut, L, stride, ["split"])
    return tw.unionByName(vw)


def split_rows(df: DataFrame, ratios=(0.85, 0.1), names=("train", "test", "val"),
               order: str = "doc_id") -> DataFrame:
    """Positional head / middle / rest with ``int()`` truncation each."""
    d = with_ordinal(df, order, name="_ord")
    n = df.select(F.count(F.lit(1))).scalar()
    bounds = []
    acc = F.lit(0)
    for r in ratios:
        acc = acc + F.floor(F.lit(r) * n)
        bounds.append(acc)
    split = F.lit(names[len(ratios)])
    for b, name in reversed(list(zip(bounds, names))):
        split = F.when(F.col("_ord") < b, F.lit(name)).otherwise(split)
    return d.withColumn("split", split).drop("_ord")


def shuffle_epoch(df: DataFrame, seed: int, epoch: int, key: str = "seq_id") -> DataFrame:
    """Reproducible reshuffle per epoch: order by a hash of (key, seed+epoch)."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.col(key).cast("string"),
                                             F.lit(str(seed + epoch)))), 1, 15), 16, 10).cast("long")
    d = df.withColumn("_h", h)
    d = with_ordinal(d, ["_h", key], name="position")
    return d.drop("_h").withColumn("epoch", F.lit(epoch))


def batch(df: DataFrame, B: int, drop_last: bool = False, position: str = "position") -> DataFrame:
    """``batch_id = position div B``; ``drop_last`` removes a partial batch."""
    d = df.withColumn("batch_id", F.floor(F.col(position) / F.lit(B)).cast("long"))
    if drop_last:
        n = df.select(F.count(F.lit(1))).scalar()
        d = d.where(F.col(position) < F.floor(n / F.lit(B)) * B)
    return d


def shard_ranks(df: DataFrame, W: int, drop_last: bool = False, position: str = "position") -> DataFrame:
    """Rank r takes positions ``== r (mod W)``. Without ``drop_last`` the
    first ``W*ceil(n/W) - n`` rows are appended again to fill the last round;
    with it the tail beyond a multiple of W is dropped."""
    n = df.select(F.count(F.lit(1))).scalar()
    if drop_last:
        d = df.where(F.col(position) < F.floor(n / F.lit(W)) * W)
    else:
        pad = _ceil_div(n, W) * W - n
        extra = df.where(F.col(position) < pad).withColumn(position, F.col(position) + n)
        d = df.unionByName(extra)
    return d.withColumn("rank", F.pmod(F.col(position), F.lit(W)).cast("int")) \
        .withColumn("local_idx", F.floor(F.col(position) / F.lit(W)).cast("long"))


def pad_truncate(ids: Column, L: int, pad: int = fixed.PAD_ID) -> Column:
    """Truncate to L, right-pad with ``pad`` to L."""
    t = F.slice(ids, 1, L)
    return F.concat(t, F.array_repeat(F.lit(pad), F.greatest(F.lit(L) - F.size(t), F.lit(0))))


def longest_encoded_length(df: DataFrame, ids_col: str = "ids") -> DataFrame:
    """The longest token count."""
    return df.agg(F.max(F.size(ids_col)).cast("long").alias("max_length"))


def context_length(df: DataFrame, option: str, model_length: int, ids_col: str = "ids") -> DataFrame:
    """One row ``(context_length)``: the model's own length for
    ``model_context_length``, that of the longest row for ``longest_training_example``,
    or the number that ``option`` spells; ValueError for anything else."""
    if option == "longest_training_example":
        return longest_encoded_length(df, ids_col).withColumnRenamed("max_length", "context_length")
    try:
        n = int(model_length if option == "model_context_length" else option)
    except ValueError:
        raise ValueError(f"context length {option!r} is no option and no number") from None
    return df.sparkSession.range(1).select(F.lit(n).cast("long").alias("context_length"))


def context_pairs(df: DataFrame, k: int, ids_col: str = "ids", key: str = "doc_id") -> DataFrame:
    """Prefixes of length 1..k and the token that follows each."""
    m = F.least(F.lit(k), F.size(ids_col) - 1)
    d = df.where(F.size(ids_col) >= 2).select(key, ids_col, F.explode(F.sequence(F.lit(1), m)).alias("i"))
    return d.select(key, F.col("i").cast("long").alias("context_len"),
                    F.slice(ids_col, 1, F.col("i")).alias("context"),
                    F.element_at(ids_col, F.col("i") + 1).alias("next_id"))


def split_token_counts(seqs: DataFrame, B: int, L: int, total_tokens, ratio: float = 0.9,
                       drop_last: bool = True) -> DataFrame:
    """Sequences, batches and tokens of both splits, also of one without a sequence.

    ``too_small`` warns where the split's share of ``total_tokens`` (a number or a
    column; ``ratio`` of it for train, the rest for val) is below one context of ``L``.
    """
    spark = seqs.sparkSession
    shares = spark.createDataFrame([("train", float(ratio)), ("val", 1 - float(ratio))], "split string, _share double")
    g = seqs.groupBy("split").agg(F.count(F.lit(1)).cast("long").alias("n_seqs"),
                                  F.sum(F.size("input_ids")).cast("long").alias("n_tokens"))
    g = shares.join(g, "split", "left").fillna(0, ["n_seqs", "n_tokens"])
    nb = F.floor(F.col("n_seqs") / B) if drop_last else _ceil_div(F.col("n_seqs"), B)
    total = total_tokens if isinstance(total_tokens, Column) else F.lit(total_tokens)
    return g.select("split", "n_seqs", nb.cast("long").alias("n_batches"), "n_tokens",
                    (F.coalesce(total, F.lit(0)) * F.col("_share") < L).alias("too_small"))
