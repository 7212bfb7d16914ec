"""Attention-shaped aggregation over blocks of vectors.

Vectors form sequences (``block``) with a position (``pos``); every pairwise
step is an equi-join inside one block, and blocks have a fixed maximum
length, so the pair count grows linearly with the data. Arithmetic is done
in double precision.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import skew_join


def dvec(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.transform(c, lambda x: x.cast("double"))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def vsum(a) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def blocks(emb: DataFrame, block_size: int = 32, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """``(block, pos, vec)`` with ``block = id div size``, ``pos = id mod size``."""
    return emb.select(F.col(id_col), F.floor(F.col(id_col) / block_size).cast("long").alias("block"),
                      F.pmod(F.col(id_col), F.lit(block_size)).cast("int").alias("pos"),
                      dvec(vec_col).alias("vec"))


def embedding_lookup(tokens: DataFrame, table: DataFrame, ids_col: str = "ids",
                     key: str = "doc_id", table_id: str = "vec_id",
                     table_vec: str = "embedding", extra=()) -> DataFrame:
    """G1: ``(key, pos, vec)``: each token id replaced by its table row; an id
    that the table lacks raises. Hot ids are dealt over tasks. ``extra`` names
    columns of the table that come along with its vector."""
    ex = tokens.select(key, F.posexplode(ids_col).alias("pos", "_id"))
    t = table.select(F.col(table_id).alias("_id"), dvec(table_vec).alias("_vec"), *extra)
    lost = F.raise_error(F.concat(F.lit("id not in the table: "), F.col("_id").cast("string")))
    return skew_join(ex, t, "_id", "left", spread=[key, "pos"]).select(
        key, "pos", F.coalesce("_vec", lost.cast("array<double>")).alias("vec"), *extra)


def add_positional(vecs: DataFrame, pos_table: DataFrame) -> DataFrame:
    """Token vector + the position vector of its position."""
    p = pos_table.select("pos", F.col("vec").alias("_pv"))
    return vecs.join(p, "pos").withColumn("vec", F.zip_with("vec", "_pv", lambda x, y: x + y)) \
        .drop("_pv")


def dot_scores(v: DataFrame, scale: bool = True, causal: bool = False,
               window: int | None = None, head_col: str | None = None) -> DataFrame:
    """``(block, q, k, score)``; scaled by 1/sqrt(d); causal keeps
    ``k <= q``; a sliding window keeps ``0 <= q - k < window``."""
    keys = ["block"] + ([head_col] if head_col else [])
    q = v.select(*keys, F.col("pos").alias("q"), F.col("vec").alias("qv"))
    k = v.select(*keys, F.col("pos").alias("k"), F.col("vec").alias("kv"))
    j = q.join(k, keys)
    if causal or window is not None:
        j = j.where(F.col("k") <= F.col("q"))
    if window is not None:
        j = j.where(F.col("q") - F.col("k") < window)
    s = dot("qv", "kv")
    if scale:
        s = s / F.sqrt(F.size("qv").cast("double"))
    return j.select(*keys, "q", "k", s.alias("score"))


def softmax_weights(scores: DataFrame, head_col: str | None = None) -> DataFrame:
    """Softmax over keys for every query (max-shifted)."""
    part = ["block"] + ([head_col] if head_col else []) + ["q"]
    w = Window.partitionBy(*part)
    z = F.exp(F.col("score") - F.max("score").over(w))
    return scores.withColumn("_z", z).withColumn("weight", F.col("_z") / F.sum("_z").over(w)) \
        .drop("_z")


def weighted_context(weights: DataFrame, v: DataFrame, head_col: str | None = None) -> DataFrame:
    """``(block, q, ctx)`` with ``ctx = sum_k weight(q,k) * v_k``.

    A block's vectors are one row (bounded by the block size), a query's weights
    another, so a vector is shuffled once and folded where they meet.
    """
    keys = ["block"] + ([head_col] if head_col else [])
    vecs = v.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("pos", "vec"))).alias("_v"))
    per_q = weights.groupBy(*keys, "q").agg(
        F.sort_array(F.collect_list(F.struct("k", "weight"))).alias("_w"))
    j = per_q.join(vecs, keys).withColumn("_w", F.filter(
        "_w", lambda w: F.map_contains_key("_v", w["k"]))).where(F.size("_w") > 0)
    zero = F.transform(F.element_at("_v", F.element_at("_w", 1)["k"]), lambda x: F.lit(0.0))
    ctx = F.aggregate("_w", zero, lambda acc, w: F.zip_with(
        acc, F.element_at("_v", w["k"]), lambda a, x: a + w["weight"] * x))
    return j.select(*keys, "q", ctx.alias("ctx"))


def attention(v: DataFrame, causal: bool = False, window: int | None = None,
              scale: bool = True) -> DataFrame:
    """G3-G7 composed: parameter-free self-attention context per position."""
    return weighted_context(softmax_weights(dot_scores(v, scale, causal, window)), v)


def split_heads(v: DataFrame, n_heads: int) -> DataFrame:
    """One row per head with the head's slice of the vector."""
    return v.select("*", F.posexplode(F.array(*[F.lit(h) for h in range(n_heads)])).alias("_i", "head")) \
        .drop("_i").withColumn("vec", F.slice("vec", F.col("head") * (F.size("vec") / n_heads) + 1,
                                              (F.size("vec") / n_heads).cast("int")))


def multi_head(v: DataFrame, n_heads: int, kv_groups: int | None = None, causal: bool = True) -> DataFrame:
    """Attention per head on vector slices, heads concatenated in order.

    With ``kv_groups`` (grouped keys/values), query head h uses key/value
    head ``h div (n_heads / kv_groups)``; otherwise every head uses its own.
    """
    hv = split_heads(v, n_heads)
    if kv_groups is None:
        kv = hv
    else:
        per = n_heads // kv_groups
        kvh = split_heads(v, n_heads).where(F.col("head") < kv_groups)
        # key/value head g is shared by query heads g*per .. g*per + per - 1
        kv = kvh.select("*", F.explode(F.sequence(F.col("head") * per, F.col("head") * per + per - 1))
                        .alias("_qh")).drop("head").withColumnRenamed("_qh", "head")
    q = hv.select("block", "head", F.col("pos").alias("q"), F.col("vec").alias("qv"))
    k = kv.select("block", "head", F.col("pos").alias("k"), F.col("vec").alias("kv"))
    j = q.join(k, ["block", "head"])
    if causal:
        j = j.where(F.col("k") <= F.col("q"))
    s = j.select("block", "head", "q", "k",
                 (dot("qv", "kv") / F.sqrt(F.size("qv").cast("double"))).alias("score"))
    w = softmax_weights(s, head_col="head")
    ctx = weighted_context(w, kv.select("block", "head", "pos", "vec"), head_col="head")
    g = ctx.groupBy("block", "q").agg(F.sort_array(F.collect_list(F.struct("head", "ctx"))).alias("_h"))
    return g.select("block", "q", F.flatten(F.transform("_h", lambda s: s["ctx"])).alias("ctx"))


def pool(v: DataFrame, how: str = "mean") -> DataFrame:
    """One vector per block: the mean over positions, or the first / last."""
    if how == "first":
        return v.groupBy("block").agg(F.min_by("vec", "pos").alias("vec"))
    if how == "last":
        return v.groupBy("block").agg(F.max_by("vec", "pos").alias("vec"))
    ex = v.select("block", F.posexplode("vec").alias("dim", "x"))
    m = ex.groupBy("block", "dim").agg(F.avg("x").alias("m"))
    g = m.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("dim", "m"))).alias("_m"))
    return g.select("block", F.transform("_m", lambda s: s["m"]).alias("vec"))


def standardize(df: DataFrame, vec: str = "vec", out: str = "z", eps: float = 1e-5) -> DataFrame:
    """``(x - mean) / sqrt(var_pop + eps)`` within each vector.

    Mean and variance are materialised as columns first so the element-wise
    lambda does not re-evaluate them per element.
    """
    n = F.size(vec).cast("double")
    d = df.withColumn("_mu", vsum(F.col(vec)) / n)
    d = d.withColumn("_var", F.aggregate(vec, F.lit(0.0),
                                         lambda acc, x: acc + (x - F.col("_mu")) * (x - F.col("_mu"))) / n)
    return d.withColumn(out, F.transform(vec, lambda x: (x - F.col("_mu")) / F.sqrt(F.col("_var") + F.lit(eps)))) \
        .drop("_mu", "_var")


def checksum(vec) -> list:
    """Rounded sum and sum of squares of a vector (for comparisons)."""
    vec = F.col(vec) if isinstance(vec, str) else vec
    return [F.round(vsum(vec), 5).alias("v_sum"),
            F.round(F.aggregate(vec, F.lit(0.0), lambda a, x: a + x * x), 5).alias("v_sq")]


