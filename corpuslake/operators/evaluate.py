"""Count-based baselines, scoring and evaluation as Spark jobs."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..functions.text import word_split
from ..session import cut_lineage, scratch_path, write_table
from .order import global_offsets, partitioned_offsets, with_ordinal
from .skew import heavy_hitters, skew_join
from .words import mapped_lists

TERM_PATTERN = "[" + fixed.WORD_CHARS + "]{2,}"     # runs of >= 2 word characters


# ---------------------------------------------------------------- E1 / E2 features

def terms(c) -> Column:
    """Lower-cased runs of two or more word characters (the default
    bag-of-words tokenization)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.lower(c), F.lit(TERM_PATTERN), F.lit(0))


def bag_of_words(df: DataFrame, train: DataFrame, text_col: str = "text",
                 key: str = "doc_id") -> DataFrame:
    """E1 (long form): ``(key, term, n)``, vocabulary fitted on ``train`` only."""
    vocab = train.select(F.explode(terms(text_col)).alias("term")).distinct()
    counts = df.select(key, F.explode(terms(text_col)).alias("term")) \
        .groupBy(key, "term").agg(F.count(F.lit(1)).cast("long").alias("n"))
    return counts.join(vocab, "term", "left_semi")


def tfidf(df: DataFrame, train: DataFrame, text_col: str = "text", key: str = "doc_id",
          max_features: int = 50_000, stop_words=None) -> DataFrame:
    """``(key, term, tfidf)`` with idf = ln((1+N)/(1+df)) + 1 from
    train, vocabulary = the ``max_features`` most frequent train terms
    (ties by term), rows L2-normalised."""
    def toks(d):
        t = d.select(key, F.explode(terms(text_col)).alias("term"))
        if stop_words:
            t = t.where(~F.col("term").isin(list(stop_words)))
        return t
    tt = toks(train)
    n_docs = train.select(F.count(F.lit(1))).scalar()
    stats = tt.groupBy("term").agg(F.count(F.lit(1)).alias("tf_all"),
                                   F.count_distinct(key).alias("df"))
    top = _top_terms(stats, max_features)
    idf = top.select("term", (F.log((F.lit(1) + n_docs) / (F.lit(1) + F.col("df"))) + 1).alias("idf"))
    c = toks(df).groupBy(key, "term").agg(F.count(F.lit(1)).alias("n")).join(idf, "term")
    w = c.withColumn("_w", F.col("n") * F.col("idf"))
    norm = w.groupBy(key).agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm"))
    return w.join(norm, key).select(key, "term", (F.col("_w") / F.col("_norm")).alias("tfidf"))


def _top_terms(stats: DataFrame, k: int) -> DataFrame:
    """The k most frequent terms: rank computed with the distributed
    ordinal (no single-task window)."""
    ranked = global_offsets(stats.withColumn("_neg", -F.col("tf_all")), ["_neg", "term"],
                            ordinal_col="_r")
    return ranked.where(F.col("_r") < k).drop("_neg", "_r")


# ---------------------------------------------------------------- E3 majority

def majority_baseline(df: DataFrame, label: str = "label", split: str = "split",
                      train_name: str = "train") -> DataFrame:
    """Predict the most frequent train label (ties: smallest);
    ``(split, majority_label, accuracy, n)``."""
    counts = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    maj = counts.where(F.col(split) == train_name).select(
        F.min_by(label, F.struct(-F.col("n"), F.col(label)))).scalar()
    return counts.groupBy(split).agg(
        F.first(maj).alias("majority_label"),
        (F.sum(F.when(F.col(label) == maj, F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"),
        F.sum("n").cast("long").alias("n"))


# ---------------------------------------------------------------- E4 logistic regression

def logreg(df: DataFrame, text_col: str = "text", label: str = "label", split: str = "split",
           C: float = 1.0, max_iter: int = 1000, train_name: str = "train", tol: float = 1e-5):
    """Bag-of-words + L2 logistic regression (sklearn C mapped to Spark's
    regParam = 1 / (C n)); returns (model, predictions with ``pred``)."""
    f = term_vectors(df, text_col, split=split, train_name=train_name)
    return fit_logreg(f, f.where(F.col(split) == train_name), label, C, max_iter, tol)


def term_vectors(df: DataFrame, text_col: str = "text", key: str = "doc_id", split: str = "split",
                 train_name: str = "train") -> DataFrame:
    """``df`` without its text, with ``features``: sparse counts over *all* train
    terms (ids by the distributed ordinal; no cap, nothing at the driver).

    Terms found in one row's key alone have parallel columns, which a ridge penalty
    weighs in proportion to their counts: they share one column of that row, the
    length of their counts. The fit and its scores are those of a column each, and
    the model is as long as the terms of two rows or more and the rows.

    Built and written once; every fit and every L-BFGS iteration reads that
    table. The vectors are written as their plain struct and read back under
    the vector type, so no row passes through Python.
    """
    from pyspark.ml.linalg import VectorUDT

    spark = df.sparkSession
    in_train = F.coalesce(F.col(split) == train_name, F.lit(False))
    counts = write_table(
        df.select(key, in_train.alias("_in"), F.explode(terms(text_col)).alias("term")).groupBy(key, "term")
        .agg(F.count(F.lit(1)).cast("double").alias("_c"), F.max("_in").alias("_in")), "term-counts")
    seen = write_table(counts.groupBy("term").agg(F.max("_in").alias("_in"), F.count(F.lit(1)).alias("_rows"))
                       .where("_in"), "train-terms").drop("_in")
    vocab = write_table(with_ordinal(seen.where("_rows > 1").select("term"), "term", name="_i")
                        .select("term", F.col("_i").cast("int")), "term-ids")
    n_terms = vocab.select(F.count(F.lit(1))).scalar().cast("int")
    found = counts.join(seen, "term").join(vocab, "term", "left")
    vec = write_table(found.groupBy(key).agg(
        F.sort_array(F.collect_list(F.when(F.col("_i").isNotNull(), F.struct("_i", "_c")))).alias("_v"),
        F.sqrt(F.sum(F.when(F.col("_i").isNull(), F.col("_c") * F.col("_c")))).alias("_own")), "term-lists")
    own = write_table(with_ordinal(vec.where(F.col("_own").isNotNull()).select(key), key, name="_at"), "own-columns")
    size = F.greatest(n_terms + own.select(F.count(F.lit(1))).scalar().cast("int"), F.lit(1))
    vec = vec.join(own.withColumn("_at", (n_terms + F.col("_at")).cast("int")), key, "left")
    rest = [c for c in df.columns if c != text_col]
    none = F.array().cast(vec.schema["_v"].dataType)
    last = F.when(F.col("_at").isNotNull(), F.array(F.struct(F.col("_at").alias("_i"), F.col("_own").alias("_c"))))
    items = F.concat(F.coalesce("_v", none), F.coalesce(last, none))
    flat = df.select(*rest).join(vec, key, "left").select(*rest, F.struct(
        F.lit(0).cast("tinyint").alias("type"), size.alias("size"),
        F.transform(items, lambda x: x["_i"]).alias("indices"),
        F.transform(items, lambda x: x["_c"]).alias("values")).alias("features"))
    path = scratch_path(spark, "term-vectors")
    cores = max(spark.sparkContext.defaultParallelism, 1)
    flat.repartition(cores, key).write.parquet(path)
    schema = T.StructType([f for f in flat.schema.fields if f.name != "features"]
                          + [T.StructField("features", VectorUDT())])
    return spark.read.schema(schema).parquet(path)


def fit_logreg(data: DataFrame, train: DataFrame, label: str = "label", C: float = 1.0,
               max_iter: int = 1000, tol: float = 1e-5):
    """Logistic regression on :func:`term_vectors` rows; (model, ``data`` with ``pred``).

    ``tol`` is the relative fall of the loss at which L-BFGS stops, every step
    of which is a job; 1e-5 ends within a thousandth of the least loss."""
    from pyspark.ml.classification import LogisticRegression

    n = train.count()
    lr = LogisticRegression(featuresCol="features", labelCol="_y", regParam=1.0 / (C * max(n, 1)),
                            elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=tol)
    model = lr.fit(train.withColumn("_y", F.col(label).cast("double")))
    pred = _predictions(data, model)
    return model, pred


def _predictions(data: DataFrame, model) -> DataFrame:
    """``data`` with the model's class as ``pred`` in place of its features.

    Only the weights go to the tasks; the model itself would take its summary along."""
    rest = [c for c in data.columns if c != "features"]
    names = rest + ["pred"]
    weights, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    sent = data.sparkSession.sparkContext.broadcast((weights, bias))

    def run(batches):
        weights, bias = sent.value
        for b in batches:
            idx, val = b.column(len(rest)), b.column(len(rest) + 1)
            row = np.repeat(np.arange(b.num_rows), pc.list_value_length(idx).to_numpy(zero_copy_only=False))
            at, x = idx.flatten().to_numpy(zero_copy_only=False), val.flatten().to_numpy(zero_copy_only=False)
            raw = np.array([np.bincount(row, w[at] * x, b.num_rows) + c for w, c in zip(weights, bias)])
            with np.errstate(over="ignore"):
                pred = 1 / (1 + np.exp(-raw[0])) > 0.5 if len(raw) == 1 else raw.argmax(0)
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(len(rest))] + [pa.array(pred.astype(np.int32))], names=names)

    f = F.unwrap_udt("features")
    schema = T.StructType([data.schema[c] for c in rest] + [T.StructField("pred", T.IntegerType())])
    return data.select(*rest, f["indices"].alias("_i"), f["values"].alias("_x")).mapInArrow(run, schema)


# ---------------------------------------------------------------- E5-E7, E16 metrics

def accuracy(pred: DataFrame, pred_col: str = "pred", label: str = "label", by=None,
             first_k_batches: int | None = None, batch_col: str = "batch_id") -> DataFrame:
    """E5: correct / total, optionally per group and over the first k batches."""
    d = pred if first_k_batches is None else pred.where(F.col(batch_col) < first_k_batches)
    by = [by] if isinstance(by, str) else list(by or [])
    return d.groupBy(*by).agg(
        F.avg((F.col(pred_col) == F.col(label)).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).cast("long").alias("n"))


def classification_report(pred: DataFrame, pred_col: str = "pred", label: str = "label") -> DataFrame:
    """Per class precision, recall, F1, support and the confusion counts."""
    cm = pred.groupBy(F.col(label).alias("y"), F.col(pred_col).alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    classes = cm.select(F.col("y").alias("cls")).union(cm.select(F.col("p").alias("cls"))).distinct()
    tp = cm.where(F.col("y") == F.col("p")).select(F.col("y").alias("cls"), F.col("n").alias("tp"))
    sup = cm.groupBy(F.col("y").alias("cls")).agg(F.sum("n").alias("support"))
    prd = cm.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("predicted"))
    r = classes.join(tp, "cls", "left").join(sup, "cls", "left").join(prd, "cls", "left").fillna(0)
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    return r.select("cls", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"),
                    F.col("support").cast("long"), F.col("tp").cast("long"),
                    F.col("predicted").cast("long"))


def confusion_matrix(pred: DataFrame, pred_col: str = "pred", label: str = "label") -> DataFrame:
    return pred.groupBy(F.col(label).alias("label"), F.col(pred_col).alias("pred")) \
        .agg(F.count(F.lit(1)).cast("long").alias("n"))


def auc_roc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Rank-form AUC, ties counted one half. Per distinct score: positives
    and negatives; negatives below each score from the distributed running
    sum (D1) over distinct scores."""
    per = df.groupBy(score).agg(F.sum(F.col(label).cast("long")).alias("pos"),
                                F.sum((1 - F.col(label)).cast("long")).alias("neg"))
    cum = global_offsets(per, score, "neg", offset_col="neg_below", ordinal_col="_o")
    return cum.agg((F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg")))
                    / (F.sum("pos") * F.sum("neg"))).alias("auc"))


def cohens_kappa(df: DataFrame, a: str, b: str) -> DataFrame:
    """(p_o - p_e) / (1 - p_e) from the contingency table."""
    cont = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    pa_ = cont.groupBy(F.col("a").alias("c")).agg(F.sum("n").alias("na"))
    pb_ = cont.groupBy(F.col("b").alias("c")).agg(F.sum("n").alias("nb"))
    total = cont.select(F.sum("n")).scalar()
    po = cont.where(F.col("a") == F.col("b")).select((F.sum("n") / total).alias("po"))
    pe = pa_.join(pb_, "c").select((F.sum(F.col("na") * F.col("nb")) / (total * total)).alias("pe"))
    return po.unionByName(pe, allowMissingColumns=True).agg(
        F.max("po").alias("po"), F.max("pe").alias("pe")).select(
        "po", "pe", ((F.col("po") - F.col("pe")) / (1 - F.col("pe"))).alias("kappa"))


# ---------------------------------------------------------------- E9 n-gram LM

def bigrams(df: DataFrame, tokens_col: str = "tokens", key: str = "doc_id") -> DataFrame:
    """``(key, pos, prev, next)`` for consecutive tokens."""
    t = F.col(tokens_col)
    n = F.greatest(F.size(t) - 1, F.lit(0))
    # slices side by side, not a lambda for every token; an outer explode, as a plain one
    # makes its array once more to see whether it is empty
    pairs = F.arrays_zip(F.slice(t, 1, n).alias("prev"), F.slice(t, 2, n).alias("next"))
    return df.where(F.size(t) >= 2).select(key, F.posexplode_outer(pairs).alias("pos", "b")) \
        .select(key, (F.col("pos") + 1).alias("pos"), F.col("b.prev"), F.col("b.next"))


def ngram_lm_fit(train: DataFrame, tokens_col: str = "tokens", key: str = "doc_id",
                 k: float = 1.0) -> dict:
    """E9 fit: bigram counts, prefix counts and vocabulary size (add-k).

    Out-of-vocabulary tokens are mapped to ``<|unk|>`` when scoring, so the
    vocabulary counts it too. Hot ``prev`` keys are pre-aggregated map-side.
    """
    # the fitted model: count tables materialised once, read by every scoring job
    vocab = cut_lineage(train.select(F.explode(tokens_col).alias("tok")).distinct())
    V = vocab.select(F.count(F.lit(1))).scalar() + 1
    bg = bigrams(train, tokens_col, key)
    pair = cut_lineage(bg.groupBy("prev", "next").agg(F.count(F.lit(1)).alias("c_pair")))
    prev = cut_lineage(pair.groupBy("prev").agg(F.sum("c_pair").alias("c_prev")))
    return {"vocab": vocab, "V": V, "pair": pair, "prev": prev, "k": float(k)}


def map_unknown(df: DataFrame, lm: dict, tokens_col: str = "tokens", key: str = "doc_id") -> DataFrame:
    """Replace tokens outside the LM vocabulary with ``<|unk|>``, in order.

    The distinct tokens of a block of rows are joined (:mod:`words`), not every token.
    Rows that share a key are one row, their tokens by place; rows without tokens are left out.
    A written table.
    """
    known = lm["vocab"].select(F.col("tok").alias("v"), F.col("tok").alias("new"))
    t = write_table(mapped_lists(df, key, F.col(tokens_col), known, lambda v: F.lit(fixed.UNK))
                    .where(F.size("_out") > 0), "mapped-rows")
    many = t.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_key")
    if many.isEmpty():
        return t.select(key, F.col("_out").alias(tokens_col))
    same = F.col(key).eqNullSafe(F.col("_key"))
    ex = t.join(many, same, "left_semi").select(key, F.posexplode("_out").alias("pos", "t"))
    g = ex.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "t"))).alias("_p"))
    return write_table(t.join(many, same, "left_anti").select(key, F.col("_out").alias(tokens_col))
                       .unionByName(g.select(key, F.transform("_p", lambda x: x["t"]).alias(tokens_col))), "mapped")


def token_logprobs(df: DataFrame, lm: dict, tokens_col: str = "tokens", key: str = "doc_id") -> DataFrame:
    """``(key, pos, logp)``: add-k bigram log-probabilities of each next token.

    Both joins deal hot pairs and hot first tokens over tasks; the mapped tokens are
    written once, as the sketches read them too."""
    bg = bigrams(map_unknown(df, lm, tokens_col, key), tokens_col, key)
    k, V = lm["k"], lm["V"]
    first = heavy_hitters(bg, ["prev"])
    j = skew_join(skew_join(bg, lm["pair"], ["prev", "next"], "left", spread=[key, "pos"]), lm["prev"], "prev", "left",
                  spread=[key, "pos"], salts=first)
    p = (F.coalesce(F.col("c_pair"), F.lit(0)) + k) / (F.coalesce(F.col("c_prev"), F.lit(0)) + k * V)
    return j.select(key, "pos", F.log(p).alias("logp"))


def ngram_lm_score(df: DataFrame, lm: dict, tokens_col: str = "tokens", key: str = "doc_id") -> DataFrame:
    """E9 score: ``(key, n_bigrams, nll, perplexity)`` per document.

    The logarithms of a document's pair counts and of its first tokens' counts are summed
    apart, each from a list brought up by block (:mod:`words`), so that no row is made for
    every bigram. Lists are summed in order."""
    d = map_unknown(df, lm, tokens_col, key).where(F.size(tokens_col) >= 2)
    t, n = F.col(tokens_col), F.size(tokens_col) - 1
    # a pair as one string: its first token's length tells where that ends
    pair = lambda a, b: F.concat(F.length(a).cast("string"), F.lit(":"), a, b)
    pairs = F.transform(F.arrays_zip(F.slice(t, 1, n).alias("a"), F.slice(t, 2, n).alias("b")), lambda x: pair(x["a"], x["b"]))
    counts = lm["pair"].select(pair(F.col("prev"), F.col("next")).alias("v"), F.col("c_pair").alias("new"))
    firsts = lm["prev"].select(F.col("prev").alias("v"), F.col("c_prev").alias("new"))
    none = lambda v: F.lit(0).cast("long")
    logs = lambda add: F.aggregate("_out", F.lit(0.0), lambda total, c: total + F.log(c + add))
    kv = F.lit(lm["k"]) * lm["V"]
    up = mapped_lists(d, key, pairs, counts, none).select(key, F.size("_out").alias("_n"), logs(F.lit(lm["k"])).alias("_log"))
    down = mapped_lists(d, key, F.slice(t, 1, n), firsts, none).withColumn("_kv", kv) \
        .select(key, F.lit(0).alias("_n"), (-logs(F.col("_kv"))).alias("_log"))
    return up.unionByName(down).groupBy(key).agg(F.sum("_n").cast("long").alias("n_bigrams"),
                                                 (-F.sum("_log") / F.sum("_n")).alias("nll")) \
        .withColumn("perplexity", F.exp("nll"))


def unigram_score(df: DataFrame, train: DataFrame, tokens_col: str = "tokens", key: str = "doc_id",
                  k: float = 1.0) -> DataFrame:
    """E9 with n = 1: ``(key, n_tokens, nll, perplexity)`` under add-k token
    frequencies of ``train``; unknown tokens share the one ``<|unk|>`` count of zero."""
    c = write_table(train.select(F.explode(tokens_col).alias("tok")).groupBy("tok")
                    .agg(F.count(F.lit(1)).alias("c")), "unigrams")
    total = c.select(F.coalesce(F.sum("c"), F.lit(0))).scalar()
    v = c.select(F.count(F.lit(1))).scalar() + 1
    # a document's tokens are counted before the join, so a hot token is one row per document
    mine = df.select(key, F.explode(tokens_col).alias("tok")).groupBy(key, "tok").agg(F.count(F.lit(1)).alias("n"))
    p = (F.coalesce(F.col("c"), F.lit(0)) + k) / (total + k * v)
    return mine.join(c, "tok", "left").groupBy(key).agg(
        F.sum("n").cast("long").alias("n_tokens"), (-F.sum(F.col("n") * F.log(p)) / F.sum("n")).alias("nll")) \
        .withColumn("perplexity", F.exp("nll"))


# ---------------------------------------------------------------- E8 loss

def cross_entropy(logprobs: DataFrame, batch_col: str = "batch_id", target_col: str | None = None,
                  ignore: int = fixed.IGNORE_INDEX, num_batches: int | None = None) -> DataFrame:
    """Loss as the mean of batch means (the loader form) and as the
    token-weighted mean; perplexity = exp(loss). Rows whose target is the
    ignore index are skipped; no rows give NaN."""
    d = logprobs
    if target_col is not None:
        d = d.where(F.col(target_col) != ignore)
    if num_batches is not None:
        d = d.where(F.col(batch_col) < num_batches)
    per = d.groupBy(batch_col).agg((-F.avg("logp")).alias("bl"), F.sum("logp").alias("s"),
                                   F.count(F.lit(1)).alias("n"))
    out = per.agg(F.avg("bl").alias("loss_batch_mean"),
                  (-F.sum("s") / F.sum("n")).alias("loss_token_mean"),
                  F.count(F.lit(1)).cast("long").alias("n_batches"))
    return out.select(F.coalesce("loss_batch_mean", F.lit(float("nan"))).alias("loss_batch_mean"),
                      F.coalesce("loss_token_mean", F.lit(float("nan"))).alias("loss_token_mean"),
                      "n_batches", F.exp(F.coalesce("loss_batch_mean", F.lit(float("nan"))))
                      .alias("perplexity"))


# ---------------------------------------------------------------- E10 / E11 sampling filters

def _beside(d: DataFrame, stats: DataFrame, seq: str) -> DataFrame:
    """``d`` with the columns of ``stats`` (one row per sequence). A join, which
    splits a hot sequence over tasks where a window would not."""
    s = stats.withColumnRenamed(seq, "_seq")
    return d.join(s, F.col(seq).eqNullSafe(F.col("_seq"))).drop("_seq")


def next_token_candidates(scores: DataFrame, top_k: int | None = None, temperature: float = 1.0,
                          seq: str = "seq", token: str = "token", logit: str = "logit") -> DataFrame:
    """Keep logits >= the k-th largest (ties kept), divide by T,
    softmax per sequence. T = 0 keeps the argmax (lowest token on ties).

    The k-th largest comes from running counts over the distinct logits, maxima
    and sums from aggregates, so no sequence is gathered in one task.
    """
    d = write_table(scores.select(seq, token, logit), "scores")
    if top_k is not None:
        values = d.groupBy(seq, logit).agg(F.count(F.lit(1)).alias("_n"))
        above = partitioned_offsets(values, seq, [F.desc(logit)], "_n", offset_col="_above")
        least = above.where(F.col("_above") < top_k).groupBy(seq).agg(F.min(logit).alias("_least"))
        d = _beside(d, least, seq).where(F.col(logit) >= F.col("_least")).drop("_least")
    if temperature == 0:
        best = d.groupBy(seq).agg(F.min_by(token, F.struct(-F.col(logit), F.col(token))).alias(token))
        return best.withColumn("prob", F.lit(1.0))
    d = _beside(d, d.groupBy(seq).agg(F.max(logit).alias("_most")), seq)
    d = d.select(seq, token, F.exp((F.col(logit) - F.col("_most")) / F.lit(temperature)).alias("_e"))
    total = d.groupBy(seq).agg(F.sum("_e").alias("_total"))
    return _beside(d, total, seq).select(seq, token, (F.col("_e") / F.col("_total")).alias("prob"))


def nucleus_filter(probs: DataFrame, p: float, seq: str = "seq", token: str = "token",
                   prob: str = "prob") -> DataFrame:
    """Drop tokens once the cumulative probability before them exceeds
    p (the most probable token is always kept); order ties by token.

    Running sums go over ranges of all rows, in decimals, so that many sequences
    before one cost it no digits.
    """
    before = partitioned_offsets(probs, seq, [F.desc(prob), F.col(token)], F.col(prob).cast("decimal(28,18)"),
                                 ordinal_col="_nth", offset_col="_before")
    # rounded so that sums equal to p up to float noise compare as equal
    return before.where(F.round(F.col("_before").cast("double"), 9) <= p).drop("_nth", "_before")


def repetition_penalty(scores: DataFrame, history: DataFrame, r: float, seq: str = "seq",
                       token: str = "token", logit: str = "logit") -> DataFrame:
    """Divide the logits of already seen tokens by r."""
    seen = history.select(seq, token).distinct().withColumn("_seen", F.lit(True))
    return scores.join(seen, [seq, token], "left").withColumn(
        logit, F.when(F.col("_seen"), F.col(logit) / r).otherwise(F.col(logit))).drop("_seen")


# ---------------------------------------------------------------- E12 generation

def generate_greedy(prompts: DataFrame, lm: dict, max_new: int, eos: str | None = None,
                    tokens_col: str = "tokens", key: str = "doc_id",
                    checkpoint_every: int = 4) -> DataFrame:
    """Append the most likely next token (bigram counts, ties to the
    smallest token) ``max_new`` times; stop at ``eos`` (not appended). The
    best-next table is one row per context token."""
    best = lm["pair"].groupBy("prev").agg(
        F.min_by("next", F.struct(-F.col("c_pair"), F.col("next"))).alias("_nx"))
    cur = prompts.select(key, F.col(tokens_col).alias("gen"), F.lit(False).alias("done"))
    for step in range(max_new):
        j = cur.withColumn("prev", F.element_at("gen", -1)).join(best, "prev", "left")
        stop = F.col("done") | F.col("_nx").isNull() | (F.lit(eos).isNotNull() & (F.col("_nx") == F.lit(eos))) \
            if eos is not None else F.col("done") | F.col("_nx").isNull()
        cur = j.select(key, F.when(stop, F.col("gen")).otherwise(
            F.concat("gen", F.array("_nx"))).alias("gen"), stop.alias("done"))
        if (step + 1) % checkpoint_every == 0:
            cur = cut_lineage(cur)
    return cur.select(key, F.col("gen").alias(tokens_col))


# ---------------------------------------------------------------- E14 BLEU / ROUGE-L

def _ngrams(tokens: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1),
                       lambda i: F.array_join(F.slice(tokens, i, n), " "))


def bleu4(pairs: DataFrame, cand: str = "candidate", ref: str = "reference",
          key: str = "pair_id") -> DataFrame:
    """Corpus BLEU-4: clipped n-gram precisions (n = 1..4) summed over
    all pairs, geometric mean, brevity penalty exp(1 - r/c) when c <= r."""
    # The split pairs feed nine branches (8 n-gram sides + lengths): write
    # them once instead of re-deriving them (and any subquery) per branch.
    d = cut_lineage(pairs.select(key, word_split(F.col(cand)).alias("c"),
                                 word_split(F.col(ref)).alias("r")))
    rows = []
    for n in range(1, 5):
        cg = d.where(F.size("c") >= n).select(key, F.explode(_ngrams(F.col("c"), n)).alias("g")) \
            .groupBy(key, "g").agg(F.count(F.lit(1)).alias("cc"))
        rg = d.where(F.size("r") >= n).select(key, F.explode(_ngrams(F.col("r"), n)).alias("g")) \
            .groupBy(key, "g").agg(F.count(F.lit(1)).alias("rc"))
        m = cg.join(rg, [key, "g"], "left").agg(
            F.sum(F.least("cc", F.coalesce("rc", F.lit(0)))).alias("match"),
            F.sum("cc").alias("total")).select(F.lit(n).alias("n"), "match", "total")
        rows.append(m)
    prec = rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])
    lens = d.agg(F.sum(F.size("c")).alias("c_len"), F.sum(F.size("r")).alias("r_len"))
    p = prec.groupBy().pivot("n", [1, 2, 3, 4]).agg(
        F.first(F.col("match") / F.col("total"))) \
        .select(*[F.col(str(i)).alias(f"p{i}") for i in range(1, 5)])
    both = p.unionByName(lens, allowMissingColumns=True).agg(
        *[F.max(f"p{i}").alias(f"p{i}") for i in range(1, 5)],
        F.max("c_len").alias("c_len"), F.max("r_len").alias("r_len"))
    bp = F.when(F.col("c_len") > F.col("r_len"), F.lit(1.0)).otherwise(
        F.exp(1 - F.col("r_len") / F.col("c_len")))
    geo = F.when(F.least("p1", "p2", "p3", "p4") > 0, F.exp(
        (F.log("p1") + F.log("p2") + F.log("p3") + F.log("p4")) / 4)).otherwise(F.lit(0.0))
    return both.select("p1", "p2", "p3", "p4", F.col("c_len").cast("long"), F.col("r_len").cast("long"),
                       bp.alias("brevity_penalty"), (bp * geo).alias("bleu"))


def _lcs_len(a, b) -> int:
    """Length of the longest common subsequence, all of ``b`` at once as the bits
    of one integer: a zero bit marks where the row's length rises by one."""
    where: dict = {}
    for j, y in enumerate(b):
        where[y] = where.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & where.get(x, 0)
        row = (row + hit | row - hit) & full
    return len(b) - row.bit_count()


@F.pandas_udf(T.DoubleType())
def _rouge_l_f(c: pd.Series, r: pd.Series) -> pd.Series:
    out = []
    for a, b in zip(c, r):
        a = list(a) if a is not None else []
        b = list(b) if b is not None else []
        lcs = _lcs_len(a, b)
        if lcs == 0:
            out.append(0.0)
            continue
        p, rr = lcs / len(a), lcs / len(b)
        out.append(2 * p * rr / (p + rr))
    return pd.Series(out, dtype="float64")


def rouge_l(pairs: DataFrame, cand: str = "candidate", ref: str = "reference",
            key: str = "pair_id") -> DataFrame:
    """ROUGE-L F1 per pair from the longest common token subsequence
    (vectorised per row inside a pandas UDF; whole texts)."""
    return pairs.select(key, _rouge_l_f(word_split(F.col(cand)), word_split(F.col(ref))).alias("rouge_l"))
