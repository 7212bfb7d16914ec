"""Registered queries: baselines, scoring and evaluation (E) and template checks."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.text import TEMPLATE_PATTERN
from ..operators import evaluate as E, instruct, sequences as S
from ..operators.order import with_ordinal
from ..session import cut_lineage, write_table
from .q_seq import _D_PAIRS, _d_prompt
from .registry import d_word_split, query, sq, table

# ---------------------------------------------------------------- shared inputs

_TERM = r"[\p{L}\p{N}_]{2,}"

_D_LAB = """
lab AS (SELECT d.doc_id, d.text, l.quality AS label, l.toxic FROM documents d JOIN labels l USING (doc_id)),
sp AS (SELECT *, CASE WHEN r < floor(0.8::DOUBLE * n) THEN 'train'
                      WHEN r < floor(0.8::DOUBLE * n) + floor(0.1::DOUBLE * n) THEN 'val'
                      ELSE 'test' END AS split
       FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS r, count(*) OVER () AS n FROM lab) z)"""


def labelled(spark, sf):
    """documents JOIN labels -> (doc_id, text, label, toxic, split) 80/10/10 by doc_id.

    Materialised once: every evaluation job reads the same split."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id") \
        .select("doc_id", "text", F.col("quality").alias("label"), "toxic")
    return cut_lineage(S.split_rows(d, (0.8, 0.1), names=("train", "val", "test")))


def _d_rule_pred() -> str:
    return ("(CASE WHEN length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'))::DOUBLE "
            "/ nullif(length(text), 0) > 0.95 THEN 1 ELSE 0 END)")


def _rule_pred():
    return F.when(X.ascii_ratio("text") > 0.95, 1).otherwise(0)


# ---------------------------------------------------------------- E1 / E2


@query("e1_bag_of_words", f"""
WITH {_D_LAB},
v AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), {sq(_TERM)})) AS term FROM sp WHERE split = 'train'),
c AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), {sq(_TERM)})) AS term FROM sp)
SELECT doc_id, term, count(*)::BIGINT AS n FROM c WHERE term IN (SELECT term FROM v) GROUP BY doc_id, term""")
def e1_bag_of_words(spark, sf):
    d = labelled(spark, sf)
    return E.bag_of_words(d, d.where(F.col("split") == "train")).select("doc_id", "term", "n")


@query("e2_tfidf", f"""
WITH {_D_LAB},
tt AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), {sq(_TERM)})) AS term FROM sp WHERE split = 'train'),
nd AS (SELECT count(*) AS n FROM sp WHERE split = 'train'),
st AS (SELECT term, count(*) AS tf_all, count(DISTINCT doc_id) AS df FROM tt GROUP BY term),
idf AS (SELECT term, ln((1 + nd.n)::DOUBLE / (1 + df)) + 1 AS idf FROM st, nd
        QUALIFY row_number() OVER (ORDER BY tf_all DESC, term) <= 50000),
c AS (SELECT doc_id, term, count(*) AS n FROM
        (SELECT doc_id, unnest(regexp_extract_all(lower(text), {sq(_TERM)})) AS term FROM sp) x GROUP BY doc_id, term),
w AS (SELECT doc_id, term, n * idf AS w FROM c JOIN idf USING (term))
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM w""")
def e2_tfidf(spark, sf):
    d = labelled(spark, sf)
    t = E.tfidf(d, d.where(F.col("split") == "train"))
    return t.select("doc_id", "term", F.round("tfidf", 6).alias("tfidf"))


# ---------------------------------------------------------------- E3 - E7, E16


@query("e3_majority_baseline", f"""
WITH {_D_LAB},
c AS (SELECT split, label, count(*) AS n FROM sp GROUP BY split, label),
m AS (SELECT label AS maj FROM c WHERE split = 'train' ORDER BY n DESC, label LIMIT 1)
SELECT split, (SELECT maj FROM m) AS majority_label,
       round(sum(CASE WHEN label = (SELECT maj FROM m) THEN n ELSE 0 END)::DOUBLE / sum(n), 6) AS accuracy,
       sum(n)::BIGINT AS n FROM c GROUP BY split""")
def e3_majority_baseline(spark, sf):
    m = E.majority_baseline(labelled(spark, sf))
    return m.select("split", "majority_label", F.round("accuracy", 6).alias("accuracy"), "n")


@query("e4_logreg")
def e4_logreg(spark, sf):
    _, pred = E.logreg(labelled(spark, sf))
    return E.accuracy(pred, by="split").select("split", F.round("accuracy", 6).alias("accuracy"), "n")


@query("e5_accuracy", f"""
WITH {_D_LAB}
SELECT split, round(avg(CASE WHEN {_d_rule_pred()} = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       count(*)::BIGINT AS n FROM sp GROUP BY split""")
def e5_accuracy(spark, sf):
    d = labelled(spark, sf).withColumn("pred", _rule_pred())
    return E.accuracy(d, by="split").select("split", F.round("accuracy", 6).alias("accuracy"), "n")


@query("e6_classification_report", f"""
WITH {_D_LAB},
p AS (SELECT label AS y, {_d_rule_pred()} AS p FROM sp),
cls AS (SELECT y AS cls FROM p UNION SELECT p FROM p)
SELECT cls, round(CASE WHEN pr > 0 THEN tp::DOUBLE / pr ELSE 0 END, 6) AS precision,
       round(CASE WHEN su > 0 THEN tp::DOUBLE / su ELSE 0 END, 6) AS recall,
       round(CASE WHEN tp > 0 THEN 2.0 * tp / (pr + su) ELSE 0 END, 6) AS f1,
       su::BIGINT AS support, tp::BIGINT AS tp, pr::BIGINT AS predicted
FROM (SELECT cls, (SELECT count(*) FROM p WHERE y = cls AND p = cls) AS tp,
             (SELECT count(*) FROM p WHERE y = cls) AS su,
             (SELECT count(*) FROM p WHERE p.p = cls) AS pr FROM cls) z""")
def e6_classification_report(spark, sf):
    d = labelled(spark, sf).withColumn("pred", _rule_pred())
    r = E.classification_report(d)
    return r.select("cls", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
                    "support", "tp", "predicted")


@query("e7_auc_roc", f"""
WITH {_D_LAB},
s AS (SELECT round(length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'))::DOUBLE / length(text), 3) AS score,
             label FROM sp),
per AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM s GROUP BY score),
cum AS (SELECT score, pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM per)
SELECT round(sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc FROM cum""")
def e7_auc_roc(spark, sf):
    d = labelled(spark, sf).select(F.round(X.ascii_ratio("text"), 3).alias("score"), "label")
    return E.auc_roc(d).select(F.round("auc", 6).alias("auc"))


@query("e16_cohens_kappa", f"""
WITH {_D_LAB},
p AS (SELECT label AS a, {_d_rule_pred()} AS b FROM sp),
t AS (SELECT count(*)::DOUBLE AS n FROM p),
po AS (SELECT count(*) / (SELECT n FROM t) AS po FROM p WHERE a = b),
pe AS (SELECT sum(na * nb) / ((SELECT n FROM t) * (SELECT n FROM t)) AS pe FROM
       (SELECT a AS c, count(*) AS na FROM p GROUP BY a) x JOIN (SELECT b AS c, count(*) AS nb FROM p GROUP BY b) y USING (c))
SELECT round(po, 6) AS po, round(pe, 6) AS pe, round((po - pe) / (1 - pe), 6) AS kappa FROM po, pe""")
def e16_cohens_kappa(spark, sf):
    d = labelled(spark, sf).withColumn("pred", _rule_pred())
    k = E.cohens_kappa(d, "label", "pred")
    return k.select(*[F.round(c, 6).alias(c) for c in ("po", "pe", "kappa")])


# ---------------------------------------------------------------- E8 - E11 language model

def _lm_inputs(spark, sf):
    # split once: the fit reads the tokens twice, the scores again
    d = write_table(labelled(spark, sf).select("doc_id", "split", X.word_split("text").alias("tokens")), "lm-tokens")
    lm = E.ngram_lm_fit(d.where(F.col("split") == "train"), k=1.0)
    return d, lm


_D_LM = f"""
{_D_LAB},
tk AS (SELECT doc_id, split, {d_word_split('text')} AS t FROM sp),
voc AS (SELECT DISTINCT unnest(t) AS tok FROM tk WHERE split = 'train'),
vs AS (SELECT count(*) + 1 AS V FROM voc),
trb AS (SELECT unnest(t[1:len(t) - 1]) AS prev, unnest(t[2:len(t)]) AS next FROM tk WHERE split = 'train' AND len(t) >= 2),
pair AS (SELECT prev, next, count(*) AS c_pair FROM trb GROUP BY prev, next),
pprev AS (SELECT prev, sum(c_pair) AS c_prev FROM pair GROUP BY prev),
ex AS (SELECT doc_id, split, unnest(t) AS tok, unnest(range(1, len(t) + 1)) AS pos FROM tk),
mp AS (SELECT doc_id, split, pos, CASE WHEN tok IN (SELECT tok FROM voc) THEN tok ELSE '<|unk|>' END AS tok FROM ex),
bg AS (SELECT a.doc_id, a.split, a.pos, a.tok AS prev, b.tok AS next FROM mp a JOIN mp b
       ON a.doc_id = b.doc_id AND b.pos = a.pos + 1),
lp AS (SELECT bg.doc_id, bg.split, bg.pos, prev, next,
              ln((coalesce(c_pair, 0) + 1.0) / (coalesce(c_prev, 0) + 1.0 * (SELECT V FROM vs))) AS logp
       FROM bg LEFT JOIN pair USING (prev, next) LEFT JOIN pprev USING (prev))"""


@query("e9_ngram_lm_score", f"""
WITH {_D_LM}
SELECT doc_id, count(*)::BIGINT AS n_bigrams, round(-avg(logp), 6) AS nll, round(exp(-avg(logp)), 6) AS perplexity
FROM lp WHERE split <> 'train' GROUP BY doc_id""")
def e9_ngram_lm_score(spark, sf):
    d, lm = _lm_inputs(spark, sf)
    s = E.ngram_lm_score(d.where(F.col("split") != "train"), lm)
    return s.select("doc_id", "n_bigrams", F.round("nll", 6).alias("nll"),
                    F.round("perplexity", 6).alias("perplexity"))


@query("e8_cross_entropy", f"""
WITH {_D_LM},
vb AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 4 AS batch_id FROM sp WHERE split = 'val'),
l AS (SELECT batch_id, logp FROM lp JOIN vb USING (doc_id)),
b AS (SELECT batch_id, -avg(logp) AS bl, sum(logp) AS s, count(*) AS n FROM l GROUP BY batch_id)
SELECT round(avg(bl), 6) AS loss_batch_mean, round(-sum(s) / sum(n), 6) AS loss_token_mean,
       count(*)::BIGINT AS n_batches, round(exp(avg(bl)), 6) AS perplexity FROM b""")
def e8_cross_entropy(spark, sf):
    d, lm = _lm_inputs(spark, sf)
    val = d.where(F.col("split") == "val")
    b = S.batch(with_ordinal(val.select("doc_id"), "doc_id", name="position"), 4)
    lp = E.token_logprobs(val, lm).join(b.select("doc_id", "batch_id"), "doc_id")
    ce = E.cross_entropy(lp)
    return ce.select(F.round("loss_batch_mean", 6).alias("loss_batch_mean"),
                     F.round("loss_token_mean", 6).alias("loss_token_mean"), "n_batches",
                     F.round("perplexity", 6).alias("perplexity"))


_D_SCORES = """
sc AS (SELECT prev AS seq, next AS token,
              ln((c_pair + 1.0) / (c_prev + 1.0 * (SELECT V FROM vs))) AS logit
       FROM pair JOIN pprev USING (prev))"""


def _scores(lm):
    return lm["pair"].join(lm["prev"], "prev").select(
        F.col("prev").alias("seq"), F.col("next").alias("token"),
        F.log((F.col("c_pair") + lm["k"]) / (F.col("c_prev") + lm["k"] * lm["V"])).alias("logit"))


@query("e10_next_token_candidates", f"""
WITH {_D_LM}, {_D_SCORES},
k AS (SELECT * FROM sc QUALIFY rank() OVER (PARTITION BY seq ORDER BY logit DESC) <= 3),
z AS (SELECT seq, token, logit / 0.7 - max(logit / 0.7) OVER (PARTITION BY seq) AS z FROM k)
SELECT seq, token, round(round(exp(z) / sum(exp(z)) OVER (PARTITION BY seq), 9), 6) AS prob FROM z""")
def e10_next_token_candidates(spark, sf):
    _, lm = _lm_inputs(spark, sf)
    c = E.next_token_candidates(_scores(lm), top_k=3, temperature=0.7)
    # round(., 9) first: a tie such as 3/128 must not flip with summation order
    return c.select("seq", "token", F.round(F.round("prob", 9), 6).alias("prob"))


@query("e11_nucleus_filter", f"""
WITH {_D_LM}, {_D_SCORES},
z AS (SELECT seq, token, logit - max(logit) OVER (PARTITION BY seq) AS z FROM sc),
p AS (SELECT seq, token, exp(z) / sum(exp(z)) OVER (PARTITION BY seq) AS prob FROM z),
c AS (SELECT seq, token, prob, coalesce(sum(prob) OVER (PARTITION BY seq ORDER BY prob DESC, token
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p)
SELECT seq, token, round(round(prob, 9), 6) AS prob FROM c WHERE round(before, 9) <= 0.5""")
def e11_nucleus_filter(spark, sf):
    _, lm = _lm_inputs(spark, sf)
    p = E.next_token_candidates(_scores(lm), top_k=None, temperature=1.0)
    # round(., 9) first: a tie such as 3/128 must not flip with summation order
    return E.nucleus_filter(p, 0.5).select("seq", "token", F.round(F.round("prob", 9), 6).alias("prob"))


@query("e12_generate_greedy", f"""
WITH RECURSIVE {_D_LM.strip()},
best AS (SELECT prev, arg_min(next, (-c_pair, next)) AS nx FROM pair GROUP BY prev),
g(doc_id, step, gen) AS (
  SELECT doc_id, 0, t[1:3] FROM tk WHERE split <> 'train'
  UNION ALL SELECT g.doc_id, g.step + 1, list_append(g.gen, b.nx) FROM g JOIN best b ON b.prev = g.gen[len(g.gen)] WHERE g.step < 6)
SELECT doc_id, array_to_string(arg_max(gen, step), ' ') AS generated FROM g GROUP BY doc_id""")
def e12_generate_greedy(spark, sf):
    d, lm = _lm_inputs(spark, sf)
    prompts = d.where(F.col("split") != "train").select("doc_id", F.slice("tokens", 1, 3).alias("tokens"))
    g = E.generate_greedy(prompts, lm, max_new=6)
    return g.select("doc_id", F.array_join("tokens", " ").alias("generated"))


# ---------------------------------------------------------------- E13 - E15, E17


@query("e13_extract_response", f"""
SELECT conv_id, turn, md5(trim(replace(substr({_d_prompt(True)}, length({_d_prompt(False)}) + 1),
       '### Response:', ''), {'(' + ' || '.join(f'chr({ord(c)})' for c in X._WS_TRIM) + ')'})) AS response_md5
FROM ({_D_PAIRS}) p""")
def e13_extract_response(spark, sf):
    p = instruct.pairs_from_conversations(table(spark, sf, "conversations"))
    gen = X.format_prompt("instruction", "input", "output")
    r = X.extract_response(gen, X.format_prompt("instruction", "input"))
    return p.select("conv_id", "turn", F.md5(r).alias("response_md5"))


_D_BLEU_PAIRS = f"""
pairs AS (SELECT p.conv_id * 4294967296 + p.turn AS pair_id, {d_word_split('p.output')} AS c, {d_word_split('b.text')} AS r
          FROM ({_D_PAIRS}) p JOIN benchmark b ON b.item_id = p.conv_id % (SELECT count(*) FROM benchmark))"""


def _bleu_pairs(spark, sf):
    p = instruct.pairs_from_conversations(table(spark, sf, "conversations"))
    b = table(spark, sf, "benchmark")
    n_items = b.select(F.count(F.lit(1))).scalar()
    return p.join(b, F.col("item_id") == F.pmod(F.col("conv_id"), n_items)) \
        .select((F.shiftleft(F.col("conv_id"), 32) + F.col("turn")).alias("pair_id"), F.col("output").alias("candidate"),
                F.col("text").alias("reference"))


def _d_ngram_counts(col: str, n: int) -> str:
    return (f"SELECT pair_id, g, count(*) AS k FROM (SELECT pair_id, unnest(list_transform("
            f"range(1, len({col}) - {n} + 2), lambda i: array_to_string({col}[i:i + {n - 1}], ' '))) AS g "
            f"FROM pairs WHERE len({col}) >= {n}) z GROUP BY pair_id, g")


@query("e14_bleu4", "WITH " + _D_BLEU_PAIRS.strip() + ",\n" + ",\n".join(
    f"m{n} AS (SELECT sum(least(cc.k, coalesce(rc.k, 0)))::DOUBLE / sum(cc.k) AS p FROM ({_d_ngram_counts('c', n)}) cc "
    f"LEFT JOIN ({_d_ngram_counts('r', n)}) rc USING (pair_id, g))" for n in range(1, 5)) + """,
l AS (SELECT sum(len(c)) AS cl, sum(len(r)) AS rl FROM pairs),
bp AS (SELECT CASE WHEN cl > rl THEN 1.0 ELSE exp(1 - rl::DOUBLE / cl) END AS bp FROM l)
SELECT round(m1.p, 6) AS p1, round(m2.p, 6) AS p2, round(m3.p, 6) AS p3, round(m4.p, 6) AS p4,
       l.cl::BIGINT AS c_len, l.rl::BIGINT AS r_len, round(bp.bp, 6) AS brevity_penalty,
       round(CASE WHEN least(m1.p, m2.p, m3.p, m4.p) > 0
                  THEN bp.bp * exp((ln(m1.p) + ln(m2.p) + ln(m3.p) + ln(m4.p)) / 4) ELSE 0 END, 6) AS bleu
FROM m1, m2, m3, m4, l, bp""")
def e14_bleu4(spark, sf):
    b = E.bleu4(_bleu_pairs(spark, sf))
    return b.select(*[F.round(f"p{i}", 6).alias(f"p{i}") for i in range(1, 5)], "c_len", "r_len",
                    F.round("brevity_penalty", 6).alias("brevity_penalty"), F.round("bleu", 6).alias("bleu"))


# the table of longest common subsequences, a row (list over the reference's prefixes) for each prefix of the candidate
@query("e14_rouge_l", "WITH RECURSIVE " + _D_BLEU_PAIRS.strip() + """,
d(pair_id, i, v) AS (
  SELECT pair_id, 0, list_transform(range(0, len(r) + 1), lambda x: 0::BIGINT) FROM pairs
  UNION ALL
  SELECT pair_id, i + 1, list_transform(range(1, len(b) + 1), lambda j: list_max(b[1:j])) FROM (
    SELECT d.pair_id, i, list_prepend(0::BIGINT, list_transform(range(1, len(r) + 1),
             lambda j: greatest(v[j + 1], v[j] + CASE WHEN c[i + 1] = r[j] THEN 1 ELSE 0 END))) AS b
    FROM d JOIN pairs USING (pair_id) WHERE i < len(c)) z),
f AS (SELECT pair_id, v[len(v)]::DOUBLE AS lcs, len(c) AS nc, len(r) AS nr FROM d JOIN pairs USING (pair_id) WHERE i = len(c))
SELECT pair_id, round(CASE WHEN lcs = 0 THEN 0 ELSE 2 * lcs / nc * lcs / nr / (lcs / nc + lcs / nr) END, 6) AS rouge_l FROM f""")
def e14_rouge_l(spark, sf):
    r = E.rouge_l(_bleu_pairs(spark, sf))
    return r.select("pair_id", F.round("rouge_l", 6).alias("rouge_l"))


@query("b16_validate_template", f"""
SELECT conv_id, turn, regexp_matches({_d_prompt(True)}, {sq(TEMPLATE_PATTERN)}) AS ok FROM ({_D_PAIRS}) p""")
def b16_validate_template(spark, sf):
    p = instruct.pairs_from_conversations(table(spark, sf, "conversations"))
    f = p.select("conv_id", "turn", X.format_prompt("instruction", "input", "output").alias("t"))
    return f.select("conv_id", "turn", X.template_ok("t").alias("ok"))


@query("e15_adherence_rate", f"""
SELECT length(input) > 0 AS has_input,
       round(avg(CASE WHEN regexp_matches(t, {sq(TEMPLATE_PATTERN)}) THEN 1.0 ELSE 0.0 END), 6) AS adherence,
       count(*)::BIGINT AS n
FROM (SELECT input, CASE WHEN length(output) > 200 THEN {_d_prompt(True)} ELSE {_d_prompt(False)} END AS t
      FROM ({_D_PAIRS}) p) z GROUP BY 1""")
def e15_adherence_rate(spark, sf):
    p = instruct.pairs_from_conversations(table(spark, sf, "conversations"))
    t = F.when(F.length("output") > 200, X.format_prompt("instruction", "input", "output")) \
        .otherwise(X.format_prompt("instruction", "input"))
    d = p.select((F.length("input") > 0).alias("has_input"), X.template_ok(t).alias("ok"))
    return d.groupBy("has_input").agg(F.round(F.avg(F.col("ok").cast("double")), 6).alias("adherence"),
                                      F.count(F.lit(1)).cast("long").alias("n"))


@query("e17_learning_curve")
def e17_learning_curve(spark, sf):
    from ..operators.clean import md5_long
    f = E.term_vectors(labelled(spark, sf))       # one table for all fits
    train, val = f.where(F.col("split") == "train"), f.where(F.col("split") == "val")

    def one(frac):
        _, pred = E.fit_logreg(val, train.where(md5_long("doc_id", seed=11) < int(frac * (1 << 60))))
        acc = E.accuracy(pred)
        return acc.select(F.lit(frac).alias("fraction"), F.round("accuracy", 6).alias("accuracy"), "n")

    # a step of a fit is a short job that leaves cores idle: the smaller fits run beside the
    # largest; two at a time, as each keeps a score of model-long vectors at the driver
    with ThreadPoolExecutor(2) as pool:
        big, *rest = [pool.submit(inheritable_thread_target(spark)(one), frac) for frac in (1.0, 0.25, 0.5)]
        out = rest[0].result()
        for r in (rest[1], big):
            out = out.unionByName(r.result())
    return out


#: The bigram model of the train split, scored on every document.
_D_LM_ALL = _D_LM.replace("SELECT doc_id, split, unnest(t) AS tok, unnest(range(1, len(t) + 1)) AS pos FROM tk)",
                          f"SELECT doc_id, 'all' AS split, unnest(t) AS tok, unnest(range(1, len(t) + 1)) AS pos "
                          f"FROM (SELECT doc_id, {d_word_split('text')} AS t FROM documents) a)")


def _all_scores(spark, sf):
    """Perplexity of every document (materialised: the filter ranks and joins it)."""
    _, lm = _lm_inputs(spark, sf)
    docs = table(spark, sf, "documents").select("doc_id", X.word_split("text").alias("tokens"))
    return cut_lineage(E.ngram_lm_score(docs, lm))


@query("e9_unigram_score", f"""
WITH {_D_LAB},
tr AS (SELECT unnest({d_word_split('text')}) AS tok FROM sp WHERE split = 'train'),
c AS (SELECT tok, count(*) AS c FROM tr GROUP BY tok),
t AS (SELECT sum(c) AS total, count(*) + 1 AS v FROM c),
x AS (SELECT doc_id, unnest({d_word_split('text')}) AS tok FROM sp WHERE split <> 'train')
SELECT doc_id, count(*)::BIGINT AS n_tokens, round(-avg(ln((coalesce(c, 0) + 1.0) / (total + v))), 6) AS nll,
       round(exp(-avg(ln((coalesce(c, 0) + 1.0) / (total + v)))), 4) AS perplexity
FROM x LEFT JOIN c USING (tok), t GROUP BY doc_id""")
def e9_unigram_score(spark, sf):
    d = labelled(spark, sf).withColumn("tokens", X.word_split("text"))
    u = E.unigram_score(d.where(F.col("split") != "train"), d.where(F.col("split") == "train"))
    return u.select("doc_id", "n_tokens", F.round("nll", 6).alias("nll"), F.round("perplexity", 4).alias("perplexity"))


@query("b13_perplexity_filter", f"""
WITH {_D_LM_ALL},
sc AS (SELECT doc_id, exp(-avg(logp)) AS ppl FROM lp GROUP BY doc_id)
SELECT d.doc_id, round(sc.ppl, 6) AS perplexity FROM documents d JOIN sc USING (doc_id)
WHERE sc.ppl BETWEEN 50 AND 5000""")
def b13_perplexity_filter(spark, sf):
    from ..operators import clean
    scores = _all_scores(spark, sf)
    kept = clean.perplexity_filter(table(spark, sf, "documents").select("doc_id"), scores, lo=50, hi=5000)
    return kept.join(scores.select("doc_id", F.round("perplexity", 6).alias("perplexity")), "doc_id")


@query("b13_perplexity_quantile_filter", f"""
WITH {_D_LM_ALL},
sc AS (SELECT doc_id, round(exp(-avg(logp)), 9) AS ppl FROM lp GROUP BY doc_id),
o AS (SELECT doc_id, ppl, row_number() OVER (ORDER BY ppl, doc_id) - 1 AS r, count(*) OVER () AS n FROM sc)
SELECT doc_id FROM o WHERE ppl >= (SELECT ppl FROM o WHERE r = floor(0.05::DOUBLE * (n - 1)))
  AND ppl <= (SELECT ppl FROM o WHERE r = floor(0.95::DOUBLE * (n - 1)))""")
def b13_perplexity_quantile_filter(spark, sf):
    from ..operators import clean
    # rounded: the bounds are scores themselves, which float noise must not move
    scores = _all_scores(spark, sf).withColumn("perplexity", F.round("perplexity", 9))
    return clean.perplexity_filter(table(spark, sf, "documents").select("doc_id"), scores,
                                   q_lo=0.05, q_hi=0.95)


@query("e11_repetition_penalty", f"""
WITH {_D_LM}, {_D_SCORES}
SELECT seq, token, round(CASE WHEN token = seq THEN logit / 1.3 ELSE logit END, 6) AS logit FROM sc""")
def e11_repetition_penalty(spark, sf):
    _, lm = _lm_inputs(spark, sf)
    sc = _scores(lm)
    history = sc.select("seq", F.col("seq").alias("token")).distinct()     # the context token itself
    r = E.repetition_penalty(sc, history, 1.3)
    return r.select("seq", "token", F.round("logit", 6).alias("logit"))


@query("e6_confusion_matrix", f"""
WITH {_D_LAB}
SELECT label, {_d_rule_pred()} AS pred, count(*)::BIGINT AS n FROM sp GROUP BY 1, 2""")
def e6_confusion_matrix(spark, sf):
    d = labelled(spark, sf).withColumn("pred", _rule_pred())
    return E.confusion_matrix(d)
