"""Registered queries: vector aggregation (G) and run metrics (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M, vectors as V
from .q_seq import _doc_ids, d_ids
from .registry import query, table

# ---------------------------------------------------------------- G shared

_BL = """bl AS (SELECT vec_id, vec_id // 32 AS block, (vec_id % 32)::INT AS pos,
                 embedding::DOUBLE[] AS vec FROM embeddings)"""


def _chk(x: str) -> str:
    return (f"round(list_sum({x}), 5) + 0.0 AS v_sum, "
            f"round(list_sum(list_transform({x}, lambda e: e * e)), 5) + 0.0 AS v_sq")


def _chk_s(c):
    return [(F.round(V.vsum(c), 5) + F.lit(0.0)).alias("v_sum"),
            (F.round(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x), 5) + F.lit(0.0)).alias("v_sq")]


def _blocks(spark, sf):
    return V.blocks(table(spark, sf, "embeddings"))


def _d_weights(src: str, keys: str, cond: str = "") -> str:
    """CTEs sc (scaled dot scores) and wt (softmax weights per query)."""
    ak = ", ".join("a." + k for k in keys.split(", "))
    return f"""
sc AS (SELECT {ak}, a.pos AS q, b.pos AS k, list_dot_product(a.vec, b.vec) / sqrt(len(a.vec)) AS score
       FROM {src} a JOIN {src} b USING ({keys}) {cond}),
zz AS (SELECT *, exp(score - max(score) OVER (PARTITION BY {keys}, q)) AS z FROM sc),
wt AS (SELECT {keys}, q, k, z / sum(z) OVER (PARTITION BY {keys}, q) AS weight FROM zz)"""


def _d_attention(src: str, keys: str, cond: str = "") -> str:
    """CTEs of :func:`_d_weights` plus cx (context vector per query)."""
    return _d_weights(src, keys, cond) + f""",
vx AS (SELECT {keys}, pos AS k, unnest(vec) AS x, unnest(range(len(vec))) AS dim FROM {src}),
cd AS (SELECT {keys}, q, dim, sum(weight * x) AS c FROM wt JOIN vx USING ({keys}, k) GROUP BY {keys}, q, dim),
cx AS (SELECT {keys}, q, list(c ORDER BY dim) AS ctx FROM cd GROUP BY {keys}, q)"""


# ---------------------------------------------------------------- G1 - G10


@query("g1_embedding_lookup", f"""
WITH {d_ids('documents')}, {_BL},
ex AS (SELECT doc_id, unnest(ids) AS id FROM ids)
SELECT doc_id, count(*)::BIGINT AS n_hit, round(sum(list_sum(vec)), 4) + 0.0 AS v_sum
FROM ex JOIN bl ON bl.vec_id = ex.id % (SELECT count(*) FROM bl) GROUP BY doc_id""")
def g1_embedding_lookup(spark, sf):
    # the table has fewer rows than the vocabulary: ids are taken modulo its size
    emb = table(spark, sf, "embeddings")
    tokens = _doc_ids(spark, sf).withColumn("_n", emb.select(F.count(F.lit(1))).scalar()) \
        .select("doc_id", F.transform("ids", lambda i: F.pmod(i, F.col("_n"))).alias("ids"))
    # a row's sum is taken in the table, where there are few, and looked up with its vector
    emb = emb.withColumn("_sum", V.vsum(V.dvec("embedding")))
    look = V.embedding_lookup(tokens, emb, extra=["_sum"])
    return look.groupBy("doc_id").agg(F.count("vec").cast("long").alias("n_hit"),
                                      (F.round(F.sum("_sum"), 4) + F.lit(0.0)).alias("v_sum"))


@query("g2_add_positional", f"""
WITH {_BL}, p AS (SELECT pos, vec AS pv FROM bl WHERE block = 0)
SELECT vec_id, {_chk('list_transform(range(1, len(vec) + 1), lambda i: vec[i] + pv[i])')}
FROM bl JOIN p USING (pos)""")
def g2_add_positional(spark, sf):
    b = _blocks(spark, sf)
    a = V.add_positional(b, b.where(F.col("block") == 0).select("pos", "vec"))
    return a.select("vec_id", *_chk_s(F.col("vec")))


@query("g3_dot_scores", f"""
WITH {_BL}
SELECT a.block, a.pos AS q, b.pos AS k, round(list_dot_product(a.vec, b.vec) / sqrt(len(a.vec)), 5) + 0.0 AS score
FROM bl a JOIN bl b USING (block)""")
def g3_dot_scores(spark, sf):
    s = V.dot_scores(_blocks(spark, sf))
    return s.select("block", "q", "k", (F.round("score", 5) + F.lit(0.0)).alias("score"))


@query("g4_softmax_weights", f"""
WITH {_BL}, {_d_weights('bl', 'block')}
SELECT block, q, k, round(weight, 6) AS weight FROM wt""")
def g4_softmax_weights(spark, sf):
    w = V.softmax_weights(V.dot_scores(_blocks(spark, sf)))
    return w.select("block", "q", "k", F.round("weight", 6).alias("weight"))


@query("g5_weighted_context", f"""
WITH {_BL}, {_d_attention('bl', 'block')}
SELECT block, q, {_chk('ctx')} FROM cx""")
def g5_weighted_context(spark, sf):
    c = V.attention(_blocks(spark, sf))
    return c.select("block", "q", *_chk_s(F.col("ctx")))


@query("g6_causal_attention", f"""
WITH {_BL}, {_d_attention('bl', 'block', 'WHERE b.pos <= a.pos')}
SELECT block, q, {_chk('ctx')} FROM cx""")
def g6_causal_attention(spark, sf):
    c = V.attention(_blocks(spark, sf), causal=True)
    return c.select("block", "q", *_chk_s(F.col("ctx")))


@query("g7_sliding_window_attention", f"""
WITH {_BL}, {_d_attention('bl', 'block', 'WHERE b.pos <= a.pos AND a.pos - b.pos < 4')}
SELECT block, q, {_chk('ctx')} FROM cx""")
def g7_sliding_window_attention(spark, sf):
    c = V.attention(_blocks(spark, sf), window=4)
    return c.select("block", "q", *_chk_s(F.col("ctx")))


_HEADS = """hd AS (SELECT block, pos, h AS head, vec[h * 16 + 1:h * 16 + 16] AS vec
               FROM bl, (SELECT unnest(range(4)) AS h) hh)"""


@query("g8_multi_head", f"""
WITH {_BL}, {_HEADS}, {_d_attention('hd', 'block, head', 'WHERE b.pos <= a.pos')},
cat AS (SELECT block, q, flatten(list(ctx ORDER BY head)) AS ctx FROM cx GROUP BY block, q)
SELECT block, q, {_chk('ctx')} FROM cat""")
def g8_multi_head(spark, sf):
    c = V.multi_head(_blocks(spark, sf), 4, causal=True)
    return c.select("block", "q", *_chk_s(F.col("ctx")))


@query("g8_grouped_kv", f"""
WITH {_BL}, {_HEADS},
kvh AS (SELECT block, pos, head AS g, vec FROM hd WHERE head < 2),
sc AS (SELECT a.block, a.head, a.pos AS q, b.pos AS k,
              list_dot_product(a.vec, b.vec) / sqrt(len(a.vec)) AS score
       FROM hd a JOIN kvh b ON a.block = b.block AND b.g = a.head // 2 WHERE b.pos <= a.pos),
zz AS (SELECT *, exp(score - max(score) OVER (PARTITION BY block, head, q)) AS z FROM sc),
wt AS (SELECT block, head, q, k, z / sum(z) OVER (PARTITION BY block, head, q) AS weight FROM zz),
vx AS (SELECT block, g, pos AS k, unnest(vec) AS x, unnest(range(len(vec))) AS dim FROM kvh),
cd AS (SELECT wt.block, head, q, dim, sum(weight * x) AS c FROM wt JOIN vx
       ON wt.block = vx.block AND vx.g = wt.head // 2 AND vx.k = wt.k GROUP BY wt.block, head, q, dim),
cx AS (SELECT block, head, q, list(c ORDER BY dim) AS ctx FROM cd GROUP BY block, head, q),
cat AS (SELECT block, q, flatten(list(ctx ORDER BY head)) AS ctx FROM cx GROUP BY block, q)
SELECT block, q, {_chk('ctx')} FROM cat""")
def g8_grouped_kv(spark, sf):
    c = V.multi_head(_blocks(spark, sf), 4, kv_groups=2, causal=True)
    return c.select("block", "q", *_chk_s(F.col("ctx")))


@query("g9_pool", f"""
WITH {_BL},
ex AS (SELECT block, unnest(vec) AS x, unnest(range(len(vec))) AS dim FROM bl),
mn AS (SELECT block, list(m ORDER BY dim) AS vec FROM (SELECT block, dim, avg(x) AS m FROM ex GROUP BY block, dim) z GROUP BY block),
fs AS (SELECT block, arg_min(vec, pos) AS vec FROM bl GROUP BY block),
ls AS (SELECT block, arg_max(vec, pos) AS vec FROM bl GROUP BY block)
SELECT block, 'mean' AS how, {_chk('vec')} FROM mn
UNION ALL SELECT block, 'first', {_chk('vec')} FROM fs
UNION ALL SELECT block, 'last', {_chk('vec')} FROM ls""")
def g9_pool(spark, sf):
    b = _blocks(spark, sf)
    out = None
    for how in ("mean", "first", "last"):
        p = V.pool(b, how).select("block", F.lit(how).alias("how"), *_chk_s(F.col("vec")))
        out = p if out is None else out.unionByName(p)
    return out


@query("g10_standardize", f"""
WITH {_BL},
st AS (SELECT vec_id, vec, list_sum(vec) / len(vec) AS mu FROM bl),
sv AS (SELECT vec_id, vec, mu, list_sum(list_transform(vec, lambda x: (x - mu) * (x - mu))) / len(vec) AS var FROM st),
z AS (SELECT vec_id, list_transform(vec, lambda x: (x - mu) / sqrt(var + 1e-5)) AS zv FROM sv)
SELECT vec_id, round(zv[1], 5) + 0.0 AS first, round(list_sum(list_transform(zv, lambda e: e * e)), 5) + 0.0 AS v_sq FROM z""")
def g10_standardize(spark, sf):
    b = V.standardize(_blocks(spark, sf), "vec", "z")
    return b.select("vec_id", (F.round(F.element_at("z", 1), 5) + F.lit(0.0)).alias("first"),
                    (F.round(F.aggregate("z", F.lit(0.0), lambda a, x: a + x * x), 5) + F.lit(0.0)).alias("v_sq"))


# ---------------------------------------------------------------- H shared

_LOG = """lg AS (SELECT user_id AS run, ts, event_id AS step_key, value AS loss,
                 length(props)::BIGINT AS tokens, (ts::DATE - DATE '1970-01-01')::INT AS epoch,
                 event_type, epoch_us(ts) / 1e6 AS sec FROM events),
st AS (SELECT *, (row_number() OVER (PARTITION BY run ORDER BY ts, step_key) - 1)::BIGINT AS step,
              (sum(tokens) OVER (PARTITION BY run ORDER BY ts, step_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS tokens_seen
       FROM lg)"""


def _log(spark, sf):
    e = table(spark, sf, "events")
    return e.select(F.col("user_id").alias("run"), "ts", F.col("event_id").alias("step_key"),
                    F.col("value").alias("loss"), F.length("props").cast("long").alias("tokens"),
                    F.unix_date(F.to_date("ts")).alias("epoch"), "event_type")


def _steps(spark, sf):
    return M.steps(_log(spark, sf))


@query("h2_tokens_seen", f"WITH {_LOG} SELECT run, step_key, step, tokens_seen FROM st")
def h2_tokens_seen(spark, sf):
    return _steps(spark, sf).select("run", "step_key", "step", "tokens_seen")


@query("h1_epoch_rollup", f"""
WITH {_LOG}
SELECT run, epoch, round(arg_max(loss, step), 6) AS last_loss, round(min(loss), 6) AS min_loss,
       round(avg(loss), 6) AS mean_loss, max(tokens_seen) AS tokens_seen, count(*)::BIGINT AS n_steps
FROM st GROUP BY run, epoch""")
def h1_epoch_rollup(spark, sf):
    r = M.epoch_rollup(_steps(spark, sf))
    return r.select("run", "epoch", *[F.round(c, 6).alias(c) for c in ("last_loss", "min_loss", "mean_loss")],
                    "tokens_seen", "n_steps")


@query("h3_eval_points", f"WITH {_LOG} SELECT run, step, tokens_seen FROM st WHERE step % 7 = 0")
def h3_eval_points(spark, sf):
    return M.eval_points(_steps(spark, sf), 7).select("run", "step", "tokens_seen")


@query("h4_eta", f"""
WITH {_LOG},
u AS (SELECT run, epoch, max(sec) AS e, min(sec) AS b FROM lg GROUP BY run, epoch),
d AS (SELECT run, epoch, e, min(b) OVER (PARTITION BY run) AS s,
             row_number() OVER (PARTITION BY run ORDER BY epoch) AS done,
             lag(e) OVER (PARTITION BY run ORDER BY epoch) AS pe, count(*) OVER (PARTITION BY run) AS n FROM u),
r AS (SELECT *, floor((e - s) / done * (n - done)) AS rem FROM d)
SELECT run, epoch, done::BIGINT AS done, round(e - coalesce(pe, s), 3) AS unit_seconds,
       round(e - s, 3) AS elapsed_seconds, rem::BIGINT AS eta_seconds, floor(rem / 3600)::BIGINT AS eta_h,
       floor((rem % 3600) / 60)::BIGINT AS eta_m, (rem % 60)::BIGINT AS eta_s FROM r""")
def h4_eta(spark, sf):
    e = M.eta(_log(spark, sf))
    return e.select("run", "epoch", "done", F.round("unit_seconds", 3).alias("unit_seconds"),
                    F.round("elapsed_seconds", 3).alias("elapsed_seconds"), "eta_seconds",
                    "eta_h", "eta_m", "eta_s")


@query("h5_timing_summary", """
SELECT event_type AS name, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std_sample,
       round(stddev_pop(value), 6) AS std_pop, round(min(value), 6) AS min, round(max(value), 6) AS max,
       round(sum(value), 6) AS total, count(*)::BIGINT AS calls FROM events GROUP BY event_type""")
def h5_timing_summary(spark, sf):
    t = M.timing_summary(table(spark, sf, "events").select(F.col("event_type").alias("name"),
                                                           F.col("value").alias("seconds")))
    return t.select("name", *[F.round(c, 6).alias(c) for c in
                              ("mean", "std_sample", "std_pop", "min", "max", "total")], "calls")


@query("h6_throughput", f"""
WITH {_LOG}
SELECT run, sum(tokens)::BIGINT AS tokens, round(max(sec) - min(sec), 3) AS seconds,
       round(sum(tokens) / (max(sec) - min(sec)), 6) AS tokens_per_second FROM lg GROUP BY run""")
def h6_throughput(spark, sf):
    t = M.throughput(_log(spark, sf))
    return t.select("run", "tokens", F.round("seconds", 3).alias("seconds"),
                    F.round("tokens_per_second", 6).alias("tokens_per_second"))


@query("h7_plateau_stop", f"""
WITH {_LOG},
ev AS (SELECT run, epoch, avg(loss) AS val_loss FROM lg GROUP BY run, epoch),
d AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY epoch) AS i,
             min(val_loss) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bf FROM ev),
m AS (SELECT *, max(CASE WHEN bf IS NULL OR val_loss < bf THEN i END) OVER (PARTITION BY run ORDER BY epoch
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS li FROM d)
SELECT run, min(epoch) AS stop_at FROM m WHERE i - li >= 5 GROUP BY run""")
def h7_plateau_stop(spark, sf):
    ev = _log(spark, sf).groupBy("run", "epoch").agg(F.avg("loss").alias("val_loss"))
    return M.plateau_stop(ev, 5)


@query("h8_smooth_loss", f"""
WITH {_LOG}
SELECT run, step, round(avg(loss) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS smooth_loss
FROM st QUALIFY step >= 4""")
def h8_smooth_loss(spark, sf):
    s = M.smooth_loss(_steps(spark, sf), 5)
    return s.select("run", "step", F.round("smooth_loss", 6).alias("smooth_loss"))
