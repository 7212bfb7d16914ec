"""Registered queries: sequences, splits, batches (D) and instruction data (S).

Token ids are word-vocabulary ids (C2/C3) so that every query has an exact
SQL counterpart.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as X
from ..operators import instruct, sequences as S, words
from ..session import cut_lineage
from .registry import d_word_split, d_word_vocab, query, sq, table


def d_ids(src: str, key: str = "doc_id") -> str:
    """CTEs ``v`` (vocabulary of src) and ``ids(key, ids)`` (ids per row of src)."""
    return f"""v AS ({d_word_vocab(src)}),
e AS (SELECT {key}, unnest(t) AS token, unnest(range(1, len(t) + 1)) AS pos
      FROM (SELECT {key}, {d_word_split('text')} AS t FROM {src}) z),
ids AS (SELECT s.{key}, coalesce(l, []::BIGINT[]) AS ids FROM (SELECT * FROM {src}) s LEFT JOIN (
        SELECT {key}, list(token_id ORDER BY pos) AS l FROM e JOIN v USING (token) GROUP BY {key}) a
        USING ({key}))"""


def word_ids(df, key="doc_id"):
    blocks = words.token_blocks(df, key)
    return words.word_encode(df, words.build_word_vocab(df, blocks=blocks), key=key, blocks=blocks)


def _s(c):
    """Array column rendered as comma-separated text."""
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


def _d(c):
    return f"array_to_string({c}, ',')"


def _doc_ids(spark, sf):
    """Word ids per document, materialised once (a token cache) because the
    sequence jobs read them several times."""
    return cut_lineage(word_ids(table(spark, sf, "documents").select("doc_id", "text")))


# ---------------------------------------------------------------- D2 / D3

_L2, _S2 = 8, 5


@query("d2_sliding_windows", f"""
WITH {d_ids('documents')},
tok AS (SELECT doc_id, unnest(ids) AS t, unnest(range(len(ids))) AS p FROM ids),
g AS (SELECT t, row_number() OVER (ORDER BY doc_id, p) - 1 AS gpos FROM tok),
n AS (SELECT count(*) AS nt FROM g),
w AS (SELECT gpos, list(t) OVER (ORDER BY gpos ROWS BETWEEN CURRENT ROW AND {_L2} FOLLOWING) AS win FROM g)
SELECT (gpos // {_S2})::BIGINT AS seq_id, {_d(f'win[1:{_L2}]')} AS input_ids,
       {_d(f'win[2:{_L2 + 1}]')} AS target_ids
FROM w, n WHERE gpos % {_S2} = 0 AND gpos + {_L2} < n.nt""")
def d2_sliding_windows(spark, sf):
    w = S.sliding_windows(_doc_ids(spark, sf), _L2, _S2)
    return w.select("seq_id", _s("input_ids").alias("input_ids"), _s("target_ids").alias("target_ids"))


_L3, _S3 = 16, 12


@query("d3_windows_per_doc", f"""
WITH {d_ids('documents')}
SELECT doc_id, (i // {_S3})::BIGINT AS win_idx, {_d(f'ids[i + 1:i + {_L3}]')} AS input_ids,
       {_d(f'ids[i + 2:i + {_L3 + 1}]')} AS target_ids
FROM (SELECT doc_id, ids, unnest(range(0, len(ids) - {_L3}, {_S3})) AS i FROM ids WHERE len(ids) > {_L3}) z""")
def d3_windows_per_doc(spark, sf):
    w = S.sliding_windows_per_group(_doc_ids(spark, sf), _L3, _S3)
    return w.select("doc_id", "win_idx", _s("input_ids").alias("input_ids"),
                    _s("target_ids").alias("target_ids"))


# ---------------------------------------------------------------- D4 / D5 / D6


@query("d4_split_by_chars", """
SELECT doc_id, md5(substr(text, 1, k)) AS train_md5, md5(substr(text, k + 1)) AS val_md5,
       k::BIGINT AS train_chars
FROM (SELECT doc_id, text, floor(0.9::DOUBLE * length(text))::INT AS k FROM documents) z""")
def d4_split_by_chars(spark, sf):
    d = S.split_by_chars(table(spark, sf, "documents"), 0.9)
    return d.select("doc_id", F.md5("train_text").alias("train_md5"), F.md5("val_text").alias("val_md5"),
                    F.length("train_text").cast("long").alias("train_chars"))


_L5 = 8


@query("d5_split_by_tokens", f"""
WITH {d_ids('documents')},
tok AS (SELECT doc_id, unnest(ids) AS t, unnest(range(len(ids))) AS p FROM ids),
g AS (SELECT t, row_number() OVER (ORDER BY doc_id, p) - 1 AS gpos FROM tok),
c AS (SELECT floor(0.9::DOUBLE * count(*))::BIGINT AS cut, count(*) AS nt FROM g),
s AS (SELECT t, CASE WHEN gpos < cut THEN 'train' ELSE 'val' END AS split,
             CASE WHEN gpos < cut THEN gpos ELSE gpos - cut END AS rel,
             CASE WHEN gpos < cut THEN cut ELSE nt - cut END AS side_n FROM g, c),
w AS (SELECT split, rel, side_n, list(t) OVER (PARTITION BY split ORDER BY rel
             ROWS BETWEEN CURRENT ROW AND {_L5} FOLLOWING) AS win FROM s)
SELECT split, (rel // {_L5})::BIGINT AS seq_id, {_d(f'win[1:{_L5}]')} AS input_ids,
       {_d(f'win[2:{_L5 + 1}]')} AS target_ids
FROM w WHERE rel % {_L5} = 0 AND rel + {_L5} < side_n""")
def d5_split_by_tokens(spark, sf):
    w = S.split_by_tokens(_doc_ids(spark, sf), 0.9, _L5, _L5)
    return w.select("split", "seq_id", _s("input_ids").alias("input_ids"),
                    _s("target_ids").alias("target_ids"))


@query("d6_split_rows", """
WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS r, count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN r < floor(0.85::DOUBLE * n) THEN 'train'
                    WHEN r < floor(0.85::DOUBLE * n) + floor(0.1::DOUBLE * n) THEN 'test'
                    ELSE 'val' END AS split FROM o""")
def d6_split_rows(spark, sf):
    return S.split_rows(table(spark, sf, "documents").select("doc_id"), (0.85, 0.1)) \
        .select("doc_id", "split")


# ---------------------------------------------------------------- D7 / D8 / D9

_D_SHUF = """
SELECT doc_id, (row_number() OVER (ORDER BY h, doc_id) - 1)::BIGINT AS position, 3 AS epoch
FROM (SELECT doc_id, ('0x' || substr(md5(doc_id::VARCHAR || ':8'), 1, 15))::BIGINT AS h
      FROM documents) z"""


def _shuffled(spark, sf):
    return S.shuffle_epoch(table(spark, sf, "documents").select("doc_id"), seed=5, epoch=3,
                           key="doc_id")


@query("d7_shuffle_epoch", _D_SHUF)
def d7_shuffle_epoch(spark, sf):
    return _shuffled(spark, sf).select("doc_id", "position", F.col("epoch").cast("int"))


@query("d8_batch", f"""
WITH s AS ({_D_SHUF})
SELECT doc_id, position, (position // 32)::BIGINT AS batch_id FROM s
WHERE position < (SELECT (count(*) // 32) * 32 FROM s)""")
def d8_batch(spark, sf):
    return S.batch(_shuffled(spark, sf), 32, drop_last=True).select("doc_id", "position", "batch_id")


@query("d9_shard_ranks", """
WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents),
n AS (SELECT count(*) AS n, (ceil(count(*) / 3) * 3 - count(*))::BIGINT AS pad FROM documents),
u AS (SELECT doc_id, position FROM o
      UNION ALL SELECT doc_id, position + n.n FROM o, n WHERE position < n.pad)
SELECT doc_id, position::BIGINT AS position, (position % 3)::INT AS rank,
       (position // 3)::BIGINT AS local_idx FROM u""")
def d9_shard_ranks(spark, sf):
    from ..operators.order import with_ordinal
    o = with_ordinal(table(spark, sf, "documents").select("doc_id"), "doc_id", name="position")
    return S.shard_ranks(o, 3, drop_last=False).select("doc_id", "position", "rank", "local_idx")


# ---------------------------------------------------------------- D10 - D13


@query("d10_pad_truncate", f"""
WITH {d_ids('documents')}
SELECT doc_id, {_d(f'list_resize(ids[1:64], 64, {fixed.PAD_ID})')} AS ids FROM ids""")
def d10_pad_truncate(spark, sf):
    t = _doc_ids(spark, sf)
    return t.select("doc_id", _s(S.pad_truncate(F.col("ids"), 64)).alias("ids"))


@query("d11_longest_encoded_length", f"""
WITH {d_ids('documents')} SELECT max(len(ids))::BIGINT AS max_length FROM ids""")
def d11_longest_encoded_length(spark, sf):
    return S.longest_encoded_length(_doc_ids(spark, sf))


@query("d11_context_length", f"""
WITH {d_ids('documents')} SELECT option, context_length::BIGINT AS context_length FROM (
  SELECT 'model_context_length' AS option, 1024 AS context_length
  UNION ALL SELECT 'longest_training_example', (SELECT max(len(ids)) FROM ids) UNION ALL SELECT '256', 256) z""")
def d11_context_length(spark, sf):
    ids, rows = _doc_ids(spark, sf), []
    for option in ("model_context_length", "longest_training_example", "256"):
        rows.append(S.context_length(ids, option, 1024).select(F.lit(option).alias("option"), "context_length"))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("d12_context_pairs", f"""
WITH {d_ids('documents')}
SELECT doc_id, i::BIGINT AS context_len, {_d('ids[1:i]')} AS context, ids[i + 1] AS next_id
FROM (SELECT doc_id, ids, unnest(range(1, least(4, len(ids) - 1) + 1)) AS i FROM ids WHERE len(ids) >= 2) z""")
def d12_context_pairs(spark, sf):
    c = S.context_pairs(_doc_ids(spark, sf), 4)
    return c.select("doc_id", "context_len", _s("context").alias("context"),
                    F.col("next_id").cast("long"))


@query("d13_split_token_counts", f"""
WITH {d_ids('documents')},
tok AS (SELECT doc_id, unnest(ids) AS t, unnest(range(len(ids))) AS p FROM ids),
g AS (SELECT row_number() OVER (ORDER BY doc_id, p) - 1 AS gpos FROM tok),
c AS (SELECT floor(0.9::DOUBLE * count(*))::BIGINT AS cut, count(*) AS nt FROM g),
s AS (SELECT split, side_n FROM (VALUES ('train'), ('val')) x(split), c,
      LATERAL (SELECT CASE WHEN split = 'train' THEN cut ELSE nt - cut END AS side_n) y),
k AS (SELECT split, CASE WHEN side_n > {_L5} THEN ((side_n - {_L5} + {_L5} - 1) // {_L5}) ELSE 0 END AS n_seqs FROM s)
SELECT split, n_seqs::BIGINT AS n_seqs, (n_seqs // 4)::BIGINT AS n_batches, (n_seqs * {_L5})::BIGINT AS n_tokens,
       nt * (CASE WHEN split = 'train' THEN 0.9::DOUBLE ELSE 1 - 0.9::DOUBLE END) < {_L5} AS too_small
FROM k, c""")
def d13_split_token_counts(spark, sf):
    ids = _doc_ids(spark, sf)
    total = ids.select(F.sum(F.size("ids"))).scalar()
    return S.split_token_counts(S.split_by_tokens(ids, 0.9, _L5, _L5), 4, _L5, total, 0.9)


# ---------------------------------------------------------------- S


_D_PAIRS = """
SELECT conv_id, turn, text AS instruction, CASE WHEN pr = 'system' THEN pt ELSE '' END AS input,
       nt AS output
FROM (SELECT *, lead(role) OVER w AS nr, lead(text) OVER w AS nt, lag(role) OVER w AS pr,
             lag(text) OVER w AS pt FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) z
WHERE role = 'user' AND nr = 'assistant'"""


@query("s1_pairs_from_conversations", f"""
SELECT conv_id, turn, md5(instruction) AS instruction_md5, md5(input) AS input_md5,
       md5(output) AS output_md5 FROM ({_D_PAIRS}) p""")
def s1_pairs_from_conversations(spark, sf):
    p = instruct.pairs_from_conversations(table(spark, sf, "conversations"))
    return p.select("conv_id", "turn", F.md5("instruction").alias("instruction_md5"),
                    F.md5("input").alias("input_md5"), F.md5("output").alias("output_md5"))


def _d_prompt(full: bool) -> str:
    head = sq(fixed.PROMPT_HEADER + fixed.INSTRUCTION_TAG)
    inp = (f"CASE WHEN length(coalesce(input, '')) > 0 THEN {sq(fixed.INPUT_TAG)} || input "
           f"ELSE '' END")
    resp = f" || {sq(fixed.RESPONSE_TAG)} || coalesce(output, '')" if full else ""
    return f"({head} || instruction || {inp}{resp})"


@query("s2_format_prompt", f"""
SELECT conv_id, turn, md5({_d_prompt(False)}) AS prompt_md5, md5({_d_prompt(True)}) AS full_md5,
       length({_d_prompt(True)})::BIGINT AS n_chars FROM ({_D_PAIRS}) p""")
def s2_format_prompt(spark, sf):
    p = instruct.pairs_from_conversations(table(spark, sf, "conversations"))
    pr = X.format_prompt("instruction", "input")
    full = X.format_prompt("instruction", "input", "output")
    return p.select("conv_id", "turn", F.md5(pr).alias("prompt_md5"), F.md5(full).alias("full_md5"),
                    F.length(full).cast("long").alias("n_chars"))


_SRC_PROMPTS = f"(SELECT conv_id * 4294967296 + turn AS rid, {_d_prompt(True)} AS text FROM ({_D_PAIRS}) p0)"


@query("s3_sft_collate", f"""
WITH {d_ids(_SRC_PROMPTS, key='rid')},
o AS (SELECT rid, ids, (row_number() OVER (ORDER BY rid) - 1) // 4 AS batch_id FROM ids),
m AS (SELECT rid, batch_id, list_resize(list_append(ids, {fixed.PAD_ID}),
             max(len(ids)) OVER (PARTITION BY batch_id) + 1, {fixed.PAD_ID}) AS p FROM o),
t AS (SELECT rid, batch_id, p[1:len(p) - 1] AS inp, p[2:len(p)] AS tgt FROM m)
SELECT rid, batch_id::BIGINT AS batch_id, {_d('inp[1:300]')} AS input_ids,
       {_d(f'list_transform(tgt, lambda x, j: CASE WHEN x = {fixed.PAD_ID} AND j > list_position(tgt, {fixed.PAD_ID}) THEN {fixed.IGNORE_INDEX} ELSE x END)[1:300]')} AS target_ids
FROM t""")
def s3_sft_collate(spark, sf):
    from ..operators.order import with_ordinal
    p = instruct.pairs_from_conversations(table(spark, sf, "conversations"))
    src = p.select((F.shiftleft(F.col("conv_id"), 32) + F.col("turn")).alias("rid"),
                   X.format_prompt("instruction", "input", "output").alias("text"))
    ids = word_ids(src, key="rid")
    o = with_ordinal(ids, "rid", name="position")
    b = S.batch(o, 4)
    c = instruct.sft_collate(b, max_len=300)
    return c.select("rid", "batch_id", _s("input_ids").alias("input_ids"),
                    _s("target_ids").alias("target_ids"))
