"""Registered queries: sources, cleaning and word-level tokenization (A, B, C1-C8, C21-C22)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as X
from ..operators import clean, words
from ..operators.order import global_offsets
from ..sources import readers
from .registry import (chars, d_ascii_ratio, d_collapse, d_strip, d_word_split, d_word_vocab,
                       query, sq, table)

# ---------------------------------------------------------------------------- A


@query("a3_read_parquet", """
SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'en' AND n_chars > 100""")
def a3_read_parquet(spark, sf):
    return readers.read_parquet_dataset(spark, f"{sf}/documents.parquet",
                                        ["doc_id", "lang", "n_chars"]) \
        .where((F.col("lang") == "en") & (F.col("n_chars") > 100))


@query("a4_resolve_text", """
WITH r AS (
  SELECT 0 AS src, doc_id AS rec_id, text, NULL::VARCHAR AS content FROM documents
  UNION ALL SELECT 1, page_id, NULL, html FROM pages),
o AS (SELECT src, rec_id, coalesce(text, content, '') AS t,
             row_number() OVER (ORDER BY src, rec_id) - 1 AS rec_ord FROM r)
SELECT rec_ord::BIGINT AS rec_ord, src, rec_id, length(t)::BIGINT AS n_chars FROM o WHERE length(t) > 0""")
def a4_resolve_text(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.lit(0).alias("src"), F.col("doc_id").alias("rec_id"), "text",
        F.lit(None).cast("string").alias("content"))
    pages = table(spark, sf, "pages").select(
        F.lit(1).alias("src"), F.col("page_id").alias("rec_id"),
        F.lit(None).cast("string").alias("text"), F.col("html").alias("content"))
    out = readers.resolve_text(docs.unionByName(pages), ["text", "content"], ["src", "rec_id"])
    return out.select(F.col("rec_ord").cast("long"), "src", "rec_id",
                      F.length("text").cast("long").alias("n_chars"))


# ---------------------------------------------------------------------------- B

def _with_markers(df):
    """Documents wrapped in book-style header/footer markers, chosen by language."""
    s = fixed.START_MARKERS
    e = fixed.END_MARKERS
    head = (F.when(F.col("lang") == "en", F.lit(f"Title page\n{s[0]} EBOOK ***\n"))
            .when(F.col("lang") == "de", F.lit(f"Notes {s[1]} EBOOK ***\n"))
            .when(F.col("lang") == "fr", F.lit(f"{s[2]} only no newline {s[0]}"))
            .otherwise(F.lit("")))
    tail = (F.when(F.col("lang") == "en", F.lit(f"\n{e[0]} EBOOK ***\nlicense"))
            .when(F.col("lang") == "de", F.lit(f"\n{e[2]}.\n{e[3]}"))
            .otherwise(F.lit("")))
    return df.select("doc_id", "lang", F.concat(head, F.col("text"), tail).alias("text"))


def _d_with_markers() -> str:
    s = fixed.START_MARKERS
    e = fixed.END_MARKERS
    nl = "chr(10)"
    return f"""(SELECT doc_id, lang,
      CASE lang WHEN 'en' THEN {sq('Title page')} || {nl} || {sq(s[0] + ' EBOOK ***')} || {nl}
                WHEN 'de' THEN {sq('Notes ' + s[1] + ' EBOOK ***')} || {nl}
                WHEN 'fr' THEN {sq(s[2] + ' only no newline ' + s[0])} ELSE '' END
      || text ||
      CASE lang WHEN 'en' THEN {nl} || {sq(e[0] + ' EBOOK ***')} || {nl} || 'license'
                WHEN 'de' THEN {nl} || {sq(e[2] + '.')} || {nl} || {sq(e[3])} ELSE '' END AS text
      FROM documents)"""


def _d_strip_boilerplate(t: str) -> str:
    starts = []
    for m in fixed.START_MARKERS:
        p = f"instr({t}, {sq(m)})"
        nl = f"(CASE WHEN {p} > 0 AND instr(substr({t}, {p}), chr(10)) > 0 " \
             f"THEN instr(substr({t}, {p}), chr(10)) + {p} - 1 END)"
        starts.append(f"{nl} + 1")
    start = "coalesce(" + ", ".join(starts) + ", 1)"
    ends = [f"(CASE WHEN instr({t}, {sq(m)}) > 0 THEN instr({t}, {sq(m)}) END)"
            for m in fixed.END_MARKERS]
    end = "coalesce(" + ", ".join(ends) + f", length({t}) + 1)"
    return d_strip(f"substr({t}, {start}, greatest({end} - {start}, 0))")


@query("b1_strip_boilerplate", f"""
SELECT doc_id, length(s)::BIGINT AS n_chars, md5(s) AS md5
FROM (SELECT doc_id, {_d_strip_boilerplate('text')} AS s FROM {_d_with_markers()} m) z""")
def b1_strip_boilerplate(spark, sf):
    d = _with_markers(table(spark, sf, "documents"))
    s = X.strip_boilerplate("text")
    return d.select("doc_id", F.length(s).cast("long").alias("n_chars"), F.md5(s).alias("md5"))


@query("b2_ascii_filter", f"""
SELECT doc_id, round({d_ascii_ratio('text')}, 6) AS ascii_share FROM documents
WHERE {d_ascii_ratio('text')} > 0.9""")
def b2_ascii_filter(spark, sf):
    d = table(spark, sf, "documents")
    return d.where(X.ascii_filter("text", 0.9)).select(
        "doc_id", F.round(X.ascii_ratio("text"), 6).alias("ascii_share"))


@query("b3_collapse_blank_lines", f"""
SELECT doc_id, length(c)::BIGINT AS n_chars, md5(c) AS md5
FROM (SELECT doc_id, {d_collapse('text')} AS c FROM documents) z""")
def b3_collapse_blank_lines(spark, sf):
    c = X.collapse_blank_lines("text")
    return table(spark, sf, "documents").select(
        "doc_id", F.length(c).cast("long").alias("n_chars"), F.md5(c).alias("md5"))


@query("b4_text_sizes", """
SELECT doc_id, octet_length(encode(text))::BIGINT AS n_bytes, length(text)::BIGINT AS n_chars
FROM documents""")
def b4_text_sizes(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", X.byte_length("text").cast("long").alias("n_bytes"),
        X.char_length("text").cast("long").alias("n_chars"))


_SHARD_BYTES = 200_000

_D_SHARDS = f"""
  SELECT doc_id, text, (floor(coalesce(sum(octet_length(encode(text))) OVER
         (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         / {_SHARD_BYTES}) + 1)::BIGINT AS shard_id
  FROM documents"""


@query("b5_join_separator", f"""
WITH s AS ({_D_SHARDS})
SELECT shard_id, count(*)::BIGINT AS n_docs, length(j)::BIGINT AS n_chars, md5(j) AS md5
FROM (SELECT shard_id, count(*) OVER (PARTITION BY shard_id) AS c,
             string_agg(text, {sq(fixed.ENDOFTEXT)} ORDER BY doc_id) OVER (PARTITION BY shard_id) AS j
      FROM s) z GROUP BY shard_id, j""")
def b5_join_separator(spark, sf):
    d = clean.assign_shards(table(spark, sf, "documents"), "text", _SHARD_BYTES)
    g = clean.shard_texts(d, "text")
    return g.select("shard_id", "n_docs", F.length("text").cast("long").alias("n_chars"),
                    F.md5("text").alias("md5"))


@query("b6_assign_shards", f"""
SELECT doc_id, octet_length(encode(text))::BIGINT AS n_bytes, shard_id FROM ({_D_SHARDS}) s""")
def b6_assign_shards(spark, sf):
    d = clean.assign_shards(table(spark, sf, "documents"), "text", _SHARD_BYTES)
    return d.select("doc_id", "n_bytes", "shard_id")


@query("b6_next_fit_shards", f"""
WITH RECURSIVE p AS (
  SELECT doc_id, octet_length(encode(text))::BIGINT AS x, row_number() OVER (ORDER BY doc_id) - 1 AS o,
         coalesce(sum(octet_length(encode(text))) OVER (ORDER BY doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pre
  FROM documents),
n AS (SELECT count(*) AS n FROM p),
nx AS (SELECT a.o, greatest(a.o + 1, (SELECT count(*) FROM p b WHERE b.pre + b.x <= a.pre + {_SHARD_BYTES})) AS nxt
       FROM p a),
ch(o) AS (SELECT 0 UNION ALL SELECT nx.nxt FROM ch JOIN nx ON nx.o = ch.o, n WHERE nx.nxt < n.n)
SELECT p.doc_id, p.x AS n_bytes,
       ((SELECT count(*) FROM ch WHERE ch.o <= p.o)
        + (SELECT CASE WHEN x > {_SHARD_BYTES} THEN 1 ELSE 0 END FROM p WHERE o = 0))::BIGINT AS shard_id
FROM p""")
def b6_next_fit_shards(spark, sf):
    d = clean.next_fit_shards(table(spark, sf, "documents"), "text", _SHARD_BYTES)
    return d.select("doc_id", "n_bytes", "shard_id")


@query("b8_exact_dedup", f"""
SELECT min(doc_id) AS doc_id FROM documents GROUP BY {d_collapse('text')}""")
def b8_exact_dedup(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", X.collapse_blank_lines("text").alias("text"))
    return clean.exact_dedup(d, "text", "doc_id").select("doc_id")


def _word_count_d(x: str) -> str:
    return f"len({d_word_split(x)})"


@query("b10_length_filter", f"""
SELECT doc_id, {_word_count_d('text')}::BIGINT AS n_tokens FROM documents
WHERE {_word_count_d('text')} BETWEEN 10 AND 2048""")
def b10_length_filter(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", X.word_split("text").alias("ids"))
    return clean.length_filter(d, "ids", 10, 2048).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"))


@query("b11_toxicity_filter", """
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def b11_toxicity_filter(spark, sf):
    return clean.toxicity_filter(table(spark, sf, "documents"), table(spark, sf, "labels")) \
        .select("doc_id")


@query("b12_quality_filter", """
SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def b12_quality_filter(spark, sf):
    return clean.quality_filter(table(spark, sf, "documents"), table(spark, sf, "labels")) \
        .select("doc_id")


_MIX = {"en": 0.7, "de": 0.2, "fr": 0.1}


@query("b14_mixture_sample", f"""
WITH w(lang, weight) AS (VALUES {", ".join(f"({sq(k)}, {v}::DOUBLE)" for k, v in _MIX.items())}),
c AS (SELECT lang, count(*)::DOUBLE AS n FROM documents JOIN w USING (lang) GROUP BY lang),
k AS (SELECT min(c.n / w.weight) AS total FROM c JOIN w USING (lang)),
f AS (SELECT lang, least(1.0::DOUBLE, w.weight * k.total / c.n) * 1152921504606846976.0::DOUBLE AS cut
      FROM c JOIN w USING (lang), k)
SELECT d.doc_id, d.lang FROM documents d JOIN f USING (lang)
WHERE ('0x' || substr(md5(d.doc_id::VARCHAR || ':7'), 1, 15))::BIGINT::DOUBLE < f.cut""")
def b14_mixture_sample(spark, sf):
    d = table(spark, sf, "documents")
    return clean.mixture_sample(d, "lang", _MIX, seed=7).select("doc_id", "lang")


@query("b15_split_sentences", f"""
SELECT doc_id, (i - 1)::INT AS sent_idx, length(p[i])::BIGINT AS n_chars
FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM (
      SELECT doc_id, string_split(regexp_replace(text, {sq('([.!?])' + fixed.WS + '+')}, '\\1' || chr(57346), 'g'),
                                  chr(57346)) AS p FROM documents) x) z
WHERE length(p[i]) > 0""")
def b15_split_sentences(spark, sf):
    s = clean.split_sentences(table(spark, sf, "documents"), "text", "doc_id")
    return s.select("doc_id", "sent_idx", F.length("sentence").cast("long").alias("n_chars"))


@query("b7_normalize_unicode", """
SELECT doc_id, length(nfc_normalize(text))::BIGINT AS n_chars, md5(nfc_normalize(text)) AS md5 FROM documents""")
def b7_normalize_unicode(spark, sf):
    d = table(spark, sf, "documents")
    n = clean.normalize_unicode(F.col("text"))
    return d.select("doc_id", F.length(n).cast("long").alias("n_chars"), F.md5(n).alias("md5"))


@query("b9_near_dup_minhash", f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), {sq(fixed.WS + '+')}), lambda x: length(x) > 0) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0) z),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
both_ways AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r(node, label) AS (SELECT doc_id, doc_id FROM documents UNION SELECT b.y, r.label FROM r JOIN both_ways b ON b.x = r.node)
SELECT node AS doc_id, min(label) AS component, min(label) = node AS keep FROM r GROUP BY node""")
def b9_near_dup_minhash(spark, sf):
    return clean.near_dup_minhash(table(spark, sf, "documents"), "text", "doc_id")


@query("b17_augment_word_delete", f"""
SELECT doc_id, md5(array_to_string(list_filter(w, lambda x, i: length(x) > 0 AND
         ('0x' || substr(md5(doc_id::VARCHAR || ':' || (i - 1)::VARCHAR || ':3'), 1, 15))::BIGINT
         >= {int(0.1 * (1 << 60))}), ' ')) AS md5
FROM (SELECT doc_id, regexp_split_to_array(text, {sq(fixed.WS + '+')}) AS w FROM documents) z""")
def b17_augment(spark, sf):
    d = table(spark, sf, "documents")
    return clean.augment_word_delete(d, "text", "doc_id", p=0.1, seed=3).select(
        "doc_id", F.md5("text").alias("md5"))


@query("b17_augment_sentence_shuffle", f"""
SELECT doc_id, md5(array_to_string(list_transform(list_sort(list_transform(
         list_filter(p, lambda x: length(x) > 0),
         lambda x, i: {{'h': ('0x' || substr(md5(doc_id::VARCHAR || ':' || (i - 1)::VARCHAR || ':4'), 1, 15))::BIGINT,
                       's': x}})), lambda z: z.s), ' ')) AS md5
FROM (SELECT doc_id, string_split(regexp_replace(text, {sq('([.!?])' + fixed.WS + '+')}, '\\1' || chr(57346), 'g'),
                                  chr(57346)) AS p FROM documents) z""")
def b17_augment_sentence_shuffle(spark, sf):
    d = table(spark, sf, "documents")
    return clean.augment_sentence_shuffle(d, "text", "doc_id", seed=4).select(
        "doc_id", F.md5("text").alias("md5"))


@query("d1_global_offsets", """
SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS ordinal,
       coalesce(sum(octet_length(encode(text))) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
FROM documents""")
def d1_global_offsets(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.octet_length("text").cast("long").alias("n"))
    return global_offsets(d, "doc_id", "n").select("doc_id", "ordinal", F.col("offset").cast("long"))


# ---------------------------------------------------------------------------- C words


@query("c1_word_split", f"""
SELECT doc_id, len(t)::BIGINT AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, {d_word_split('text')} AS t FROM documents) z""")
def c1_word_split(spark, sf):
    t = X.word_split("text")
    return table(spark, sf, "documents").select(
        "doc_id", F.size(t).cast("long").alias("n_tokens"), F.array_join(t, " ").alias("tokens"))


@query("c2_word_vocab", f"SELECT token, token_id FROM ({d_word_vocab('documents')}) v")
def c2_word_vocab(spark, sf):
    return words.build_word_vocab(table(spark, sf, "documents"))


def _d_encode(vocab_src: str, unk: bool) -> str:
    idexpr = "coalesce(v.token_id, (SELECT token_id FROM v WHERE token = '<|unk|>'))" if unk \
        else "v.token_id"
    return f"""
WITH v AS ({d_word_vocab(vocab_src)}),
e AS (SELECT doc_id, unnest(t) AS token, unnest(range(1, len(t) + 1)) AS pos
      FROM (SELECT doc_id, {d_word_split('text')} AS t FROM documents) z),
j AS (SELECT e.doc_id, e.pos, {idexpr} AS token_id FROM e LEFT JOIN v USING (token))
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_ids, coalesce(ids, '') AS ids
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) AS n, string_agg(token_id::VARCHAR, ',' ORDER BY pos) AS ids
  FROM j GROUP BY doc_id) a USING (doc_id)"""


def _ids_out(df):
    return df.select("doc_id", F.size("ids").cast("long").alias("n_ids"),
                     F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


@query("c3_word_encode", _d_encode("documents", unk=False))
def c3_word_encode(spark, sf):
    d = table(spark, sf, "documents")
    b = words.token_blocks(d)
    return _ids_out(words.word_encode(d, words.build_word_vocab(d, blocks=b), blocks=b))


@query("c4_word_encode_unk", _d_encode("benchmark", unk=True))
def c4_word_encode_unk(spark, sf):
    d = table(spark, sf, "documents")
    v = words.build_word_vocab(table(spark, sf, "benchmark"))
    return _ids_out(words.word_encode(d, v, on_unknown="unk"))


@query("c5_word_decode", f"""
WITH v AS ({d_word_vocab('documents')}),
e AS (SELECT doc_id, unnest(t) AS token, unnest(range(1, len(t) + 1)) AS pos
      FROM (SELECT doc_id, {d_word_split('text')} AS t FROM documents) z)
SELECT d.doc_id, md5(coalesce(regexp_replace(s, {sq(chr(91) + fixed.WS_CHARS + ']+([,.:;?!"()' + "'" + '])')}, '\\1', 'g'), '')) AS md5
FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS s FROM e GROUP BY doc_id) a USING (doc_id)""")
def c5_word_decode(spark, sf):
    d = table(spark, sf, "documents")
    b = words.token_blocks(d)
    v = words.build_word_vocab(d, blocks=b)
    dec = words.word_decode(words.word_encode(d, v, blocks=b), v)
    return dec.select("doc_id", F.md5("text").alias("md5"))


@query("c6_pre_split")
def c6_pre_split(spark, sf):
    d = table(spark, sf, "documents")
    ch = X.pre_split("text", fixed.GPT2_SPLIT_PATTERN)
    ch4 = X.pre_split("text", fixed.GPT4_SPLIT_PATTERN)
    return d.select("doc_id", F.size(ch).cast("long").alias("n_chunks_gpt2"),
                    F.size(ch4).cast("long").alias("n_chunks_gpt4"),
                    (F.array_join(ch, "") == F.col("text")).alias("lossless"))


def _special_text():
    """Document text with special tokens injected between fields."""
    return F.concat(F.col("text"), F.lit(fixed.ENDOFTEXT), F.col("source"),
                    F.lit("<|fim_prefix|>"), F.col("lang"), F.lit(fixed.ENDOFTEXT))


def _d_special_text() -> str:
    return f"(text || {sq(fixed.ENDOFTEXT)} || source || '<|fim_prefix|>' || lang || {sq(fixed.ENDOFTEXT)})"


def _d_split_specials(t: str, specials) -> str:
    mark = "chr(57345)"
    x = t
    for s in sorted(set(specials), key=lambda s: (-len(s), s)):
        x = f"replace({x}, {sq(s)}, {mark} || {sq(s)} || {mark})"
    return f"list_filter(string_split({x}, {mark}), lambda p: length(p) > 0)"


@query("c7_split_specials", f"""
SELECT doc_id, unnest(range(1, len(p) + 1))::BIGINT AS piece_idx, unnest(p) AS piece,
       unnest(list_transform(p, lambda q: q IN ({', '.join(sq(s) for s in fixed.GPT4_SPECIAL_TOKENS)}))) AS is_special
FROM (SELECT doc_id, {_d_split_specials(_d_special_text(), fixed.GPT4_SPECIAL_TOKENS)} AS p FROM documents) z""")
def c7_split_specials(spark, sf):
    d = table(spark, sf, "documents")
    p = X.split_specials(_special_text(), list(fixed.GPT4_SPECIAL_TOKENS))
    return d.select("doc_id", F.posexplode(p).alias("i", "x")).select(
        "doc_id", (F.col("i") + 1).cast("long").alias("piece_idx"),
        F.col("x.s").alias("piece"), F.col("x.is_special").alias("is_special"))


@query("c8_special_counts", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT {sq(s)} AS special, count(*) FILTER (WHERE instr({_d_special_text()}, {sq(s)}) > 0)::BIGINT AS n_docs FROM documents"
    for s in fixed.GPT4_SPECIAL_TOKENS) + ") z")
def c8_special_counts(spark, sf):
    from ..operators import bpe
    d = table(spark, sf, "documents").select(_special_text().alias("text"))
    return bpe.check_specials(d, "text", list(fixed.GPT4_SPECIAL_TOKENS), "all")


@query("c21_corpus_stats", f"""
WITH t AS (SELECT doc_id, text, {d_word_split('text')} AS w FROM documents)
SELECT count(*)::BIGINT AS docs, sum(length(text))::BIGINT AS chars,
       sum(octet_length(encode(text)))::BIGINT AS bytes, sum(len(w))::BIGINT AS tokens,
       (SELECT count(DISTINCT x) FROM (SELECT unnest(w) x FROM t) u)::BIGINT AS distinct_tokens,
       round(sum(len(w)) / sum(length(text)), 6) AS tokens_per_char,
       round(sum(len(w)) / sum(octet_length(encode(text))), 6) AS tokens_per_byte
FROM t""")
def c21_corpus_stats(spark, sf):
    from ..operators import bpe
    d = table(spark, sf, "documents")
    toks = d.select("doc_id", X.word_split("text").alias("ids"))
    return bpe.corpus_stats(d, toks)


@query("c22_token_frequencies", f"""
WITH v AS ({d_word_vocab('documents')}),
e AS (SELECT unnest({d_word_split('text')}) AS token FROM documents)
SELECT v.token_id, count(*)::BIGINT AS n, v.token AS text FROM e JOIN v USING (token)
GROUP BY v.token_id, v.token""")
def c22_token_frequencies(spark, sf):
    d = table(spark, sf, "documents")
    b = words.token_blocks(d)
    v = words.build_word_vocab(d, blocks=b)
    enc = words.word_encode(d, v, blocks=b)
    counts = enc.select(F.explode("ids").alias("token_id")).groupBy("token_id") \
        .agg(F.count(F.lit(1)).alias("n"))
    return counts.join(v, "token_id").select("token_id", "n", F.col("token").alias("text"))
