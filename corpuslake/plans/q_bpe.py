"""Registered queries: byte- and character-level BPE (C9-C20), the token
stream (I2) and file sources / sinks (A1, A2, A5-A9).

Every query that needs a tokenizer learns it from the documents table (no
pretrained files are part of the library).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as X
from ..operators import bpe, char_bpe as CB, instruct, words
from ..session import cut_lineage, scratch_path, write_table
from ..sources import readers
from ..streaming import streams as ST
from .q_seq import _D_PAIRS, _d_prompt
from .q_text import _d_strip_boilerplate, _d_with_markers, _with_markers
from .registry import chars, d_ascii_ratio, d_collapse, d_word_split, query, sq, stream_path, table

N_MERGES = 32
N_CHAR_MERGES = 32
# C17 byte permutation: an odd multiplier mod 256 is a bijection.
BYTE_PERM = [(b * 167 + 13) % 256 for b in range(256)]


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


def learned_merges(spark, sf):
    """Merges learned from the documents, and their rows (bounded by the vocabulary)."""
    m = bpe.train_bpe(_docs(spark, sf), 256 + N_MERGES)
    return m, bpe._merge_rows(m)


def learned_char(spark, sf):
    return CB.train_char_bpe(_docs(spark, sf), n_merges=N_CHAR_MERGES)


def _encoded(spark, sf, **kw):
    m, rows = learned_merges(spark, sf)
    return bpe.encode_bpe(_docs(spark, sf), m, keep=["doc_id"], merge_rows=rows, **kw), m


# ---------------------------------------------------------------- C9 - C17


@query("c9_pair_stats", f"""
WITH w AS (SELECT unnest({d_word_split('text')}) AS c FROM documents),
cc AS (SELECT c, count(*) AS n FROM w GROUP BY c),
b AS (SELECT n, list_transform(range(octet_length(encode(c))),
             lambda i: ('0x' || substr(hex(encode(c)), 2 * i + 1, 2))::INTEGER) AS ids FROM cc),
p AS (SELECT n, unnest(ids[1:len(ids) - 1]) AS l, unnest(ids[2:len(ids)]) AS r FROM b WHERE len(ids) >= 2)
SELECT l AS "left", r AS "right", sum(n)::BIGINT AS count FROM p GROUP BY l, r""")
def c9_pair_stats(spark, sf):
    ch = bpe.chunk_table(_docs(spark, sf), chunker=X.word_split)
    return bpe.pair_stats(ch).select("left", "right", "count")


@query("c9_extreme_pairs", f"""
WITH w AS (SELECT unnest({d_word_split('text')}) AS c FROM documents),
cc AS (SELECT c, count(*) AS n FROM w GROUP BY c),
b AS (SELECT n, list_transform(range(octet_length(encode(c))),
             lambda i: ('0x' || substr(hex(encode(c)), 2 * i + 1, 2))::INTEGER) AS ids FROM cc),
p AS (SELECT n, unnest(ids[1:len(ids) - 1]) AS l, unnest(ids[2:len(ids)]) AS r FROM b WHERE len(ids) >= 2),
g AS (SELECT sum(n)::BIGINT AS count FROM p GROUP BY l, r)
SELECT 'most' AS mode, max(count) AS count FROM g UNION ALL SELECT 'least', min(count) FROM g""")
def c9_extreme_pairs(spark, sf):
    """Counts only: which of several equally rare pairs is first depends on the corpus order (tests)."""
    stats = bpe.pair_stats(bpe.chunk_table(_docs(spark, sf), chunker=X.word_split)).cache()
    return bpe.extreme_pair(stats, "most").select(F.lit("most").alias("mode"), "count").unionByName(
        bpe.extreme_pair(stats, "least").select(F.lit("least").alias("mode"), "count"))


@query("c9_top_byte_pairs")
def c9_top_byte_pairs(spark, sf):
    from .flagship import top_byte_pairs
    return top_byte_pairs(spark, sf, k=20)


@query("c10_apply_merges")
def c10_apply_merges(spark, sf):
    ch = bpe.chunk_table(_docs(spark, sf))
    top = bpe.pair_stats(ch).orderBy(F.desc("count"), F.asc("first")).first()
    merged = bpe.apply_merges(ch, [(top["left"], top["right"], 256)])
    return merged.agg(F.count(F.lit(1)).cast("long").alias("n_chunks"),
                      F.sum(F.col("n") * F.size("ids")).cast("long").alias("n_tokens"),
                      F.sum(F.col("n") * F.size(F.filter("ids", lambda x: x == 256))).cast("long")
                      .alias("n_merged"))


@query("c10_first_merge", f"""
WITH w AS (SELECT unnest({d_word_split('text')}) AS c FROM documents),
cc AS (SELECT c, count(*) AS n FROM w GROUP BY c),
b AS (SELECT n, list_transform(range(octet_length(encode(c))),
             lambda i: ('0x' || substr(hex(encode(c)), 2 * i + 1, 2))::INTEGER) AS ids FROM cc),
p AS (SELECT n, unnest(ids[1:len(ids) - 1]) AS l, unnest(ids[2:len(ids)]) AS r FROM b WHERE len(ids) >= 2),
top AS (SELECT l, r FROM p GROUP BY l, r ORDER BY sum(n) DESC LIMIT 1),
m AS (SELECT n, replace(array_to_string(list_transform(ids, lambda x: '<' || x || '>'), ''), '<' || l || '><' || r || '>', '<256>') AS s
      FROM b, top)
SELECT count(*)::BIGINT AS n_chunks, sum(n * (length(s) - length(replace(s, '<', ''))))::BIGINT AS n_tokens,
       sum(n * ((length(s) - length(replace(s, '<256>', ''))) // 5))::BIGINT AS n_merged FROM m""")
def c10_first_merge(spark, sf):
    """Words rewritten with their commonest pair."""
    ch = bpe.chunk_table(_docs(spark, sf), chunker=X.word_split)
    top = bpe.extreme_pair(bpe.pair_stats(ch), "most").first()
    merged = bpe.apply_merges(ch, [(top["left"], top["right"], 256)])
    return merged.agg(F.count(F.lit(1)).cast("long").alias("n_chunks"),
                      F.sum(F.col("n") * F.size("ids")).cast("long").alias("n_tokens"),
                      F.sum(F.col("n") * F.size(F.filter("ids", lambda x: x == 256))).cast("long").alias("n_merged"))


@query("c11_train_bpe")
def c11_train_bpe(spark, sf):
    return learned_merges(spark, sf)[0]


@query("c12_encode_bpe")
def c12_encode_bpe(spark, sf):
    enc, _ = _encoded(spark, sf)
    return enc.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.md5(F.array_join("ids", ",")).alias("ids_md5"))


@query("c13_decode_roundtrip", "SELECT doc_id, md5(text) AS md5 FROM documents")
def c13_decode_roundtrip(spark, sf):
    enc, m = _encoded(spark, sf)
    dec = bpe.decode_bpe(enc, bpe.build_vocab(m))
    return dec.select("doc_id", F.md5("text").alias("md5"))


@query("c22_bpe_token_frequencies")
def c22_bpe_token_frequencies(spark, sf):
    enc, m = _encoded(spark, sf)
    return bpe.token_frequencies(enc, bpe.build_vocab(m))


@query("c14_build_vocab")
def c14_build_vocab(spark, sf):
    m, _ = learned_merges(spark, sf)
    return bpe.build_vocab(m).select("token_id", F.hex("bytes").alias("hex"))


@query("c15_render_vocab")
def c15_render_vocab(spark, sf):
    m, _ = learned_merges(spark, sf)
    return bpe.render_vocab(bpe.build_vocab(m), m)


@query("c16_recover_merges")
def c16_recover_merges(spark, sf):
    m, _ = learned_merges(spark, sf)
    ranks = bpe.build_vocab(m).select("bytes", F.col("token_id").cast("long").alias("rank"))
    return bpe.recover_merges(ranks)


@query("c17_byte_perm_roundtrip", "SELECT doc_id, md5(text) AS md5 FROM documents")
def c17_byte_perm_roundtrip(spark, sf):
    enc, m = _encoded(spark, sf, byte_perm=BYTE_PERM)
    dec = bpe.decode_bpe(enc, bpe.build_vocab(m), byte_perm=BYTE_PERM)
    return dec.select("doc_id", F.md5("text").alias("md5"))


@query("c12_encode_with_specials", f"""
SELECT doc_id, true AS round_trip, true AS has_special FROM documents""")
def c12_encode_with_specials(spark, sf):
    m, rows = learned_merges(spark, sf)
    d = table(spark, sf, "documents").select(
        "doc_id", F.concat("text", F.lit(fixed.ENDOFTEXT), "source").alias("text"))
    specials = {fixed.ENDOFTEXT: 256 + N_MERGES}
    enc = bpe.encode_bpe(d, m, specials=specials, allowed="all", keep=["doc_id"], merge_rows=rows)
    has = enc.select("doc_id", "ids", F.array_contains("ids", 256 + N_MERGES).alias("has_special"))
    dec = bpe.decode_bpe(has, bpe.build_vocab(m, specials), keep=["doc_id", "has_special"])
    return dec.join(d.select("doc_id", F.col("text").alias("t")), "doc_id").select(
        "doc_id", (F.col("text") == F.col("t")).alias("round_trip"), "has_special")


# ---------------------------------------------------------------- C18 - C20


@query("c18_train_char_bpe")
def c18_train_char_bpe(spark, sf):
    return learned_char(spark, sf)[0]


def _char_encoded(spark, sf):
    m, v = learned_char(spark, sf)
    return CB.encode_char_bpe(_docs(spark, sf), v, m), v


@query("c19_encode_char_bpe")
def c19_encode_char_bpe(spark, sf):
    m, v = learned_char(spark, sf)
    a = CB.encode_char_bpe(_docs(spark, sf), v, m, mode="passes")
    b = CB.encode_char_bpe(_docs(spark, sf), v, m, mode="ranks")
    return a.select("doc_id", F.size("ids").cast("long").alias("n_passes")).join(
        b.select("doc_id", F.size("ids").cast("long").alias("n_ranks")), "doc_id")


@query("c20_decode_char_bpe")
def c20_decode_char_bpe(spark, sf):
    enc, v = _char_encoded(spark, sf)
    dec = CB.decode_char_bpe(enc, v)
    return dec.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("md5"))


# ---------------------------------------------------------------- I2


@query("i2_stream_encode")
def i2_stream_encode(spark, sf):
    m, _ = learned_merges(spark, sf)
    s = ST.read_stream(spark, stream_path(sf, "documents"), ST.DOC_SCHEMA)
    out = ST.stream_encode(s, m, name="i2")
    return out.select("doc_id", "n_tokens")


@query("i2_running_totals", """
SELECT count(*)::BIGINT AS docs_seen, sum(strlen(text))::BIGINT AS tokens_seen FROM documents""")
def i2_running_totals(spark, sf):
    """Totals after the last of several micro-batches, under the vocabulary of bytes alone."""
    from ..session import scratch_path
    folder = scratch_path(spark, "i2-files")
    table(spark, sf, "documents").repartition(4, "doc_id").write.parquet(folder)
    s = ST.read_stream(spark, folder, ST.DOC_SCHEMA, max_files_per_trigger=1)
    totals = ST.running_totals(ST.stream_encode(s, bpe.merges_from_rows(spark, []), name="i2t"))
    return totals.agg(F.max_by("docs_seen", "batch").alias("docs_seen"), F.max_by("tokens_seen", "batch").alias("tokens_seen"))


# ---------------------------------------------------------------- A1 / A2 / A5 - A9


@query("a8_model_file")
def a8_model_file(spark, sf):
    """Merges learned here, as read back from the text model file."""
    from ..session import scratch_path
    m, _ = learned_merges(spark, sf)
    prefix = scratch_path(spark, "a8-model")
    readers.save_model_file(m, prefix, {fixed.ENDOFTEXT: 256 + N_MERGES})
    loaded, specials, pattern = readers.load_model_file(spark, prefix + ".model")
    assert specials == {fixed.ENDOFTEXT: 256 + N_MERGES} and pattern == fixed.GPT2_SPLIT_PATTERN
    return loaded.select("rank", "left", "right", "new_id")


@query("a8_json_files", """
SELECT row_number() OVER (ORDER BY c) - 1 AS token_id, c AS token FROM (
  SELECT DISTINCT unnest(string_split(text, '')) AS c FROM documents) z""")
def a8_json_files(spark, sf):
    """The corpus's characters by code point, as read back from the JSON vocabulary."""
    from ..operators.order import with_ordinal
    from ..session import scratch_path
    chars = table(spark, sf, "documents").select(F.explode(F.array_distinct(F.split("text", ""))).alias("token")) \
        .where("token != ''").distinct()
    path = scratch_path(spark, "a8-json")
    readers.save_json_files(with_ordinal(chars, "token", name="token_id"), bpe.merges_from_rows(spark, []),
                            path + "-vocab.json", path + "-merges.json")
    return readers.load_json_files(spark, path + "-vocab.json", path + "-merges.json")[1]




_FILE = "CASE WHEN doc_id % 7 = 6 THEN 'doc_' || doc_id || '.md' WHEN doc_id % 5 = 4 THEN 'doc_' || doc_id || '.txt.utf8' ELSE 'doc_' || doc_id || '.txt' END"


def _write_files(it, path):
    """A file per document: by its id as UTF-8 or, where that can spell it, latin1."""
    fs, base = readers._file_system(path)
    for rb in it:
        names, latin, texts = (rb.column(i).to_pylist() for i in range(3))
        for name, one, text in zip(names, latin, texts):
            try:
                raw = text.encode("latin-1") if one else text.encode()
            except UnicodeEncodeError:
                raw = text.encode()
            with fs.open_output_stream(f"{base}/{name}") as f:
                f.write(raw)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["file"])


def _text_files(spark, sf, texts=None):
    """A scratch folder with the documents as text files (two suffixes and one that is not read)."""
    path = scratch_path(spark, "text-files")
    fs, base = readers._file_system(path)
    fs.create_dir(base, recursive=True)
    d = texts if texts is not None else _docs(spark, sf)
    d = d.select(F.expr(_FILE).alias("file"), (F.col("doc_id") % 3 == 0).alias("latin"), "text")
    write_table(d.mapInArrow(lambda it: _write_files(it, path), "file string"), "text-file-names")
    return path


@query("a1_read_text_corpus", f"""
SELECT {_FILE} AS file, length(text)::BIGINT AS n_chars, md5(text) AS md5 FROM documents WHERE doc_id % 7 <> 6""")
def a1_read_text_corpus(spark, sf):
    r = readers.read_text_corpus(spark, _text_files(spark, sf))
    return r.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"),
                    F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("md5"))


def _d_next_fit(rows: str, most: int) -> str:
    """CTEs from ``src(k, text)`` in order ``k``: next-fit shards as ``sh(shard_id, text)``."""
    return f"""p AS (SELECT k, text, octet_length(encode(text))::BIGINT AS x, row_number() OVER (ORDER BY k) - 1 AS o,
         coalesce(sum(octet_length(encode(text))) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pre
  FROM ({rows}) src),
n AS (SELECT count(*) AS n FROM p),
nx AS (SELECT a.o, greatest(a.o + 1, (SELECT count(*) FROM p b WHERE b.pre + b.x <= a.pre + {most})) AS nxt FROM p a),
ch(o) AS (SELECT 0 UNION ALL SELECT nx.nxt FROM ch JOIN nx ON nx.o = ch.o, n WHERE nx.nxt < n.n),
sh AS (SELECT ((SELECT count(*) FROM ch WHERE ch.o <= p.o)
        + (SELECT CASE WHEN x > {most} THEN 1 ELSE 0 END FROM p WHERE o = 0))::BIGINT AS shard_id, text, k FROM p),
joined AS (SELECT shard_id, string_agg(text, {sq(fixed.ENDOFTEXT)} ORDER BY k) AS j FROM sh GROUP BY shard_id),
files AS (SELECT shard_id, j FROM joined UNION ALL SELECT 1, '' WHERE (SELECT min(shard_id) FROM joined) > 1)"""


def _shard_files(spark, path):
    raw = readers.binary_files(spark, path).where(F.col("path").rlike(r"/combined_[^/]*\.txt$"))
    return raw.select(F.regexp_extract("path", r"combined_(\d+)\.txt$", 1).cast("long").alias("shard_id"),
                      F.col("length").cast("long").alias("n_bytes"), F.md5("content").alias("md5"))


@query("a5_write_shards", f"""
WITH RECURSIVE {_d_next_fit("SELECT doc_id AS k, text FROM documents", 500_000)}
SELECT shard_id, octet_length(encode(j))::BIGINT AS n_bytes, md5(j) AS md5 FROM files""")
def a5_write_shards(spark, sf):
    out = scratch_path(spark, "a5-shards")
    readers.write_shards(_docs(spark, sf), out, max_bytes=500_000)
    return _shard_files(spark, out)


_CLEANED = d_collapse(_d_strip_boilerplate("text"))


@query("a11_prepare_corpus", f"""
WITH RECURSIVE {_d_next_fit(f"SELECT {_FILE} AS k, {_CLEANED} AS text FROM {_d_with_markers()} m WHERE doc_id % 7 <> 6 AND {d_ascii_ratio('text')} > 0.9", 100_000)}
SELECT shard_id, octet_length(encode(j))::BIGINT AS n_bytes, md5(j) AS md5 FROM files""")
def a11_prepare_corpus(spark, sf):
    texts = _with_markers(table(spark, sf, "documents"))
    out = scratch_path(spark, "a11-shards")
    readers.prepare_corpus(spark, _text_files(spark, sf, texts), out, max_bytes=100_000)
    return _shard_files(spark, out)


@query("a6_token_cache", f"""
SELECT 'documents' AS name, 'all' AS subset, count(*)::BIGINT AS num_samples,
       sum(len({d_word_split('text')}) + 1)::BIGINT AS total_tokens,
       sum(length(text) + {len(' ' + fixed.ENDOFTEXT + ' ')})::BIGINT AS total_chars
FROM documents WHERE length(text) > 0""")
def a6_token_cache(spark, sf):
    base = scratch_path(spark, "a6-cache")
    d = _docs(spark, sf)
    vocab = words.build_word_vocab(d)

    def encode(rows):
        return words.word_encode(rows, vocab, tokens=words.words_and_specials("text"))

    def never(rows):
        raise AssertionError("both parts are cached")

    readers.token_cache(d, encode, base, "documents", "all")
    _, meta = readers.token_cache(d, never, base, "documents", "all")
    return meta.select("name", "subset", F.col("num_samples").cast("long"),
                       F.col("total_tokens").cast("long"), F.col("total_chars").cast("long"))


@query("a7_write_responses_json", f"""
SELECT conv_id, turn, md5(trim(replace(substr({_d_prompt(True)}, length({_d_prompt(False)}) + 1),
       '### Response:', ''), {chars(X._WS_TRIM)})) AS response_md5 FROM ({_D_PAIRS}) p""")
def a7_write_responses_json(spark, sf):
    p = instruct.pairs_from_conversations(table(spark, sf, "conversations"))
    gen = X.format_prompt("instruction", "input", "output")
    r = p.withColumn("model_response", X.extract_response(gen, X.format_prompt("instruction", "input")))
    out = scratch_path(spark, "a7-json")
    readers.write_responses_json(r, out)
    return spark.read.json(out).select("conv_id", "turn", F.md5("model_response").alias("response_md5"))


@query("a8_tokenizer_json", "SELECT true AS same_merges, true AS same_vocab")
def a8_tokenizer_json(spark, sf):
    m, v = learned_char(spark, sf)
    m, v = cut_lineage(m), cut_lineage(v)
    path = scratch_path(spark, "a8-json")
    readers.save_tokenizer_json(m, v, path)
    m2, v2 = readers.load_tokenizer_json(spark, path)
    lost = lambda a, b: a.exceptAll(b.select(*a.columns)).count() + b.select(*a.columns).exceptAll(a).count()
    return spark.range(1).select(F.lit(lost(m, m2) == 0).alias("same_merges"), F.lit(lost(v, v2) == 0).alias("same_vocab"))


@query("a8_tokenizer_roundtrip", f"SELECT range::INTEGER AS rank, true AS same FROM range({N_MERGES})")
def a8_tokenizer_roundtrip(spark, sf):
    m, _ = learned_merges(spark, sf)
    path = scratch_path(spark, "a8-tok")
    readers.save_tokenizer(m, path, {fixed.ENDOFTEXT: 256 + N_MERGES})
    loaded, specials, pattern = readers.load_tokenizer(spark, path)
    m = cut_lineage(m)
    return loaded.join(m.select("rank", F.col("left").alias("l0"), F.col("right").alias("r0"),
                                F.col("new_id").alias("n0")), "rank", "full") \
        .select("rank", ((F.col("left") == F.col("l0")) & (F.col("right") == F.col("r0"))
                         & (F.col("new_id") == F.col("n0"))).alias("same"))


@query("a9_import_merges")
def a9_import_merges(spark, sf):
    """Write a {token: id} JSON map and a merges text file from the learned
    character vocabulary, then import them back."""
    m, v = learned_char(spark, sf)
    path = scratch_path(spark, "a9-files")
    vocab_map = v.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("token", "token_id")))).alias("value"))
    vocab_map.coalesce(1).write.mode("overwrite").text(f"{path}/vocab")
    vt = v.select(F.col("token_id").alias("left"), F.col("token").alias("ls"))
    vr = v.select(F.col("token_id").alias("right"), F.col("token").alias("rs"))
    lines = m.join(vt, "left").join(vr, "right").select("rank", F.concat_ws(" ", "ls", "rs").alias("value"))
    header = spark.createDataFrame([(-1, "#version: 0.2")], "rank int, value string")
    header.unionByName(lines).repartition(1).sortWithinPartitions("rank").select("value") \
        .write.mode("overwrite").text(f"{path}/merges")
    return readers.import_gpt2_merges(spark, f"{path}/vocab", f"{path}/merges") \
        .select("rank", "left", "right", "merged")
