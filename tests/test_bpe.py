"""BPE jobs equal small sequential implementations of our own."""

import pytest
import regex
from pyspark.sql import functions as F

from corpuslake.functions import fixed
from corpuslake.operators import bpe, char_bpe as CB
from conftest import SF001
from seq_ref import seq_char_train, seq_encode, seq_train


def _docs(spark, n=25):
    d = spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").limit(n)
    return d.select("doc_id", "text").cache()


def test_train_equals_sequential_and_batched_equals_unbatched(spark):
    d = _docs(spark)
    texts = [r.text for r in d.orderBy("doc_id").collect()]
    exp = seq_train(texts, 256 + 60, fixed.GPT2_SPLIT_PATTERN)
    got = [(r.left, r.right, r.new_id) for r in bpe.train_bpe(d, 256 + 60).orderBy("rank").collect()]
    assert got == exp
    got1 = [(r.left, r.right, r.new_id) for r in
            bpe.train_bpe(d, 256 + 60, batch=False).orderBy("rank").collect()]
    assert got1 == exp


def test_train_reads_only_what_changes_and_breaks_ties_in_corpus_order(spark):
    """Few fetched pairs and many ties; chunks too long for a posting; up to the last pair."""
    from corpuslake.operators.bpe_train import LONG, train_incremental
    rnd = __import__("random").Random(4)
    texts = [" ".join("".join(rnd.choices("abcde", k=rnd.choice([1, 2, 4]))) for _ in range(12)) for _ in range(6)]
    texts += ["xyz" * LONG + " " + "x" * (3 * LONG), "ab" * LONG, "zzz zzzz zzzzz"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for n, top_k in ((8, 2), (16, 64)):
        trace = []
        got = bpe.train_bpe(d, 256 + n, top_k=top_k, trace=trace).orderBy("rank").collect()
        assert [(r.left, r.right, r.new_id) for r in got] == seq_train(texts, 256 + n, fixed.GPT2_SPLIT_PATTERN)
    chunks = bpe.chunk_table(d).select("n", "f_doc", "f_idx", "ids").cache()
    assert sum(t["rows_read"] for t in trace) < len(trace) * chunks.count() / 2
    few = bpe.chunk_table(spark.createDataFrame([(0, "abab ab"), (1, "zzzz")], d.schema)).select("n", "f_doc", "f_idx", "ids")
    every = train_incremental(few, 10_000, empty_error=False, top_k=2)      # until no pair is left
    assert len(every) > 2 and every == seq_train(["abab ab", "zzzz"], 256 + len(every), fixed.GPT2_SPLIT_PATTERN)
    with pytest.raises(ValueError, match="no pairs left"):
        train_incremental(few, len(every) + 1)


def test_train_gpt4_pattern(spark):
    d = _docs(spark, 10)
    texts = [r.text for r in d.orderBy("doc_id").collect()]
    exp = seq_train(texts, 256 + 30, fixed.GPT4_SPLIT_PATTERN)
    got = bpe.train_bpe(d, 256 + 30, pattern=fixed.GPT4_SPLIT_PATTERN)
    assert [(r.left, r.right, r.new_id) for r in got.orderBy("rank").collect()] == exp


def test_encode_decode_and_partitioning(spark):
    d = _docs(spark)
    m = bpe.train_bpe(d, 256 + 40)
    rows = bpe._merge_rows(m)
    exp = {r.doc_id: seq_encode(r.text, rows, fixed.GPT2_SPLIT_PATTERN) for r in d.collect()}
    vocab = bpe.build_vocab(m)
    for parts in (1, 4, 32):
        enc = bpe.encode_bpe(d.repartition(parts), m, keep=["doc_id"], merge_rows=rows)
        got = {r.doc_id: list(r.ids) for r in enc.collect()}
        assert got == exp
    dec = bpe.decode_bpe(enc, vocab)
    texts = {r.doc_id: r.text for r in d.collect()}
    assert all(texts[r.doc_id] == r.text for r in dec.collect())


def test_decode_invalid_utf8_is_replaced(spark):
    m = bpe.merges_from_rows(spark, [])
    vocab = bpe.build_vocab(m)
    df = spark.createDataFrame([(1, [0x61, 0xE2, 0x82]), (2, [0xFF, 0x62])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in bpe.decode_bpe(df, vocab).collect()}
    assert got == {1: bytes([0x61, 0xE2, 0x82]).decode("utf-8", "replace"),
                   2: bytes([0xFF, 0x62]).decode("utf-8", "replace")}


def test_pre_split_matches_regex_module(spark):
    samples = ["Hello world!!  it's 12345 ok\n\n  x", "a  b   c\r\nd", "", " ",
               "emoji 😀 é tabs\t\tend  ", "I'LL we've THEY'RE"]
    df = spark.createDataFrame([(s,) for s in samples], "text string")
    for pat in (fixed.GPT2_SPLIT_PATTERN, fixed.GPT4_SPLIT_PATTERN):
        from corpuslake.functions.text import pre_split
        got = [r.c for r in df.select(pre_split("text", pat).alias("c")).collect()]
        assert got == [regex.findall(pat, s) for s in samples]


def test_byte_perm_roundtrip(spark):
    d = _docs(spark, 8)
    m = bpe.train_bpe(d, 256 + 10)
    perm = [(b * 167 + 13) % 256 for b in range(256)]
    enc = bpe.encode_bpe(d, m, keep=["doc_id"], byte_perm=perm)
    dec = bpe.decode_bpe(enc, bpe.build_vocab(m), byte_perm=perm)
    texts = {r.doc_id: r.text for r in d.collect()}
    assert all(texts[r.doc_id] == r.text for r in dec.collect())


def test_recover_merges_equals_training(spark):
    d = _docs(spark, 10)
    m = bpe.train_bpe(d, 256 + 20)
    ranks = bpe.build_vocab(m).select("bytes", F.col("token_id").cast("long").alias("rank"))
    got = sorted((r.rank, r.left, r.right) for r in bpe.recover_merges(ranks).collect())
    assert got == sorted((r.new_id, r.left, r.right) for r in m.collect())


def test_render_vocab_escapes_controls(spark):
    m = bpe.merges_from_rows(spark, [(10, 10, 256)])
    lines = {r.token_id: r.line for r in bpe.render_vocab(bpe.build_vocab(m), m).collect()}
    assert lines[97] == "[a] 97"
    assert lines[256] == "[\\u000a][\\u000a] -> [\\u000a\\u000a] 256"


def test_char_bpe_equals_sequential(spark):
    d = spark.read.parquet(f"{SF001}/documents.parquet").where("doc_id = 5").select("doc_id", "text")
    text = d.first().text
    m, v = CB.train_char_bpe(d, 256 + 60)
    exp, vocab = seq_char_train(text, 256 + 60)
    assert [(r.left, r.right, r.new_id) for r in m.orderBy("rank").collect()] == exp
    assert {r.token_id: r.token for r in v.collect()} == vocab


def test_char_tokens_rules(spark):
    cases = {"a  b\r\nc \tx  ": ["a", "Ġb", "Ġ", "\r", "\n", "c", "Ġx", "Ġ", "Ġ"],
             "a  \t b": ["a", "Ġb", "Ġ", "Ġ"], "a  \n b": ["a", "Ġ", "Ġ", "\n", "Ġb"], "\t": [], "": [],
             "x<|endoftext|> y": ["x", "<|endoftext|>", "Ġy"], "a\u00a0b": ["a", "b"]}
    df = spark.createDataFrame([(t,) for t in cases], "text string")
    got = {r.text: [t for c in r.c for t in ([c] if c.startswith("<|") else CB.chunk_tokens(c))]
           for r in df.select("text", CB.glyph_chunks(F.col("text"), [fixed.ENDOFTEXT]).alias("c")).collect()}
    assert got == cases


def test_char_special_not_allowed_raises(spark):
    df = spark.createDataFrame([(1, "a<|endoftext|>")], "doc_id long, text string")
    vocab = spark.createDataFrame([(0, "a"), (1, "<|endoftext|>")], "token_id long, token string")
    m = bpe.merges_from_rows(spark, [])
    assert CB.encode_char_bpe(df, vocab, m).first().ids == [0, 1]
    with pytest.raises(Exception, match="not allowed"):
        CB.encode_char_bpe(df, vocab, m, allowed_special=()).collect()
    with pytest.raises(Exception, match="no merge of two earlier"):
        bpe.recover_merges(spark.createDataFrame([(b"a", 0), (b"b", 1), (b"aba", 2)], "bytes binary, rank long")).collect()


def _batch(rng, rows, few_docs):
    import numpy as np
    import pyarrow as pa
    ids = [rng.integers(0, 5, int(rng.integers(0, 12))).tolist() for _ in range(rows)]
    return pa.RecordBatch.from_arrays(
        [pa.array(rng.integers(1, 9, rows)), pa.array(rng.integers(0, 4 if few_docs else 10 ** 6, rows)),
         pa.array(rng.integers(0, 3, rows).astype(np.int32)), pa.array(ids, pa.list_(pa.int32()))],
        names=["n", "f_doc", "f_idx", "ids"])


def test_pair_partials_equal_a_plain_count():
    import numpy as np

    from corpuslake.operators import bpe
    rng = np.random.default_rng(3)
    for trial in range(60):
        rb = _batch(rng, 8, trial % 2 == 0)             # rows that share a place, and none
        want = {}
        for r in rb.to_pylist():
            for i, pair in enumerate(zip(r["ids"], r["ids"][1:])):
                n, first = want.get(pair, (0, (10 ** 9, 0, 0)))
                want[pair] = (n + r["n"], min(first, (r["f_doc"], r["f_idx"], i)))
        got = {(r["left"], r["right"]): (r["count"], (r["f_doc"], r["f_idx"], r["f_pair"]))
               for part in bpe._partial_pairs(iter([rb])) for r in part.to_pylist()}
        assert got == want


def test_encode_and_decode_work_on_bounded_parts_of_a_batch(monkeypatch):
    import pyarrow as pa

    from corpuslake.functions import bpe_kernels as K
    from corpuslake.operators import bpe
    rules, vocab = [(97, 98, 256)], [(i, bytes([i])) for i in range(256)] + [(256, b"ab")]
    chunks = [["ab", " cab"], [], None, ["xy" * 40], [" ab"] * 7] * 5
    rb = pa.RecordBatch.from_arrays([pa.array(range(25)), pa.array(chunks, pa.list_(pa.string()))],
                                    names=["doc_id", "_chunks"])
    whole = [r for p in bpe._encode_batches(iter([rb]), rules, {}, "_chunks", ["doc_id"], "ids") for r in p.to_pylist()]
    slices = K.slices
    monkeypatch.setattr(K, "slices", lambda it, col: slices(it, col, 30))
    parts = list(bpe._encode_batches(iter([rb]), rules, {}, "_chunks", ["doc_id"], "ids"))
    assert [r for p in parts for r in p.to_pylist()] == whole and [r["doc_id"] for r in whole] == list(range(25))
    assert all(p.num_rows == 1 or len(p.column("ids").flatten()) <= 30 for p in parts)
    back = [r for p in bpe._decode_batches(iter(parts), vocab, "ids", ["doc_id"], "t") for r in p.to_pylist()]
    assert [r["t"].decode() for r in back] == ["".join(c or []) for c in chunks]


def test_character_ids_come_in_bounded_parts(monkeypatch):
    import pyarrow as pa

    from corpuslake.functions import bpe_kernels as K
    rb = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["abca", None, "", "c" * 20, "ab", "ba"])], names=["n", "_g"])
    slices = K.slices
    monkeypatch.setattr(K, "slices", lambda it, col: slices(it, col, 5))
    parts = list(CB._doc_ids_batches(iter([rb]), [(0, "a"), (1, "b"), (2, "c")], ["n"]))
    assert [r["ids"] for p in parts for r in p.to_pylist()] == [[0, 1, 2, 0], [], [], [2] * 20, [0, 1], [1, 0]]
    assert all(p.num_rows == 1 or len(p.column("ids").flatten()) <= 5 for p in parts)


def test_both_character_modes_share_one_training(spark, tmp_path, monkeypatch):
    from corpuslake.plans import q_bpe
    spark.createDataFrame([(1, "a cat sat"), (2, "")], "doc_id long, text string").coalesce(1) \
        .write.parquet(str(tmp_path / "documents.parquet"))
    calls, train = [], CB.train_char_bpe
    monkeypatch.setattr(q_bpe, "N_CHAR_MERGES", 2)
    monkeypatch.setattr(CB, "train_char_bpe", lambda *a, **kw: calls.append(1) or train(*a, **kw))
    assert sorted(r.doc_id for r in q_bpe.c19_encode_char_bpe(spark, str(tmp_path)).collect()) == [1, 2]
    assert len(calls) == 1


def _char_docs():
    import random
    rng = random.Random(5)
    words = ["".join(rng.choices("aabcdeé𝄞", k=rng.randint(1, 6))) for _ in range(40)]
    return [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(120)] + [(200, None), (201, ""), (202, "aaaaa aaaa")]


def _plain_char_train(rows, base, n_merges):
    """One merge at a time over all rows by key; counts overlap in runs, ties go to the pair met first."""
    docs = [[base[c] for c in ("" if t[:1] == " " else t[:1]) + t[1:].replace(" ", "\u0120")] for _, t in sorted(rows) if t]
    merges, new = [], max(base.values()) + 1
    while len(merges) < n_merges:
        count = {}
        for d in docs:
            for pair in zip(d, d[1:]):
                count[pair] = count.get(pair, 0) + 1
        if not count:
            break
        best = max(count, key=count.get)               # the first of equal ones in order of meeting
        merges.append((*best, new))
        for d in docs:
            i = 0
            while i < len(d) - 1:
                if (d[i], d[i + 1]) == best:
                    d[i:i + 2] = [new]
                i += 1
        new += 1
    return merges


@pytest.mark.parametrize("batch, parts, merges", [(True, 3, 24), (False, 1, 6)])
def test_char_training_by_changes_equals_a_plain_one(spark, batch, parts, merges):
    rows = _char_docs()
    m, v = CB.train_char_bpe(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts), n_merges=merges, batch=batch)
    m, v = m.orderBy("rank").collect(), {r.token: r.token_id for r in v.collect()}
    base = {t: i for t, i in v.items() if i < m[0].new_id}
    assert [(r.left, r.right, r.new_id) for r in m] == _plain_char_train(rows, base, merges)
    token = {i: t for t, i in v.items()}
    assert all(token[r.new_id] == token[r.left] + token[r.right] for r in m)


def test_char_training_keeps_little_on_disk(spark, monkeypatch):
    """Whole documents were written as 4 bytes a symbol again and again, and kept."""
    import os

    from corpuslake.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    size = lambda: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs)
    rows = [(i, f"{t or ''} {i * 7919 % 1000} " * 20) for i, (_, t) in enumerate(_char_docs() * 3)]
    before, most, add = size(), [], CB.write_table
    from corpuslake.operators import char_train
    monkeypatch.setattr(char_train, "write_table", lambda *a: (add(*a), most.append(size() - before))[0])
    CB.train_char_bpe(spark.createDataFrame(rows, "doc_id long, text string"), n_merges=12)
    assert max(most) < sum(len(t) for _, t in rows)


def test_char_changes_of_counts_equal_counting_again():
    import numpy as np
    import pyarrow as pa

    from corpuslake.operators import char_train as CT
    rng, dtype = np.random.default_rng(4), CT.symbol_type(300)
    for trial in range(40):
        ids = [rng.integers(0, 3, int(rng.integers(0, 15))).tolist() for _ in range(6)]
        rb = pa.RecordBatch.from_arrays([pa.array(np.ones(6, np.int64) if trial % 2 else rng.integers(1, 5, 6)), pa.array(range(6)),
                                         pa.array(ids, pa.list_(pa.int32()))], names=["n", "f_doc", "ids"])
        state = list(CT._state_batches(iter([rb]), dtype))
        sums = lambda parts: {r["key"]: r["n"] for p in parts for r in p.to_pylist()}
        was, new = sums(CT._count_batches(iter(state), dtype)), [(0, 0, 9), (1, 2, 10), (9, 9, 11)]
        for k, n in sums(CT._change_batches(iter(state), (), new, dtype)).items():
            was[k] = was.get(k, 0) + n
        now = sums(CT._count_batches(CT._fold_batches(iter(state), new, dtype), dtype))
        assert {k: n for k, n in was.items() if n} == now
