"""Golden literals of the reference, stated in our own tests."""

import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from corpuslake.functions import fixed
from corpuslake.functions import text as X
from corpuslake.operators import bpe, instruct, sequences as S, vectors as V, words
from corpuslake.operators.order import global_offsets, with_ordinal


def _chunks(df):
    return df.select(F.lit(1).cast("long").alias("n"), F.lit(0).cast("long").alias("f_doc"),
                     F.lit(0).alias("f_idx"), "ids")


def test_pair_stats_literal(spark):
    df = spark.createDataFrame([([1, 2, 3, 1, 2],)], "ids array<int>")
    stats = bpe.pair_stats(_chunks(df))
    assert {(r.left, r.right): r["count"] for r in stats.collect()} == {(1, 2): 2, (2, 3): 1, (3, 1): 1}
    assert tuple(bpe.extreme_pair(stats).first()) == (1, 2, 2)
    assert tuple(bpe.extreme_pair(stats, "least").first()) == (2, 3, 1)      # tie: seen first


def test_overlapping_pairs_counted_twice(spark):
    df = spark.createDataFrame([([1, 1, 1],)], "ids array<int>")
    assert {(r.left, r.right): r["count"] for r in bpe.pair_stats(_chunks(df)).collect()} == {(1, 1): 2}


def test_apply_merges_literal(spark):
    df = spark.createDataFrame([(1, [1, 2, 3, 1, 2])], "k int, ids array<int>")
    assert bpe.apply_merges(df, [(1, 2, 4)]).first().ids == [4, 3, 4]
    df2 = spark.createDataFrame([(1, [7, 7, 7, 7, 7])], "k int, ids array<int>")
    assert bpe.apply_merges(df2, [(7, 7, 9)]).first().ids == [9, 9, 7]


def test_word_split_literal(spark):
    df = spark.createDataFrame([("Hello, world. Is this-- a test?",)], "text string")
    assert df.select(X.word_split("text").alias("t")).first().t == \
        ["Hello", ",", "world", ".", "Is", "this", "--", "a", "test", "?"]


def test_word_vocab_specials_and_unknown(spark):
    train = spark.createDataFrame([(1, "Hello, do you like tea?")], "doc_id long, text string")
    vocab = words.build_word_vocab(train)
    v = {r.token: r.token_id for r in vocab.collect()}
    n = len(v) - 2
    assert v[fixed.ENDOFTEXT] == n and v[fixed.UNK] == n + 1
    by_id = [k for k, _ in sorted(((k, i) for k, i in v.items() if not k.startswith("<|")),
                                  key=lambda x: x[1])]
    assert by_id == sorted(by_id)
    test = spark.createDataFrame(
        [(2, "Hello, do you like tea? <|endoftext|> In the sunlit terraces of the palace.")],
        "doc_id long, text string")
    ids = words.word_encode(test, vocab, on_unknown="unk").first().ids
    toks = X_split_py("Hello, do you like tea? <|endoftext|> In the sunlit terraces of the palace.")
    assert len(ids) == len(toks)
    assert ids[:6] == [v["Hello"], v[","], v["do"], v["you"], v["like"], v["tea"]]
    assert v[fixed.UNK] in ids
    with pytest.raises(Exception):
        words.word_encode(test, vocab, on_unknown="error").collect()


def X_split_py(text):
    import re
    return [t.strip() for t in re.split(r'([,.:;?_!"()\']|--|\s)', text) if t.strip()]


def test_decode_v1_punct(spark):
    df = spark.createDataFrame([(["Hello", ",", "world", "."],)], "t array<string>")
    assert df.select(X.word_decode_text("t", fixed.DECODE_PUNCT_V1).alias("s")).first().s == "Hello, world."


def test_windows_count_and_shift(spark):
    ids = list(range(100, 130))
    tok = spark.createDataFrame([(1, ids[:7]), (2, []), (3, ids[7:8]), (4, ids[8:])],
                                "doc_id long, ids array<int>")
    for L, stride in [(4, 1), (4, 4), (5, 2), (3, 7)]:
        w = sorted(S.sliding_windows(tok, L, stride).collect(), key=lambda r: r.seq_id)
        assert len(w) == max(0, math.ceil((len(ids) - L) / stride))
        for r in w:
            i = r.seq_id * stride
            assert r.input_ids == ids[i:i + L] and r.target_ids == ids[i + 1:i + L + 1]


def test_context_pairs(spark):
    df = spark.createDataFrame([(1, [10, 11, 12, 13, 14, 15])], "doc_id long, ids array<int>")
    rows = sorted(S.context_pairs(df, 4).collect(), key=lambda r: r.context_len)
    assert [(r.context, r.next_id) for r in rows] == [
        ([10], 11), ([10, 11], 12), ([10, 11, 12], 13), ([10, 11, 12, 13], 14)]


def test_targets_shift_literal(spark):
    tok = spark.createDataFrame([(1, [16833, 3626, 6100, 345]), (2, [40, 1107, 588, 11311])],
                                "doc_id long, ids array<int>")
    w = sorted(S.sliding_windows_per_group(tok, 3, 3).collect(), key=lambda r: r.doc_id)
    assert [r.input_ids for r in w] == [[16833, 3626, 6100], [40, 1107, 588]]
    assert [r.target_ids for r in w] == [[3626, 6100, 345], [1107, 588, 11311]]


def test_attention_softmax_literal(spark):
    vecs = [(.43, .15, .89), (.55, .87, .66), (.57, .85, .64), (.22, .58, .33), (.77, .25, .10), (.05, .80, .55)]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)],
                               "vec_id long, embedding array<double>")
    b = V.blocks(df, 32)
    w = V.softmax_weights(V.dot_scores(b, scale=False)).collect()
    row2 = [round(r.weight, 4) for r in sorted(w, key=lambda r: r.k) if r.q == 1]
    assert row2 == [.1385, .2379, .2333, .1240, .1082, .1581]
    sums = {}
    for r in w:
        sums[r.q] = sums.get(r.q, 0) + r.weight
    assert all(abs(s - 1) < 1e-9 for s in sums.values())
    causal = V.softmax_weights(V.dot_scores(b, scale=False, causal=True)).collect()
    assert all(r.k <= r.q for r in causal)


def test_format_prompt(spark):
    df = spark.createDataFrame([("Do it", "", "Done"), ("Do it", "with this", "Done")],
                               "instruction string, input string, output string")
    rows = df.select(X.format_prompt("instruction", "input", "output").alias("p")).collect()
    head = fixed.PROMPT_HEADER + "\n\n### Instruction:\nDo it"
    assert rows[0].p == head + "\n\n### Response:\nDone"
    assert rows[1].p == head + "\n\n### Input:\nwith this" + "\n\n### Response:\nDone"


def test_sft_collate_literal(spark):
    df = spark.createDataFrame([(0, 0, [5, 6, 7]), (1, 0, [5])], "k int, batch_id long, ids array<int>")
    rows = sorted(instruct.sft_collate(df).collect(), key=lambda r: r.k)
    assert rows[0].input_ids == [5, 6, 7] and rows[1].input_ids == [5, 50256, 50256]
    assert rows[0].target_ids == [6, 7, 50256] and rows[1].target_ids == [50256, -100, -100]


def test_pad_truncate_literal(spark):
    df = spark.createDataFrame([([1, 2],), ([1, 2, 3, 4, 5],)], "ids array<int>")
    got = [r.p for r in df.select(S.pad_truncate(F.col("ids"), 4).alias("p")).collect()]
    assert got == [[1, 2, 50256, 50256], [1, 2, 3, 4]]


def test_split_rows_literal(spark):
    df = spark.range(100).withColumnRenamed("id", "doc_id")
    c = {r.split: r["count"] for r in S.split_rows(df, (0.85, 0.1)).groupBy("split").count().collect()}
    assert c == {"train": 85, "test": 10, "val": 5}


def test_special_policy(spark):
    df = spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string")
    merges = bpe.merges_from_rows(spark, [])
    with pytest.raises(ValueError):
        bpe.encode_bpe(df, merges, specials=fixed.GPT4_SPECIAL_TOKENS, merge_rows=[])
    ids = bpe.encode_bpe(df, merges, specials=fixed.GPT4_SPECIAL_TOKENS, allowed="all",
                         keep=["doc_id"], merge_rows=[]).first().ids
    assert 100257 in ids
    ids2 = bpe.encode_bpe(df, merges, specials=fixed.GPT4_SPECIAL_TOKENS, allowed="none",
                          keep=["doc_id"], merge_rows=[]).first().ids
    assert ids2 == list("a <|endoftext|> b".encode())
    with pytest.raises(ValueError):
        bpe.resolve_allowed(fixed.GPT4_SPECIAL_TOKENS, "bogus")


def test_ordinal_matches_window(spark):
    df = spark.range(0, 5000).selectExpr("id * 7 % 5003 as k", "id % 13 as sz")
    for parts in (1, 4, 32):
        d = df.repartition(parts)
        got = {r.k: (r.ordinal, r.offset) for r in global_offsets(d, "k", "sz").collect()}
        rows = sorted(df.collect(), key=lambda r: r.k)
        acc = 0
        for i, r in enumerate(rows):
            assert got[r.k] == (i, acc)
            acc += r.sz


def test_partitioned_offsets_hot_partition(spark):
    from corpuslake.operators.order import partitioned_offsets
    rows = [(0 if i % 3 else 1, i, 1) for i in range(3000)]      # one partition holds 2/3
    df = spark.createDataFrame(rows, "p long, o long, sz long")
    got = {(r.p, r.o): (r.ordinal, r.offset) for r in
           partitioned_offsets(df, "p", "o", "sz", num_buckets=16).collect()}
    for p in (0, 1):
        os_ = sorted(o for q, o, _ in rows if q == p)
        for i, o in enumerate(os_):
            assert got[(p, o)] == (i, i)


def test_with_ordinal_strings(spark):
    toks = ["b", "a", "é", "ab", "Z", "", "zz", "日本", "a b"]
    df = spark.createDataFrame([(t,) for t in toks], "token string")
    got = {r.token: r.o for r in with_ordinal(df, "token", name="o").collect()}
    assert [t for t, _ in sorted(got.items(), key=lambda x: x[1])] == sorted(toks)


def _union_find_labels(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}


def test_connected_components_long_chains(spark):
    """Component labels equal a union-find on a graph whose chains are far
    longer than any fixed round count (a path of 300 nodes in shuffled
    order, plus random small components)."""
    import random
    from corpuslake.operators.clean import connected_components
    rnd = random.Random(7)
    path = list(range(1000, 1300))
    rnd.shuffle(path)
    edges = list(zip(path, path[1:]))
    edges += [(rnd.randrange(2000, 2400), rnd.randrange(2000, 2400)) for _ in range(300)]
    got = {r.node: r.label for r in connected_components(
        spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == _union_find_labels(edges)


def test_near_dup_exact_copies_share_component(spark):
    from corpuslake.operators.clean import near_dup_minhash
    base = "the quick brown fox jumps over the lazy dog and keeps running far away"
    rows = [(1, base), (2, "completely different words in this one text here today"),
            (3, base), (4, base + " "), (5, "another unrelated sentence about data and spark jobs")]
    got = {r.doc_id: (r.component, r.keep) for r in near_dup_minhash(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == (1, True) and got[3] == (1, False) and got[4] == (1, False)
    assert got[2] == (2, True) and got[5] == (5, True)


def _next_fit_seq(sizes, max_bytes):
    """The sequential rule, literally: flush when the open shard would overflow."""
    out, size, k = [], 0, 1
    for x in sizes:
        if size + x > max_bytes:
            k, size = k + 1, x
        else:
            size += x
        out.append(k)
    return out


@pytest.mark.parametrize("sizes", [
    [80],                                            # oversize first document: empty shard 1
    [80, 10, 45, 5, 50, 1, 60, 60, 3],
    [10] * 37,                                       # equal sizes: many doubling rounds
    [1, 3, 10, 25, 49, 50, 51, 120, 2, 2, 48, 49, 1] * 9,
])
def test_next_fit_shards_equal_sequential(spark, sizes):
    from corpuslake.operators.clean import next_fit_shards
    df = spark.createDataFrame([(i * 7 + 2, "é" * (s // 2) + "x" * (s % 2)) for i, s in enumerate(sizes)],
                               "doc_id long, text string")
    got = [(r.n_bytes, r.shard_id) for r in next_fit_shards(df, max_bytes=50).orderBy("doc_id").collect()]
    assert [g[0] for g in got] == sizes
    assert [g[1] for g in got] == _next_fit_seq(sizes, 50)


def test_common_prefix_spreads_over_ranges(spark):
    from corpuslake.operators.order import ranged
    df = spark.range(1000).selectExpr("concat('https://example.org/', lpad(id, 5, '0')) as url")
    per = [r["count"] for r in ranged(df, [F.col("url")], 8).groupBy("_bucket").count().collect()]
    assert len(per) == 8 and max(per) < 300
    assert global_offsets(df.where("false"), "url").count() == 0


def test_word_encode_decode(spark):
    """Rows sharing a key stay rows; null and empty texts; a word equal to a special string
    takes the special's id; an unknown word raises without a <|unk|> entry."""
    rows = [(1, "Hello, do you like tea? In the sunlit terraces"),
            (2, "the palace <|endoftext|> of the -- sunlit (tea)."), (2, "the tea"), (3, None), (4, "")] \
        + [(i, "the the tea, the palace") for i in range(10, 1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    vocab = words.build_word_vocab(docs).cache()
    v = {r.token: r.token_id for r in vocab.orderBy("token_id").collect()}
    enc = words.word_encode(docs, vocab)
    got = sorted((r.doc_id, tuple(r.ids)) for r in enc.collect())
    assert got == sorted((i, tuple(v[w] for w in X_split_py(t or ""))) for i, t in rows)
    assert v[fixed.ENDOFTEXT] in got[1][1] + got[2][1]
    assert len([r for r in words.word_decode(enc, vocab).collect() if r.doc_id == 2]) == 2
    other = spark.createDataFrame([(1, "Hello stranger"), (2, "Hello")], "doc_id long, text string")
    bare = words.build_word_vocab(docs, specials=False)
    for mode in ("error", "unk"):
        assert words.word_encode(other.where("doc_id = 2"), bare, on_unknown=mode).first().ids == [v["Hello"]]
        with pytest.raises(Exception, match="stranger" if mode == "error" else "unk"):
            words.word_encode(other, bare, on_unknown=mode).collect()
    with pytest.raises(Exception, match="unknown id"):
        words.word_decode(spark.createDataFrame([(1, [99999])], "doc_id long, ids array<long>"), vocab).collect()


def test_word_blocks_split_once(spark):
    """One split serves vocabulary and ids (F22, F23, F25 to F27, F31 to F34); blocks are unpacked in Arrow."""
    rows = [(1, "b a -- c"), (1, "a"), (None, "c, c"), (4, None), (5, ""), (6, " \n")] \
        + [(i, f"w{i % 7} a w{i % 11}") for i in range(10, 1400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    blocks = words.token_blocks(docs)
    vocab = words.build_word_vocab(docs, blocks=blocks)
    assert sorted(vocab.collect()) == sorted(words.build_word_vocab(docs).collect())
    v = {r.token: r.token_id for r in vocab.collect()}
    out = words.word_encode(docs, vocab, blocks=blocks)
    got = sorted((r.doc_id or 0, tuple(r.ids)) for r in out.collect())
    assert got == sorted((i or 0, tuple(v[w] for w in X_split_py(t or ""))) for i, t in rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" not in plan and "FlatMapCoGroupsInArrow" in plan
    none = docs.where("text is null")
    assert words.word_encode(none, vocab).first().ids == [] and words.word_encode(docs.where("false"), vocab).count() == 0
    text = spark.createDataFrame([("x", ["p", "q", "p"]), ("x", None), (None, [])], "k string, t array<string>")
    table = spark.createDataFrame([("p", "P")], "v string, new string")
    back = words.mapped_lists(text, "k", F.col("t"), table, lambda x: F.concat(F.lit("?"), x))
    assert sorted(map(str, back.collect())) == sorted(map(str, [
        Row(k="x", _out=["P", "?q", "P"]), Row(k="x", _out=[]), Row(k=None, _out=[])]))


def _jaccard_pairs(spark, docs, **kw):
    from corpuslake.operators.clean import near_dup_minhash
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return {r.doc_id: r.component for r in near_dup_minhash(df, **kw).collect()}


def test_one_permutation_signatures():
    """Entries agree as often as sets do, whatever their size, and bands miss as few links as independent hashes."""
    import numpy as np
    from corpuslake.functions import set_kernels as SK
    from corpuslake.operators.linkage import banding
    rnd = np.random.default_rng(7)
    for size, same in ((9, 8), (45, 40), (180, 160), (1800, 1600)):      # similarity 0.8 each
        pairs = 20_000 if size < 200 else 2000
        a = rnd.integers(0, 1 << 63, (pairs, size), dtype=np.uint64)
        b = a.copy()
        b[:, same:] = rnd.integers(0, 1 << 63, (pairs, size - same), dtype=np.uint64)
        bounds = np.arange(pairs + 1) * size
        bands, rows = banding(0.8)
        x, y = (SK.one_permutation(s.ravel(), bounds, bands * rows) for s in (a, b))
        assert abs((x == y).mean() - same / (2 * size - same)) < 0.01
        shared = (SK.band_keys(x, bands, rows) == SK.band_keys(y, bands, rows)).sum(axis=1)
        assert (shared == 0).sum() == 0 and abs((x == y).all(axis=1).mean()) < 0.02


def test_near_dup_finds_shifted_and_template_pairs(spark):
    """A word put in front, and pairs beside six templates of smaller id that share their buckets."""
    import random
    rnd = random.Random(3)
    docs, want, n = [], {}, 0
    for _ in range(60):
        base = [f"a{rnd.randrange(10**6)}" for _ in range(300)]
        for _ in range(6):
            w = list(base)
            for i in rnd.sample(range(300), 11):
                w[i] = f"b{rnd.randrange(10**6)}"
            docs.append((n, " ".join(w)))
            want[n] = n
            n += 1
        docs += [(n, " ".join(base)), (n + 1, "front " + " ".join(base))]
        want[n] = want[n + 1] = n
        n += 2
    assert _jaccard_pairs(spark, docs) == want


def test_banding_bounds():
    from corpuslake.operators.linkage import banding
    for t in (0.06, 0.3, 0.5, 0.69, 0.7, 0.8, 0.84, 0.85, 0.95):
        bands, rows = banding(t)
        assert (1 - t ** rows) ** bands < 1e-6 and bands * rows < 256
    with pytest.raises(ValueError):
        banding(0.05)


def test_near_dup_bucket_with_a_third_of_the_rows(spark):
    docs = [(i, " ".join(f"u{i}x{j}" for j in range(30))) for i in range(200)]
    family = [f"f{j}" for j in range(400)]
    docs += [(1000 + i, " ".join(family[:i % 8] + family[i % 8 + 1:])) for i in range(100)]
    want = {i: i for i, _ in docs[:200]} | {1000 + i: 1000 for i in range(100)}
    assert _jaccard_pairs(spark, docs) == want
    assert _jaccard_pairs(spark, docs, bucket=8, block_rows=5) == want      # stars and blocks


def test_split_counts_warn_and_list_every_split(spark):
    tok = spark.createDataFrame([(1, list(range(30))), (2, list(range(20)))], "doc_id long, ids array<int>")
    got = {r.split: tuple(r)[1:] for r in S.split_token_counts(S.split_by_tokens(tok, 0.9, 8, 8), 2, 8, 50, 0.9).collect()}
    assert got == {"train": (5, 2, 40, False), "val": (0, 0, 0, True)}
    none = S.split_token_counts(S.split_by_tokens(tok.where("false"), 0.9, 8, 8), 2, 8, 0, 0.9)
    assert {r.split: r.too_small for r in none.collect()} == {"train": True, "val": True}
    assert S.context_length(tok, "longest_training_example", 7).first()[0] == 30
    assert S.context_length(tok, "model_context_length", 7).first()[0] == 7 and S.context_length(tok, "12", 7).first()[0] == 12
    with pytest.raises(ValueError):
        S.context_length(tok, "longest", 7)


def test_exact_dedup_keeps_rows_without_text_or_key(spark):
    from corpuslake.operators.clean import exact_dedup
    d = spark.createDataFrame([(None, "x"), (1, None), (2, None), (3, "y"), (4, "y"), (4, "x"), (5, "x")], "doc_id long, text string")
    assert sorted(map(tuple, exact_dedup(d).collect()), key=repr) == sorted(
        [(None, "x"), (1, None), (2, None), (3, "y"), (4, "x")], key=repr)


def test_smoothing_in_blocks(spark):
    from corpuslake.operators.metrics import smooth_loss
    rows = [(r, i, float((i * 7 + r) % 11)) for r in (1, 2) for i in range(3 if r == 2 else 100)]
    st = spark.createDataFrame(rows, "run long, step long, loss double")
    for w, block in ((1, 1), (5, 5), (5, 7), (10, 64), (4, None)):
        got = {(x.run, x.step): x.smooth_loss for x in smooth_loss(st, w, block=block).collect()}
        want = {(r, i): sum(float((j * 7 + r) % 11) for j in range(i - w + 1, i + 1)) / w
                for r, n in ((1, 100), (2, 3)) for i in range(w - 1, n)}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_join_and_spreads_a_hot_key(spark, how):
    from corpuslake.operators.skew import heavy_hitters, skew_join
    rows = spark.range(30_000).selectExpr("id", "case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else concat('k', id % 5000) end as k")
    build = spark.range(4000).selectExpr("concat('k', id) as k", "id as v").unionByName(
        spark.createDataFrame([("hot", -1), ("hot", -2), (None, -3)], "k string, v long"))
    salts = heavy_hitters(rows, ["k"], 16)
    assert len(salts) == 1 and 5 <= list(salts.values())[0] <= 6
    got = skew_join(rows, build, "k", how, spread=["id"], hot=16)
    key = lambda r: (r.id, r.k, r.v)
    assert sorted(map(key, got.collect()), key=repr) == sorted(map(key, rows.join(build, "k", how).collect()), key=repr)
    dealt = got.where("k = 'hot'").groupBy(F.pmod(F.xxhash64("id"), F.lit(list(salts.values())[0]))).count()
    assert dealt.count() >= 5
    assert skew_join(rows.where("false"), build, "k", how).count() == 0


def test_near_dup_of_nothing(spark):
    docs = [(1, None), (2, None), (3, ""), (4, " \t"), (5, "one"), (6, "ONE "), (7, "two words")]
    assert _jaccard_pairs(spark, docs) == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7}
    assert _jaccard_pairs(spark, [(9, None)]) == {9: 9}


def test_large_group_of_near_copies(spark):
    """100,000 near copies of one text, some chains of them and strangers: leads leave little to compare."""
    from corpuslake.operators import linkage
    rows = spark.range(100_000).selectExpr(
        "id", "0L as grp", "transform(sequence(0, 39), i -> case when i = 7 + id % 3 then xxhash64(id, i) else xxhash64(i) end) as c")
    chain = [(200_000 + i, 0, [j for j in range(i * 2, i * 2 + 40)]) for i in range(6)]
    sets = rows.unionByName(spark.createDataFrame(chain, "id long, grp long, c array<long>"))
    copies = []

    def pack(it):
        import numpy as np
        import pyarrow as pa
        for rb in it:
            codes = [np.sort(np.array(x, np.int64).view(np.uint64)).tobytes() for x in rb.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), pa.array(codes, pa.binary())], names=["id", "grp", "codes"])

    packed = sets.mapInArrow(pack, "id long, grp long, codes binary")
    edges = linkage.verified_edges

    def counted(blocks, percent):
        copies.append(blocks.count())
        return edges(blocks, percent)

    linkage.verified_edges = counted
    try:
        got = {r.node: r.label for r in linkage.verified_components(packed, 80, 512, 1 << 21).collect()}
    finally:
        linkage.verified_edges = edges
    assert all(got[i] == 0 for i in range(100_000)) and len({got[200_000 + i] for i in range(6)}) == 1 and got[200_000] != 0
    assert copies[0] < 2 * 100_006


def test_window_plan_moves_ids_once(spark):
    """Windows inside a document need no shuffle, and none of D1's exchanges carries ids."""
    rnd = __import__("random").Random(2)
    rows = [(i, [rnd.randrange(50) for _ in range(rnd.choice([0, 1, 5, 90]))]) for i in range(60)]
    tok = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    flat = [t for _, r in sorted(rows) for t in r]
    for L, stride in [(8, 5), (4, 4), (100, 7)]:
        got = {r.seq_id: (r.input_ids, r.target_ids) for r in S.sliding_windows(tok, L, stride).collect()}
        assert got == {k: (flat[i:i + L], flat[i + 1:i + L + 1])
                       for k, i in enumerate(range(0, len(flat) - L, stride))}


def test_embedding_lookup_raises_on_unknown_id(spark):
    tok = spark.createDataFrame([(1, [0, 1, 0])], "doc_id long, ids array<long>")
    emb = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert V.embedding_lookup(tok, emb).count() == 3
    with pytest.raises(Exception, match="not in the table"):
        V.embedding_lookup(tok, emb.where("vec_id = 0")).collect()


def test_embedding_lookup_brings_columns_along(spark):
    from corpuslake.operators import vectors as V
    emb = spark.createDataFrame([(0, [1.5, 2.0]), (1, [0.5, -4.0])], "vec_id long, embedding array<float>") \
        .withColumn("_sum", V.vsum(V.dvec("embedding")))
    tok = spark.createDataFrame([(7, [1, 0, 1]), (8, [])], "doc_id long, ids array<long>")
    look = V.embedding_lookup(tok, emb, extra=["_sum"])
    assert [tuple(r) for r in look.orderBy("pos").collect()] == [
        (7, 0, [0.5, -4.0], -3.5), (7, 1, [1.5, 2.0], 3.5), (7, 2, [0.5, -4.0], -3.5)]
    with pytest.raises(Exception, match="id not in the table"):
        V.embedding_lookup(tok, emb.where("vec_id = 0"), extra=["_sum"]) \
            .groupBy("doc_id").agg({"vec": "count", "_sum": "sum"}).collect()


def test_lcs_length():
    from corpuslake.operators.evaluate import _lcs_len
    import random
    rnd = random.Random(1)
    for _ in range(100):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randrange(12))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert _lcs_len(a, b) == t[-1][-1]


def test_epoch_rollup_of_all_measures(spark):
    """Train loss, validation loss (logged at some steps only) and learning rate in one pass."""
    from corpuslake.operators.metrics import epoch_rollup
    rows = [("r", 0, 0, 4.0, 5.0, 0.1, 10), ("r", 0, 1, 2.0, 3.0, 0.3, 20), ("r", 0, 2, 3.0, None, 0.2, 30),
            ("r", 1, 3, 1.0, None, 0.4, 40)]
    st = spark.createDataFrame(rows, "run string, epoch int, step long, loss double, val_loss double, lr double, tokens_seen long")
    got = [tuple(r) for r in epoch_rollup(st, measures=["loss", "val_loss", "lr"]).orderBy("epoch").collect()]
    assert got == [("r", 0, 3.0, 2.0, 3.0, 3.0, 3.0, 4.0, 0.2, 0.1, pytest.approx(0.2), 30, 3),
                   ("r", 1, 1.0, 1.0, 1.0, None, None, None, 0.4, 0.4, 0.4, 40, 1)]
    assert epoch_rollup(st).columns == ["run", "epoch", "last_loss", "min_loss", "mean_loss", "tokens_seen", "n_steps"]


def test_logreg_equals_newton(spark):
    """The Spark fit on the term table against Newton's method on the same matrix."""
    import numpy as np
    from corpuslake.operators import evaluate as E
    rnd = np.random.default_rng(4)
    texts = [" ".join(rnd.choice([f"tt{i}" for i in range(30)], size=20)) for _ in range(80)]
    y = [int("tt1" in t.split()) for t in texts]
    df = spark.createDataFrame([(i, t, y[i], "train") for i, t in enumerate(texts)] + [(99, None, 0, "val")],
                               "doc_id long, text string, label int, split string")
    model, pred = E.logreg(df, tol=1e-9)
    assert pred.count() == 81
    vocab = sorted({w for t in texts for w in t.split()})
    x = np.array([[t.split().count(w) for w in vocab] + [1] for t in texts], float)
    w, ridge = np.zeros(len(vocab) + 1), np.diag([1.0] * len(vocab) + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
    assert np.allclose(model.coefficients.toArray(), w[:-1], atol=2e-3) and abs(model.intercept - w[-1]) < 5e-3
    # the registered setting: the same predictions, a loss within a thousandth of the least
    model, pred = E.logreg(df)
    z = x @ w
    assert [r.pred for r in pred.where("split = 'train'").orderBy("doc_id").collect()] == (z > 0).astype(int).tolist()

    def loss(v):
        m = x @ v
        return (np.logaddexp(0, m) - np.array(y) * m).sum() + 0.5 * (v[:-1] ** 2).sum()

    assert loss(np.append(model.coefficients.toArray(), model.intercept)) < 1.001 * loss(w)


def test_term_vectors_share_the_columns_of_one_row(spark):
    """Terms of one row alone take one column of that row, and the fit is that of a column each."""
    import numpy as np
    from corpuslake.operators import evaluate as E
    df = spark.createDataFrame(
        [(1, "aa aa bb c1 c1 c1 d1 d1 d1 d1", 1, "train"), (2, "aa bb bb e2", 0, "train"), (3, "bb bb", 0, "train"),
         (4, "aa aa bb f4", 1, "train"), (5, "aa zz", 1, "val"), (5, "bb", 0, "val"), (None, "aa g0 g0", 1, "train"),
         (7, None, 0, "val")], "doc_id long, text string, label int, split string")
    f = {r.doc_id: r.features for r in E.term_vectors(df).collect()}
    assert {v.size for v in f.values()} <= {5, 6}                  # aa, bb, the rows 1, 2 and 4, no column a term
    assert f[1].toArray()[:2].tolist() == [2, 1] and f[1].values.tolist()[2:] == [5]    # 3 and 4 make 5
    assert f[5].toArray()[:2].tolist() == [1, 1] and f[5].toArray()[2:].sum() == 0      # rows of one key, added up
    assert f[7].indices.tolist() == [] and f[None].indices.tolist() == []
    model, pred = E.logreg(df, tol=1e-10)
    # a column each, by Newton's method
    x = np.array([[2, 1, 3, 4, 0, 0, 1], [1, 2, 0, 0, 1, 0, 1], [0, 2, 0, 0, 0, 0, 1], [2, 1, 0, 0, 0, 1, 1],
                  [0, 0, 0, 0, 0, 0, 1]], float)
    y, w, ridge = np.array([1, 0, 0, 1, 1]), np.zeros(7), np.diag([1.0] * 6 + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
    got = model.coefficients.toArray()
    assert np.allclose(got[:2], w[:2], atol=2e-3) and abs(model.intercept - w[-1]) < 5e-3
    assert abs(got[f[1].indices[2]] - np.hypot(w[2], w[3])) < 2e-3
    z = {1: x[0] @ w, 2: x[1] @ w, 3: x[2] @ w, 4: x[3] @ w, 5: w[0] + w[1] + w[-1], None: w[-1], 7: w[-1]}
    rows = pred.collect()
    assert len(rows) == 8 and all(r.pred == int(z[r.doc_id] > 0) for r in rows)


def test_checkpoint_folder_is_required_on_clusters():
    from corpuslake import session

    class Context:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

    class Conf:
        get = staticmethod(lambda k, d=None: d)

    class Session:
        sparkContext, conf = Context(), Conf()

    for m in ("yarn", "spark://h:7077", "local-cluster[3,2,1024]", "k8s://h"):
        Context.master = m
        with pytest.raises(ValueError):
            session.ensure_checkpoint_dir(Session())


def test_learning_curve_fits_run_side_by_side(spark, monkeypatch):
    """The three fits, each of hundreds of short jobs, ran one after the other."""
    import threading

    from corpuslake.plans import q_eval
    both = threading.Barrier(2)
    rows = spark.createDataFrame([(i, "a b", i % 2, s) for i, s in enumerate(["train"] * 8 + ["val"] * 2)],
                                 "doc_id long, text string, label int, split string")
    seen = []

    def fit(data, train):
        if len(seen) < 2:
            seen.append(1)
            both.wait(60)
        return None, data.withColumn("pred", F.lit(train.count() % 2))
    monkeypatch.setattr(q_eval, "labelled", lambda *a: rows)
    monkeypatch.setattr(q_eval.E, "term_vectors", lambda d: d)
    monkeypatch.setattr(q_eval.E, "fit_logreg", fit)
    out = q_eval.e17_learning_curve(spark, "").collect()
    assert [(r.fraction, r.accuracy, r.n) for r in out] == [(f, 0.5, 2) for f in (0.25, 0.5, 1.0)]
