"""Named tokenizers, SQL functions and custom collation."""

import pytest
from pyspark.sql import functions as F

from corpuslake import hooks
from corpuslake.operators import bpe, instruct, words


def test_register_tokenizer(spark):
    docs = spark.createDataFrame([(1, "b a"), (2, "a")], "doc_id long, text string")
    vocab = words.build_word_vocab(docs)
    hooks.register_tokenizer("words-test", lambda d: words.word_encode(d, vocab), lambda d: words.word_decode(d, vocab))
    encode, decode = hooks.tokenizer("words-test")
    assert {r.doc_id: r.text for r in decode(encode(docs)).collect()} == {1: "b a", 2: "a"}
    with pytest.raises(ValueError):
        hooks.register_tokenizer("words-test", None, None)
    with pytest.raises(KeyError):
        hooks.tokenizer("unknown")


def test_sql_functions(spark):
    docs = spark.createDataFrame([(1, "it's a test, it's é"), (2, ""), (3, "the  the")], "doc_id long, text string")
    merges = bpe.train_bpe(docs, 256 + 6)
    bpe.render_vocab(bpe.build_vocab(merges), merges).collect()       # a used function holds a JVM object
    hooks.register_sql(spark, merges, "hook")
    docs.createOrReplaceTempView("hook_docs")
    rows = spark.sql("SELECT doc_id, text, hook_encode(hook_split(text)) AS ids, "
                     "hook_decode(hook_encode(hook_split(text))) AS back FROM hook_docs").collect()
    want = {r.doc_id: list(r.ids) for r in bpe.encode_bpe(docs, merges, keep=["doc_id"]).collect()}
    assert {r.doc_id: list(r.ids) for r in rows} == want
    assert all(r.back == r.text for r in rows)


def test_custom_collate(spark):
    df = spark.createDataFrame([(0, 0, [5, 6])], "k int, batch_id long, ids array<int>")
    own = instruct.sft_collate(df, collate=lambda d: d.select("k", F.reverse("ids").alias("input_ids")))
    assert own.first().input_ids == [6, 5]
