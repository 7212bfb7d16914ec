"""Every operator over tables of odd rows: nulls in all columns, empty and very long
texts, repeated rows, extra columns with names the operators use, and no rows at all."""

import pytest
from pyspark.sql import functions as F

from corpuslake.llm import decontaminate, linear, packing, pii, quality_forest, token_counts, token_files
from corpuslake.llm import tool_calls, toxicity
from corpuslake.llm.near_dups import near_duplicates

CLASH = ["id", "row", "grp", "key", "h", "_h", "_text", "_n", "y", "score", "kept", "rep", "fp", "n", "x", "seq", "item",
         "size", "bands", "sig", "label", "component_id", "start", "end", "n_tokens", "length", "piece", "count", "part",
         "idx", "anomaly", "base_failed", "n_words", "base", "cands", "spans", "codes", "_id", "item_id", "edits"]
PASSAGE = "the benchmark passage that nobody should ever see in a training corpus of documents"
TEXTS = [None, "", " \t\n", "one", "same words here and there again", "same words here and there again",
         "w" * 400_000, "9" * 50_000 + "." * 50_000 + "a@" * 50_000, "long words of text " * 30_000,
         " ".join(f"t{i} ü{i * 7}" for i in range(30_000)), f"before {PASSAGE} after it", "\x00 ﻿ 🙂  "]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4]), (4, TEXTS[4]), (None, "a null id"), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    for i, c in enumerate(CLASH):
        d = d.withColumn(c, F.lit(None).cast("string") if i % 2 else F.lit(-7))
    return d


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(12)] + [(4, 1, 1), (None, 1, 0), (5, None, None), (77, 0, 1), (None,) * 3]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("id", F.lit(1)) \
        .withColumn("y", F.lit("y"))


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, PASSAGE), (2, None), (3, ""), (None, PASSAGE), (1, PASSAGE), (4, "short")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("id", F.lit(5))


OPERATORS = {
    "rules": lambda d, lab: quality_forest.score_documents(d, lab),
    "pii": lambda d, lab: pii.find_pii(d),
    "quality": lambda d, lab: linear.classify(d, lab),
    "near": lambda d, lab: near_duplicates(d, k=3, percent=85),
    "files": lambda d, lab: token_files.round_trip(d),
    "toxic": lambda d, lab: toxicity.score_documents(d, lab),
    "counts": lambda d, lab: token_counts.count_documents(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_each(spark, docs, labels, name):
    op = OPERATORS[name]
    rows = op(docs, labels).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((i is None, i or 0) for i, _ in ROWS)
    same = {tuple(v for c, v in r.asDict().items() if c not in ("start", "doc_id")) for r in rows if r.doc_id == 4}
    assert len(same) == 1                                   # repeated rows have one result
    if name in ("quality", "toxic"):
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    if name == "near":
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
        assert got[0] == (0, 0, True) and got[3] == (1, 3, True) and got[5][1:] == (4, False)
        assert got[None][1] is None
    none = op(docs.where("false"), labels.where("false"))
    assert none.collect() == [] and none.columns == list(rows[0].asDict())
    blank = op(docs.withColumn("text", F.lit(None).cast("string")), labels.where("false")).collect()
    assert len(blank) == len(ROWS)                          # a column of nulls, and no labels to learn from


def test_packing_of_odd_rows(docs):
    rows = packing.pack_documents(docs).collect()
    assert sum(r.piece == 0 for r in rows) == len(ROWS)
    assert sum(r.length for r in rows if r.doc_id == 0) == 1 and max(r.offset + r.length for r in rows) <= 1024
    assert packing.pack_documents(docs.where("false")).collect() == []


def test_passages_in_odd_rows(docs, benchmark):
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_passages(docs, benchmark).collect()}
    assert found == {(10, 1), (10, None)}
    left = decontaminate.contaminated_rows(docs, benchmark)
    assert left.columns == docs.columns and left.count() == len(ROWS) - 1
    for d, b in ((docs.where("false"), benchmark), (docs, benchmark.where("false"))):
        assert decontaminate.find_passages(d, b).collect() == []
        assert decontaminate.contaminated_rows(d, b).count() == d.count()


def test_filters_keep_columns(docs, labels):
    kept = quality_forest.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= len(ROWS)
    masked = pii.redact(docs)
    assert masked.columns == docs.columns and masked.count() == len(ROWS)
    assert masked.where("doc_id = 0 and text is null").count() == 1


def test_tool_calls_of_odd_rows(spark):
    rows = [("x", 0, "user", "hello"), ("x", 1, "assistant", None), ("x", 1, "assistant", "again"), (None, 0, "user", "lost"),
            ("-1", 0, "user", None), ("-1", 2, "user", "é " * 3000), ("x", None, "user", "no turn"), ("x", 0, None, "no role"),
            ("x", 0, "user", "hello")]
    conv = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string").withColumn("name", F.lit(1))
    got = {r.call_id: r for r in tool_calls.link_tool_calls(*tool_calls.from_conversations(conv), tool_calls.SCHEMAS).collect()}
    assert set(got) == {"call_x_0", "call_-1_0", "call_-1_2", None}
    assert "call_id: missing" in got[None].errors
    assert got["call_x_0"].n_calls == 2 == got["call_x_0"].n_results
    assert [got[c].position for c in ("call_-1_0", "call_-1_2", "call_x_0")] == [0, 1, 0]
    calls, results = tool_calls.from_conversations(conv.where("false"))
    assert tool_calls.link_tool_calls(calls, results, tool_calls.SCHEMAS).collect() == []
