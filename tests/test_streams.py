"""Streams over several micro-batches: resumed runs, running totals, late rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from corpuslake.operators import bpe
from corpuslake.session import scratch_path
from corpuslake.streaming import streams as ST


def _files(spark, rows, schema, path):
    for r in rows:
        spark.createDataFrame([r], schema).coalesce(1).write.mode("append").parquet(path)


def test_encode_resumes_and_totals(spark):
    path, folder = scratch_path(spark, "in"), scratch_path(spark, "run")
    docs = [(i, "abc " * (i + 1), "en", "s", 1) for i in range(4)]
    merges = bpe.merges_from_rows(spark, [(97, 98, 256)])
    run = lambda: ST.stream_encode(ST.read_stream(spark, path, ST.DOC_SCHEMA, max_files_per_trigger=1),
                                   merges, folder=folder)
    _files(spark, docs[:3], ST.DOC_SCHEMA, path)
    assert run().count() == 3
    _files(spark, docs[3:], ST.DOC_SCHEMA, path)
    out = run()                                     # goes on: the new file alone is read
    assert sorted(r.doc_id for r in out.collect()) == [0, 1, 2, 3] and out.select("batch").distinct().count() == 4
    totals = ST.running_totals(out).orderBy("batch").collect()
    n = {r.doc_id: r.n_tokens for r in out.collect()}
    assert [t.docs_seen for t in totals] == [1, 2, 3, 4] and totals[-1].tokens_seen == sum(n.values())


def test_metrics_over_batches(spark):
    path = scratch_path(spark, "in")
    day = dt.datetime(2024, 3, 31, 1, 30)
    hours = [0, 2, 30, 31, 80, 81, 1]               # the last is days behind the watermark
    rows = [(i, day + dt.timedelta(hours=h), 1, "a", float(h), "{}") for i, h in enumerate(hours)]
    _files(spark, rows, ST.EVENT_SCHEMA, path)
    events = ST.read_stream(spark, path, ST.EVENT_SCHEMA, max_files_per_trigger=1)
    got = ST.run_available(ST.stream_metrics(events), "m", mode="update", keys=["w", "event_type"])
    assert {(r.d, r.n, r.mean_value) for r in got.select(F.col("w.start").cast("string").alias("d"), "n", "mean_value").collect()} \
        == {("2024-03-31 00:00:00", 2, 1.0), ("2024-04-01 00:00:00", 2, 30.5), ("2024-04-03 00:00:00", 2, 80.5)}
    sliding = ST.run_available(ST.stream_metrics(events, "2 days", "1 day"), "m", mode="update",
                               keys=["w", "event_type"])
    assert sliding.agg(F.sum("n")).first()[0] == 12


@pytest.mark.parametrize("as_folder", [False, True])
def test_stream_queries_read_a_table_of_one_file_or_several(spark, tmp_path, as_folder):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from corpuslake.plans import q_bpe, q_stream
    rows = [(i, "good words here " * (i + 1), "en", "s", 16 * (i + 1)) for i in range(4)]
    cols = dict(zip(ST.DOC_SCHEMA.fieldNames(), map(list, zip(*rows))))
    at = tmp_path / "documents.parquet"
    if as_folder:
        at.mkdir()
        for i in range(2):
            pq.write_table(pa.table(cols).slice(2 * i, 2), at / f"part-{i}.parquet")
    else:
        pq.write_table(pa.table(cols), at)
    pq.write_table(pa.table({"doc_id": [9]}), tmp_path / "other.parquet")       # another table beside
    for f in (q_stream.a10_stream_documents, q_stream.i1_stream_clean):
        assert sorted(r.doc_id for r in f(spark, str(tmp_path)).collect()) == [0, 1, 2, 3], f.__name__
    merges = bpe.merges_from_rows(spark, [])
    docs = ST.read_stream(spark, q_bpe.stream_path(str(tmp_path), "documents"), ST.DOC_SCHEMA)
    n = {r.doc_id: r.n_tokens for r in ST.stream_encode(docs, merges).collect()}
    assert n == {r[0]: len(r[1]) for r in rows}
