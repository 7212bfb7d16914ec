"""Registered queries: Structured Streaming (I1-I5) and the stream source (A10).

Each query streams the given table, one Parquet file or a folder of them, with
``trigger(availableNow=True)`` and returns the finished result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import streams as ST
from .registry import d_collapse, d_ascii_ratio, query, stream_path
from .q_text import _d_strip_boilerplate


def _docs(spark, sf):
    return ST.read_stream(spark, stream_path(sf, "documents"), ST.DOC_SCHEMA)


def _events(spark, sf):
    return ST.read_stream(spark, stream_path(sf, "events"), ST.EVENT_SCHEMA)


@query("i1_stream_clean", f"""
SELECT doc_id, md5({d_collapse(_d_strip_boilerplate('text'))}) AS md5 FROM documents
WHERE {d_ascii_ratio('text')} > 0.9""")
def i1_stream_clean(spark, sf):
    out = ST.run_available(ST.stream_clean(_docs(spark, sf)), "i1")
    return out.select("doc_id", F.md5("text").alias("md5"))


@query("a10_stream_documents", "SELECT doc_id, n_chars FROM documents")
def a10_stream_documents(spark, sf):
    from ..sources.readers import stream_documents
    s = stream_documents(spark, stream_path(sf, "documents")).select("doc_id", "n_chars")
    return ST.run_available(s, "a10")


@query("i3_stream_dedup", "SELECT DISTINCT props FROM events")
def i3_stream_dedup(spark, sf):
    out = ST.run_available(ST.stream_dedup(_events(spark, sf), "props").select("props"), "i3")
    return out.select("props")


@query("i4_stream_metrics", """
SELECT date_trunc('day', ts) AS window_start, event_type, count(*)::BIGINT AS n,
       round(avg(value), 6) AS mean_value FROM events GROUP BY 1, 2""")
def i4_stream_metrics(spark, sf):
    out = ST.run_available(ST.stream_metrics(_events(spark, sf)), "i4", mode="update", keys=["w", "event_type"])
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type",
                      F.col("n").cast("long"), F.round("mean_value", 6).alias("mean_value"))


@query("i5_stream_sessions", """
WITH o AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                  OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 6 HOUR THEN 1 ELSE 0 END AS brk
           FROM events),
s AS (SELECT user_id, ts, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM o)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*)::BIGINT AS n
FROM s GROUP BY user_id, sid""")
def i5_stream_sessions(spark, sf):
    out = ST.run_available(ST.stream_sessions(_events(spark, sf)), "i5", mode="complete")
    return out.select("user_id", F.col("s.start").cast("timestamp_ntz").alias("session_start"),
                      F.col("s.end").cast("timestamp_ntz").alias("session_end"), F.col("n").cast("long"))
