"""Structured Streaming jobs over arriving Parquet files.

Sources are file streams (``readStream.parquet`` on a folder, optionally a
file-name glob). Sinks and checkpoints live under the shared checkpoint
folder of the session; a job given the folder of an earlier run goes on from it.
``run_available`` drives a query with ``trigger(availableNow=True)`` and
returns the written result as a batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..session import scratch_path

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])
DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder)


def event_time(df: DataFrame, ts: str = "ts", out: str = "event_ts") -> DataFrame:
    """Watermarks accept TIMESTAMP only; local times are read in the session's
    zone, which :func:`get_spark` sets to UTC (others have clock changes)."""
    return df.withColumn(out, F.col(ts).cast("timestamp"))


def run_available(df: DataFrame, name: str, mode: str = "append", each=None, keys=None,
                  folder: str | None = None) -> DataFrame:
    """Run a streaming DataFrame over everything available, write it as
    Parquet and return the batch result.

    ``folder`` holds the result and the checkpoint: a later run with the same one
    goes on where this one ended (a fresh one in the shared checkpoint folder
    otherwise). ``each(batch)`` is applied to every micro-batch. Micro-batches
    are written to folders of their number, so one that is retried replaces
    itself. In ``update`` mode the result is the last row of each of ``keys``.
    """
    spark = df.sparkSession
    folder = folder or scratch_path(spark, name)
    out, w = f"{folder}/out", df.writeStream.option("checkpointLocation", f"{folder}/checkpoint") \
        .trigger(availableNow=True)
    if mode == "append" and each is None:
        q = w.format("parquet").option("path", out).outputMode("append").start()
    else:
        def write(b, i):
            b = b if each is None else each(b)
            b.write.mode("overwrite").parquet(out if mode == "complete" else f"{out}/batch={i}")
        q = w.foreachBatch(write).outputMode(mode).start()
    q.awaitTermination()
    done = spark.read.parquet(out)
    if mode != "update":
        return done
    rest = [c for c in done.columns if c not in keys and c != "batch"]
    return done.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r")).select(*keys, "_r.*")


# ---------------------------------------------------------------- I1

def stream_clean(docs: DataFrame, threshold: float = 0.9) -> DataFrame:
    """ASCII filter, boilerplate strip and blank-line collapse per document."""
    d = docs.where(X.ascii_filter("text", threshold))
    return d.select("doc_id", X.collapse_blank_lines(X.strip_boilerplate("text")).alias("text"))


# ---------------------------------------------------------------- I2

def stream_encode(docs: DataFrame, merges: DataFrame, name: str = "encode",
                  folder: str | None = None) -> DataFrame:
    """Each arriving document -> token ids and count (BPE per micro-batch);
    returns the token table ``(doc_id, ids, n_tokens, batch)`` of all micro-batches."""
    from ..operators import bpe
    rows = bpe._merge_rows(merges)

    def each(b):
        enc = bpe.encode_bpe(b.select("doc_id", "text"), None, keep=["doc_id"], merge_rows=rows)
        return enc.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))
    return run_available(docs, name, each=each, folder=folder)


def running_totals(tokens: DataFrame) -> DataFrame:
    """Documents and tokens seen up to and including every micro-batch."""
    w = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per = tokens.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t"))
    return per.select("batch", F.sum("n").over(w).alias("docs_seen"), F.sum("t").over(w).alias("tokens_seen"))


# ---------------------------------------------------------------- I3

def stream_dedup(events: DataFrame, key_col: str, delay: str = "40 days") -> DataFrame:
    """Drop repeats of an identical key hash within the watermark delay;
    state is bounded by the watermark."""
    e = event_time(events).withColumn("_h", F.sha2(F.col(key_col), 256))
    return e.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(["_h"]).drop("_h")


# ---------------------------------------------------------------- I4

def stream_metrics(events: DataFrame, window: str = "1 day", slide: str | None = None,
                   late: str = "1 hour", by: str = "event_type") -> DataFrame:
    """I4: windowed mean value and count per key; rows later than the
    watermark are dropped."""
    e = event_time(events).withWatermark("event_ts", late)
    w = F.window("event_ts", window, slide) if slide else F.window("event_ts", window)
    return e.groupBy(w.alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"))


# ---------------------------------------------------------------- I5

def stream_sessions(events: DataFrame, gap: str = "6 hours", user: str = "user_id",
                    late: str = "1 hour") -> DataFrame:
    """Activity sessions per user (a new session after ``gap`` of silence)."""
    e = event_time(events).withWatermark("event_ts", late)
    return e.groupBy(F.session_window("event_ts", gap).alias("s"), user).agg(
        F.count(F.lit(1)).alias("n"))
