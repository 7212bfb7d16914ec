"""The flagship plan: cleaned documents -> pre-split -> top byte pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as X
from ..operators import bpe
from .registry import table


def top_byte_pairs(spark: SparkSession, sf_dir: str, k: int = 20) -> DataFrame:
    """B2 -> B3 -> C6 -> C9: the k most frequent byte pairs (ties: first seen)."""
    d = table(spark, sf_dir, "documents")
    d = d.where(X.ascii_filter("text", 0.9)).select(
        "doc_id", X.collapse_blank_lines("text").alias("text"))
    chunks = bpe.chunk_table(d, "text", "doc_id", fixed.GPT2_SPLIT_PATTERN)
    stats = bpe.pair_stats(chunks)
    top = stats.orderBy(F.desc("count"), F.asc("first")).limit(k)
    pair_bytes = F.unhex(F.concat(F.lpad(F.hex("left"), 2, "0"), F.lpad(F.hex("right"), 2, "0")))
    return top.select("left", "right", "count",
                      F.make_valid_utf8(pair_bytes.cast("string")).alias("text"))
