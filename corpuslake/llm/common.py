"""Small helpers shared by the operators' queries."""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_crc(col: str = "doc_id"):
    """crc32 of the id's decimal text; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("null")).cast("binary"))


def crc(data) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def sample_by_hash(df: DataFrame, key: str, n: int, seed: int = 7) -> DataFrame:
    """The ``n`` rows of smallest key hash (all rows if there are fewer).

    Rows are counted first and only those whose hash lies below the bound that
    leaves about ``1.5 * n`` are sorted, so what meets in one task does not grow
    with the number of partitions.
    """
    h = F.xxhash64(F.lit(seed), F.col(key))
    total = df.count()
    if 3 * n < total and n >= 200:
        df = df.where(h < F.lit(int((1.5 * n / total - 0.5) * 2 ** 64)))
    return df.orderBy(h, F.col(key)).limit(n)

