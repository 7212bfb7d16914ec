"""User hooks: named tokenizers and SQL functions.

A tokenizer is a pair of functions on tables: ``encode`` maps ``(key, text)`` rows
to ``(key, ids)`` rows, ``decode`` maps ``(key, ids)`` rows to ``(key, text)`` rows.
Registered ones can be named wherever a tokenizer is wanted; collation takes a
function of the same kind (``instruct.sft_collate(..., collate=f)``).
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import fixed
from .operators import bpe
from .operators.bpe import _decode_batches, _encode_batches     # by name: tasks get these two, not the module

_TOKENIZERS: dict[str, tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]] = {}


def register_tokenizer(name: str, encode: Callable[[DataFrame], DataFrame],
                       decode: Callable[[DataFrame], DataFrame]) -> None:
    """Makes a tokenizer known under ``name``; a name can be taken once."""
    if name in _TOKENIZERS:
        raise ValueError(f"tokenizer {name!r} is registered already")
    _TOKENIZERS[name] = (encode, decode)


def tokenizer(name: str) -> tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]:
    """The ``(encode, decode)`` registered under ``name``."""
    if name not in _TOKENIZERS:
        raise KeyError(f"no tokenizer {name!r}; registered: {sorted(_TOKENIZERS)}")
    return _TOKENIZERS[name]


def register_sql(spark: SparkSession, merges: DataFrame, prefix: str = "bpe",
                 pattern: str = fixed.GPT2_SPLIT_PATTERN) -> None:
    """SQL functions ``<prefix>_split(text)``, ``<prefix>_encode(chunks)`` and
    ``<prefix>_decode(ids)`` of a merge table; ``<prefix>_encode(<prefix>_split(text))``
    is C12. The split stays in the JVM, whole Arrow batches are encoded at once."""
    rules = bpe._merge_rows(merges)
    vocab = [(r.token_id, bytes(r.bytes)) for r in bpe.build_vocab(merges).collect()]

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(chunks: pa.Array) -> pa.Array:
        rb = pa.RecordBatch.from_arrays([chunks], names=["c"])
        return next(_encode_batches([rb], rules, None, "c", [], "ids")).column(0)

    @F.arrow_udf(T.StringType())
    def decode(ids: pa.Array) -> pa.Array:
        rb = pa.RecordBatch.from_arrays([ids], names=["i"])
        raw = next(_decode_batches([rb], vocab, "i", [], "b")).column(0)
        return pa.array([b.decode("utf-8", "replace") for b in raw.to_pylist()], pa.string())

    literal = pattern.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}_split(t STRING) RETURNS ARRAY<STRING> "
              f"RETURN regexp_extract_all(t, '(?U){literal}', 0)")
    spark.udf.register(f"{prefix}_encode", encode)
    spark.udf.register(f"{prefix}_decode", decode)
