"""Registry of named queries and their DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame`` reading the given tables.
The oracle is an equivalent SQL text over the same tables (views named
after the tables). Queries with no SQL form register no oracle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..functions import fixed

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stream_path(sf_dir: str, name: str) -> str:
    """A table for a file stream, which takes one file only by a pattern, a folder by any name."""
    return f"{sf_dir.rstrip('/')}/{name}.parque[t]"


# ---- DuckDB fragments -------------------------------------------------------

def sq(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def chars(s: str) -> str:
    """A SQL expression for an arbitrary string via chr() (no escaping issues)."""
    return "(" + " || ".join(f"chr({ord(c)})" for c in s) + ")"


WS_TRIM = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
_DELIMS = re.escape(fixed.WORD_DELIMS)


def d_strip(x: str) -> str:
    return f"trim({x}, {chars(WS_TRIM)})"


def d_word_split(x: str) -> str:
    pat = r"\x{E000}|[" + _DELIMS + r"]|[^\x{E000}" + fixed.WS_CHARS + _DELIMS + "]+"
    return (f"list_transform(regexp_extract_all(replace({x}, '--', chr(57344)), {sq(pat)}), "
            f"lambda t: replace(t, chr(57344), '--'))")


def d_collapse(x: str) -> str:
    return f"regexp_replace({x}, {sq(chr(10) + fixed.WS + '*' + chr(10))}, chr(10) || chr(10), 'g')"


def d_ascii_ratio(x: str) -> str:
    return (f"(length(regexp_replace({x}, '[^\\x00-\\x7F]', '', 'g'))::DOUBLE "
            f"/ nullif(length({x}), 0))")


def d_word_vocab(src: str) -> str:
    """Vocabulary CTE body: token, token_id (sorted words + 2 specials)."""
    return f"""
      SELECT token, (row_number() OVER (ORDER BY token) - 1)::BIGINT AS token_id
      FROM (SELECT DISTINCT unnest({d_word_split('text')}) AS token FROM {src}) w
      UNION ALL
      SELECT {sq(fixed.ENDOFTEXT)}, (SELECT count(DISTINCT t) FROM (SELECT unnest({d_word_split('text')}) t FROM {src}) z)
      UNION ALL
      SELECT {sq(fixed.UNK)}, (SELECT count(DISTINCT t) FROM (SELECT unnest({d_word_split('text')}) t FROM {src}) z) + 1"""
