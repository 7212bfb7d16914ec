"""Equi-joins whose keys may each hold any share of the rows.

Keys with more than one ``hot``-th of all rows are found by a heavy-hitter sketch
(Spark's ``approx_top_k``, a frequent-items sketch with partial aggregation, over the
key's hash). Their rows are dealt over as many salts as their share asks for, and
their rows of the other side are copied to each salt; all other rows join as ever. At
most ``2 * hot`` salts exist whatever the data, so the table of them is broadcast.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT = 256              # a key with more than 1/HOT of the rows is dealt over salts
TRACKED = 8192         # counters of the sketch; its error is below 3.5 / TRACKED of the rows


def heavy_hitters(rows: DataFrame, keys: list[str], hot: int = HOT) -> dict[int, int]:
    """``{hash of the key: salts}`` of every key with more than one ``hot``-th of ``rows``.

    A sketch may count a key short by its error, so keys down to three quarters of that
    share may be in it. Null keys are left out. Collisions of hashes only add salts.
    """
    if not 1 <= hot <= TRACKED // 16:
        raise ValueError(f"the sketch finds shares down to 1/{TRACKED // 16}")
    seen = rows.where(_known(keys)).agg(
        F.expr(f"approx_top_k({_hash_sql(keys)}, {2 * hot}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return {r["item"]: math.ceil(r["count"] * hot / seen.n) for r in seen.top or [] if r["count"] * hot > 0.75 * seen.n}


def skew_join(rows: DataFrame, build: DataFrame, on: list[str] | str, how: str = "inner",
              spread: list[str] | None = None, hot: int = HOT, salts: dict[int, int] | None = None) -> DataFrame:
    """``rows`` joined (``inner`` or ``left``) with ``build`` on equal ``on`` columns.

    ``spread`` are columns of ``rows`` that tell rows of a hot key apart (all columns
    if not given): a row's salt is a hash of them, so a lost task deals its rows alike.
    ``rows`` is read twice, once for its keys alone, unless ``salts`` gives the
    :func:`heavy_hitters` of the same keys. Null keys match nothing; in a left join they
    are dealt over tasks as well.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left"):
        raise ValueError(f"no {how} join here")
    salts = heavy_hitters(rows, keys, hot) if salts is None else salts
    known = _known(keys)
    if how == "inner":
        rows = rows.where(known)
    table = rows.sparkSession.createDataFrame([(h, n) for h, n in salts.items()], "_hot long, _salts int")
    value = F.xxhash64(*[F.col(f"`{c}`") for c in (spread or rows.columns)])
    dealt = rows.join(F.broadcast(table), F.when(known, _hash(keys)) == F.col("_hot"), "left") \
        .withColumn("_salt", F.when(~known, F.pmod(value, F.lit(hot)))
                    .otherwise(F.coalesce(F.pmod(value, F.col("_salts")), F.lit(0))).cast("long")).drop("_hot", "_salts")
    copies = build.join(F.broadcast(table), _hash(keys) == F.col("_hot"), "left") \
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_salts"), F.lit(1)).cast("long") - 1))) \
        .drop("_hot", "_salts")
    return dealt.join(copies, [*keys, "_salt"], how).drop("_salt")


def _known(keys: list[str]) -> Column:
    return F.expr(" and ".join(f"`{c}` is not null" for c in keys))


def _hash_sql(keys: list[str]) -> str:
    return f"xxhash64({', '.join(f'`{c}`' for c in keys)})"


def _hash(keys: list[str]) -> Column:
    return F.expr(_hash_sql(keys))
