"""Dataset order made explicit — ordinals and running sums without a
single-task window.

Rows are range-partitioned on the whole order (any type, all columns, so a
common prefix or one frequent leading value is still cut into ranges), sorted
inside their range and written once; the row's place in its range is its
number there, and a table of one row per range gives the numbers and sums
before it. Pass only the order and size columns where rows are wide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_table

_PLACE_BITS = 33          # of monotonically_increasing_id: row number inside the partition


def _default_buckets(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)


def ranged(df: DataFrame, order: list[Column], num_buckets: int | None = None) -> DataFrame:
    """``df`` written in ranges of ``order``, with ``_bucket`` and ``_place`` of every row."""
    p = num_buckets or _default_buckets(df)
    at = F.monotonically_increasing_id()
    t = write_table(df.repartitionByRange(p, *order).sortWithinPartitions(*order)
                    .withColumn("_at", at), "ranges")
    return t.withColumn("_bucket", F.shiftright("_at", _PLACE_BITS).cast("int")) \
        .withColumn("_place", F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))).drop("_at")


def global_offsets(df: DataFrame, order, size: str | Column | None = None,
                   num_buckets: int | None = None, ordinal_col: str = "ordinal",
                   offset_col: str = "offset") -> DataFrame:
    """Ordinal (0-based) and exclusive running sum of ``size`` in ``order``.

    ``order`` is a column name or list of names forming a total order. Equal to
    ``row_number() over (order by ...) - 1`` and ``sum(size) over (order by ...
    rows unbounded preceding to 1 preceding)``.
    """
    order = [order] if isinstance(order, (str, Column)) else list(order)
    ocols = [F.col(o) if isinstance(o, str) else o for o in order]
    sz = None if size is None else (F.col(size) if isinstance(size, str) else size)

    b = ranged(df if sz is None else df.withColumn("_sz", sz), ocols, num_buckets)
    totals = b.groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("_bn"),
        *([F.sum("_sz").alias("_bs")] if sz is not None else []))
    # one row per range: the prefix over ranges is a tiny single-partition window
    wb = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "_bucket",
        F.coalesce(F.sum("_bn").over(wb), F.lit(0)).alias("_bn0"),
        *([F.coalesce(F.sum("_bs").over(wb), F.lit(0)).alias("_bs0")] if sz is not None else []))

    out = b
    if sz is not None:
        w = Window.partitionBy("_bucket").orderBy("_place")
        out = out.withColumn("_run", F.sum("_sz").over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    out = out.join(F.broadcast(totals), "_bucket")
    out = out.withColumn(ordinal_col, (F.col("_bn0") + F.col("_place")).cast("long"))
    if sz is not None:
        out = out.withColumn(offset_col, F.col("_bs0") + F.col("_run") - F.col("_sz"))
    return out.drop("_bucket", "_place", "_run", "_sz", "_bn0", "_bs0")


def with_ordinal(df: DataFrame, order, num_buckets: int | None = None,
                 name: str = "ordinal") -> DataFrame:
    """Ordinal only (see :func:`global_offsets`)."""
    return global_offsets(df, order, None, num_buckets, ordinal_col=name)


def partitioned_offsets(df: DataFrame, partition: str, order, size: str | Column | None = None,
                        num_buckets: int | None = None, ordinal_col: str = "ordinal",
                        offset_col: str = "offset") -> DataFrame:
    """Ordinal and exclusive running sum restarting at every ``partition`` value.

    Skew-safe form of ``row_number()/sum() over (partition by p order by o)``:
    the running values are taken over the total order ``(partition, order)``
    (ranges cut through a huge partition) and each partition's starting
    values (one row per partition, a groupBy) are subtracted.
    """
    order = [order] if isinstance(order, (str, Column)) else list(order)
    g = global_offsets(df, [partition] + order, size, num_buckets,
                       ordinal_col="_go", offset_col="_gs")
    aggs = [F.min("_go").alias("_go0")]
    if size is not None:
        aggs.append(F.min("_gs").alias("_gs0"))
    starts = g.groupBy(partition).agg(*aggs)
    out = g.join(starts, g[partition].eqNullSafe(starts[partition])).drop(starts[partition])
    out = out.withColumn(ordinal_col, F.col("_go") - F.col("_go0"))
    if size is not None:
        out = out.withColumn(offset_col, F.col("_gs") - F.col("_gs0"))
    return out.drop("_go", "_go0", "_gs", "_gs0")
