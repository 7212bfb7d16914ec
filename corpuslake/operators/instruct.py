"""Instruction records, prompt formatting, collation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed


def pairs_from_conversations(conv: DataFrame) -> DataFrame:
    """A user turn directly followed by an assistant turn becomes
    ``(instruction, input, output)``; a system turn directly before the user
    turn becomes ``input`` (else ``''``). Window per conversation only."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    d = conv.select("conv_id", "turn", "role", "text",
                    F.lead("role").over(w).alias("next_role"),
                    F.lead("text").over(w).alias("next_text"),
                    F.lag("role").over(w).alias("prev_role"),
                    F.lag("text").over(w).alias("prev_text"))
    d = d.where((F.col("role") == "user") & (F.col("next_role") == "assistant"))
    return d.select("conv_id", "turn", F.col("text").alias("instruction"),
                    F.when(F.col("prev_role") == "system", F.col("prev_text"))
                    .otherwise(F.lit("")).alias("input"),
                    F.col("next_text").alias("output"))


def sft_collate(df: DataFrame, ids_col: str = "ids", batch_col: str = "batch_id",
                pad: int = fixed.PAD_ID, ignore: int = fixed.IGNORE_INDEX,
                max_len: int | None = None, collate=None) -> DataFrame:
    """S3: per batch, M = longest + 1; append one pad and right-pad to M;
    input = all but last, target = shifted by one; in the target every pad
    after the first pad becomes ``ignore``; then truncate both to max_len.
    ``collate`` (a function from rows to rows) takes the place of all this."""
    if collate is not None:
        return collate(df)
    w = Window.partitionBy(batch_col)
    m = F.max(F.size(ids_col)).over(w) + 1
    d = df.withColumn("_m", m)
    padded = F.concat(F.col(ids_col), F.array_repeat(F.lit(pad), F.col("_m") - F.size(ids_col)))
    d = d.withColumn("_p", padded)
    inp = F.slice("_p", 1, F.col("_m") - 1)
    tgt = F.slice("_p", 2, F.col("_m") - 1)
    d = d.withColumn("input_ids", inp).withColumn("_t", tgt)
    first = F.array_position("_t", pad)
    masked = F.transform("_t", lambda x, i: F.when((x == pad) & (first > 0) & (i + 1 > first),
                                                    F.lit(ignore)).otherwise(x))
    d = d.withColumn("target_ids", masked)
    if max_len is not None:
        d = d.withColumn("input_ids", F.slice("input_ids", 1, max_len)) \
            .withColumn("target_ids", F.slice("target_ids", 1, max_len))
    return d.drop("_m", "_p", "_t")
