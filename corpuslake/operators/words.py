"""Word-level tokenizer against a vocabulary table.

A word vocabulary grows with the corpus, so it is never shipped to a task:
encoding and decoding join with it, in one way at every size. Rows are packed
in blocks (an Arrow pass): a block holds its rows' keys, the distinct tokens and
each row's tokens as numbers into them. Only the distinct tokens are joined, so
the commonest token is one row per block and no join key is hot; their values
come back to the block by its number, where its rows are unpacked (an Arrow pass). Row counts,
order inside rows and errors do not depend on the vocabulary's size, and rows
that share a key stay rows of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..functions.text import word_decode_text, word_split
from ..session import cut_lineage, write_table
from .order import with_ordinal

BLOCK_ROWS = 512           # rows, and
BLOCK_VALUES = 1 << 18     # values at which a block is closed


def build_word_vocab(df: DataFrame, text_col: str = "text", specials: bool = True,
                     blocks: DataFrame | None = None) -> DataFrame:
    """Distinct tokens in code-point order, ids from 0; optionally
    ``<|endoftext|>`` and ``<|unk|>`` appended after the sorted words.

    ``blocks``, the :func:`token_blocks` of ``df``, spare another split of the texts."""
    # distinct inside a document before the shuffle; materialised once: the
    # ordinal and the special ids read it several times
    words = F.array_distinct(word_split(F.col(text_col))) if blocks is None else F.col("words")
    toks = cut_lineage((df if blocks is None else blocks).select(F.explode(words).alias("token")).distinct())
    vocab = with_ordinal(toks, "token", name="token_id") \
        .select("token", F.col("token_id").cast("long"))
    if not specials:
        return vocab
    n = toks.agg(F.count(F.lit(1)).alias("n"))
    extra = n.select(F.explode(F.array(
        F.struct(F.lit(fixed.ENDOFTEXT).alias("token"), F.col("n").alias("token_id")),
        F.struct(F.lit(fixed.UNK).alias("token"), (F.col("n") + 1).alias("token_id")))).alias("x"))
    return vocab.unionByName(extra.select("x.token", F.col("x.token_id").cast("long").alias("token_id")))


def words_and_specials(c, specials=(fixed.ENDOFTEXT,)) -> Column:
    """The text's word tokens, with exact occurrences of specials kept whole."""
    from ..functions.text import split_specials
    return F.flatten(F.transform(split_specials(c, list(specials)), lambda p: F.when(
        p["is_special"], F.array(p["s"])).otherwise(word_split(p["s"]))))


def _blocks(it, names):
    """``(block, keys, words, codes)`` rows: at most ``BLOCK_ROWS`` input rows each."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 33
    for rb in it:
        lists = rb.column(1)
        at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0)
                                            .to_numpy(zero_copy_only=False))])
        lo = 0
        while lo < rb.num_rows:
            hi = int(np.searchsorted(at, at[lo] + BLOCK_VALUES, side="right")) - 1
            hi = min(max(hi, lo + 1), lo + BLOCK_ROWS, rb.num_rows)
            enc = pc.dictionary_encode(lists.slice(lo, hi - lo).flatten(), null_encoding="encode")
            codes = pa.ListArray.from_arrays(pa.array(at[lo:hi + 1] - at[lo], pa.int32()),
                                             enc.indices.cast(pa.int32()))
            one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), one(rb.column(0).slice(lo, hi - lo)),
                 one(enc.dictionary), one(codes)], names=names)
            number, lo = number + 1, hi


def _unpacked(block: pa.Table, values: pa.Table, names) -> pa.Table:
    """``(key, list)`` rows of one block, each code replaced by the value of that number."""
    lists = block.column("codes").combine_chunks().flatten()
    at = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
    place = np.empty(values.num_rows, np.int64)
    place[values.column("i").to_numpy()] = np.arange(values.num_rows)
    taken = values.column("x").combine_chunks().take(pa.array(place[lists.flatten().to_numpy()]))
    return pa.Table.from_arrays([block.column("keys").combine_chunks().flatten(),
                                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), taken)], names=names)


def token_blocks(df: DataFrame, key: str = "doc_id", values: Column | None = None, text_col: str = "text") -> DataFrame:
    """Every row's list ``values`` (the words of ``text_col`` if not given) in written blocks
    ``(block, keys, words, codes)``."""
    d = df.select(F.col(key), (word_split(F.col(text_col)) if values is None else values).alias("_v"))
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("keys", T.ArrayType(d.schema[key].dataType)),
        T.StructField("words", T.ArrayType(d.schema["_v"].dataType.elementType)),
        T.StructField("codes", T.ArrayType(T.ArrayType(T.IntegerType())))])
    names = schema.fieldNames()
    return write_table(d.mapInArrow(lambda it: _blocks(it, names), schema), "word-blocks")


def mapped_blocks(blocks: DataFrame, key: str, table: DataFrame, missing) -> DataFrame:
    """:func:`mapped_lists` of the rows in :func:`token_blocks`."""
    words = blocks.select("block", F.posexplode("words").alias("i", "v"))
    value = F.coalesce(F.col("new"), missing(F.col("v")))
    new = words.join(table, "v", "left").select(F.col("block").alias("at"), "i", value.alias("x"))
    out = T.StructType([T.StructField(key, blocks.schema["keys"].dataType.elementType),
                        T.StructField("_out", T.ArrayType(new.schema["x"].dataType))])
    return blocks.select("block", "keys", "codes").groupBy("block").cogroup(new.groupBy("at")) \
        .applyInArrow(lambda block, values: _unpacked(block, values, out.fieldNames()), out)


def mapped_lists(df: DataFrame, key: str, values: Column, table: DataFrame, missing) -> DataFrame:
    """``(key, _out)``: every row's list with each value ``v`` replaced by its ``new``
    in ``table(v, new)``; ``missing(v)`` is the column for a value not there."""
    return mapped_blocks(token_blocks(df, key, values), key, table, missing)


def _token_to_id(vocab: DataFrame) -> DataFrame:
    """One id per token; a word equal to a special string takes the special's
    (later) id, as a dict filled in id order would."""
    return vocab.groupBy("token").agg(F.max("token_id").alias("token_id"))


def word_encode(df: DataFrame, vocab: DataFrame, text_col: str = "text", key: str = "doc_id",
                on_unknown: str = "error", tokens: Column | None = None,
                blocks: DataFrame | None = None) -> DataFrame:
    """``(key, ids)``. Unknown tokens raise (``error``) or map to
    the ``<|unk|>`` id (``unk``; without such an entry that raises too).

    ``tokens`` replaces the word split of ``text_col``; a null list is empty. ``blocks``,
    the :func:`token_blocks` of ``df``, spare another split of the texts."""
    if on_unknown not in ("error", "unk"):
        raise ValueError(f"on_unknown={on_unknown!r}")
    ids = _token_to_id(vocab)
    unk = ids.where(F.col("token") == fixed.UNK).select("token_id").scalar()

    def missing(v):
        fail = F.raise_error(F.concat(F.lit("unknown token: "), v)).cast("long")
        return fail if on_unknown == "error" else F.coalesce(unk, F.raise_error(
            F.lit("vocabulary has no <|unk|> entry")).cast("long"))

    table = ids.select(F.col("token").alias("v"), F.col("token_id").cast("long").alias("new"))
    if blocks is None:
        blocks = token_blocks(df, key, tokens, text_col)
    return mapped_blocks(blocks, key, table, missing).withColumnRenamed("_out", "ids")


def word_decode(df: DataFrame, vocab: DataFrame, ids_col: str = "ids", key: str = "doc_id",
                punct: str = fixed.DECODE_PUNCT_V2) -> DataFrame:
    """Ids -> tokens joined by spaces, no space before punctuation; unknown ids raise."""
    table = vocab.select(F.col("token_id").cast("long").alias("v"), F.col("token").alias("new"))
    out = mapped_lists(df, key, F.col(ids_col).cast("array<long>"), table, lambda v: F.raise_error(
        F.concat(F.lit("unknown id: "), v.cast("string"))).cast("string"))
    return out.select(key, word_decode_text(F.col("_out"), punct).alias("text"))
