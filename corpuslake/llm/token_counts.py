"""Token counts by distinct pre-tokens, without materialising ids.

A pre-token is a run of blanks and what follows up to the next run. No piece of
the vocabulary holds a blank after another character (checked when the model is
loaded), so pieces never reach over the border and counts add up. A task counts
the pieces of every distinct pre-token once, joins the counts to the
(document, pre-token) frequencies of its chunk and sums by document. The join
is inside the task: shuffling the frequencies would move more bytes than the
texts have. A vocabulary for which the check fails is applied to whole texts.

Defined results: null and empty texts have no bytes and no tokens.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .encode import MAX_PIECES, blank_starts, piece_bounds, tokenizer_path

_BLANK = K.byte_class(b" ")
BLANK_MARK = "▁"


class PieceCounter:
    """Counts of the pieces of the documents of a chunk."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.hasher, self.known = K.Hasher(), {}
        inner = any(BLANK_MARK in p.lstrip(BLANK_MARK)
                    for p in map(self.sp.id_to_piece, range(self.sp.get_piece_size())))
        count = lambda t: len(self.sp.encode(t, num_threads=1))
        # the model must put one blank before a text for standing-alone pre-tokens to count alike
        self.splits = not inner and self.sp.encode("a b", out_type=str, num_threads=1)[0].startswith(BLANK_MARK)
        self.lone_blank = count("a ") - count("a")

    def _count(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.sp.encode(texts, num_threads=1)]

    def __call__(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        n_docs = len(off) - 1
        if len(self.known) > MAX_PIECES:
            self.known = {}
        cut = blank_starts(data, _BLANK) if self.splits else np.zeros(len(data), bool)
        start, end, per_doc = piece_bounds(cut, off)
        if not len(start):
            return np.zeros(n_docs, np.int64)
        doc = np.repeat(np.arange(n_docs), per_doc)
        # the model itself puts the blank before a text that others bring along
        inner = np.ones(len(start), bool)
        inner[np.searchsorted(start, off[:-1][off[:-1] < off[1:]])] = False
        start = start + inner
        h, first, inverse = np.unique(self.hasher.ranges(self.hasher.prefix(data), start, end),
                                      return_index=True, return_inverse=True)
        keys = h.tolist()
        get = self.known.get
        count = np.array([get(k, -1) for k in keys], np.int64)
        new = np.flatnonzero(count < 0)
        buf = data.tobytes()
        texts = [buf[start[first[i]]:end[first[i]]].decode() for i in new.tolist()]
        for i, t, c in zip(new.tolist(), texts, self._count(texts)):
            count[i] = c if t else self.lone_blank
            self.known[keys[i]] = int(count[i])
        # frequencies of (document, pre-token), joined with the counts
        pair, freq = np.unique(doc * len(keys) + inverse, return_counts=True)
        return np.bincount(pair // len(keys), weights=freq * count[pair % len(keys)],
                           minlength=n_docs).astype(np.int64)


def token_counts(docs: DataFrame, path: str, limit: int = 4096, text_col: str = "text",
                 id_col: str = "doc_id") -> DataFrame:
    """``(id_col, n_bytes, n_tokens, over_limit)``, one row per input row."""

    def run(batches):
        counter = PieceCounter(path)
        for b in batches:
            for lo, data, off in K.text_chunks(b.column(1)):
                n = counter(data, off)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(n)), pa.array(np.diff(off)), pa.array(n)],
                    names=["id", "n_bytes", "n_tokens"])

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return d.mapInArrow(K.tidy(run), "id long, n_bytes long, n_tokens long") \
        .select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                (F.col("n_tokens") > limit).alias("over_limit"))


def count_documents(docs: DataFrame) -> DataFrame:
    """Counts by the public 32k sentencepiece vocabulary."""
    return token_counts(docs, tokenizer_path("piece_bpe_32k.model"))
