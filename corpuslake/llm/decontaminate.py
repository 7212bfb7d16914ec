"""Benchmark passages in documents by the q-gram lemma and banded alignment.

Texts are compared as UTF-8 bytes with A-Z lower-cased and every white-space
byte turned into a blank. A passage of ``L`` bytes found with at most ``k``
edits keeps at least ``L - q + 1 - k * q`` of its q-grams, on diagonals
(document position minus passage position) that span at most ``k``. So

1. every position of a document is looked up among the passages' q-grams (a
   bit table first, then the sorted index);
2. hits are counted, by distinct passage position, in diagonal bands of width
   ``2 * (k + 1)`` that overlap by half: any span of ``k + 1`` lies whole in one;
3. bands that reach the lemma's bound are regions, and a banded alignment of
   the whole passage decides each.

The edit budget ``k`` is ``L // 20``, less where the bound would not be
positive; passages shorter than ``Q`` must occur exactly and as whole words.
Passages are a stated
query set: they are read in blocks of at most ``BLOCK_BYTES`` (the size of each
shipped index is thereby bounded, whatever the benchmark's), every block
against all documents.

Defined results: null and empty texts and passages match nothing, and passages
without a word are as empty ones: those of white space alone (Unicode's), whatever
their length, and those shorter than ``Q`` bytes without a letter or digit. A
passage shorter than ``Q`` bytes does not match inside a word: where it begins or
ends with a letter, mark or digit, no other may stand beside it. Letters of
scripts that put no blanks between words (Chinese, Japanese, Thai, Lao, Khmer,
Burmese) are words of their own. Repeated
rows and passages without an id are matched like any other; a document holding a passage more than once
gives one row, its best place.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K

Q = 14
BLOCK_BYTES = 4 << 20
FAR = 1 << 20
HITS = 1 << 20         # equal q-grams looked at together
_NO_BLANKS = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF),
              (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]


def fold(data: np.ndarray) -> np.ndarray:
    return np.where(K.SPACE[data], np.uint8(32), K.lower_ascii(data))


def budget(length: int, q: int) -> int:
    return 0 if length < Q else min(length // 20, (length - q) // q)


def joins(c: int) -> bool:
    """Whether a word goes on beside this code point."""
    return unicodedata.category(chr(min(c, 0x10FFFF)))[0] in "LMN" and not any(a <= c <= b for a, b in _NO_BLANKS)


def _joined(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """:func:`joins` of the characters that begin at ``at``; false where not ``inside``."""
    at = at[inside]
    b = [data[np.minimum(at + i, len(data) - 1)].astype(np.int64) for i in range(4)]
    low = [x & 63 for x in b]
    code = np.select([b[0] < 0x80, b[0] < 0xE0, b[0] < 0xF0],
                     [b[0], (b[0] & 31) << 6 | low[1], (b[0] & 15) << 12 | low[1] << 6 | low[2]],
                     (b[0] & 7) << 18 | low[1] << 12 | low[2] << 6 | low[3])
    code, back = np.unique(code, return_inverse=True)
    out = np.zeros(len(inside), bool)
    out[inside] = np.array([joins(c) for c in code.tolist()], bool)[back]
    return out


def _distinct(rows):
    """``(document, passage, place, band)`` without repeats, ordered by document, passage, band and place."""
    doc, item, place, band = rows
    low = [int(x.min()) if len(x) else 0 for x in (doc, item, band, place)]
    size = [int(x.max()) - m + 1 if len(x) else 1 for x, m in zip((doc, item, band, place), low)]
    if size[0] * size[1] * size[2] * size[3] < 1 << 62:
        key = np.zeros(len(doc), np.int64)
        for x, m, n in zip((doc, item, band, place), low, size):
            key = key * n + (x - m)
        key = np.unique(key)
        out = []
        for m, n in zip(low[::-1], size[::-1]):
            out.append(key % n + m)
            key = key // n
        place, band, item, doc = out
    else:
        order = np.lexsort((place, band, item, doc))
        doc, item, place, band = (x[order] for x in (doc, item, place, band))
        fresh = np.ones(len(doc), bool)
        fresh[1:] = np.any([x[1:] != x[:-1] for x in (doc, item, place, band)], axis=0)
        doc, item, place, band = (x[fresh] for x in (doc, item, place, band))
    return doc, item, place, band


class PassageIndex:
    """Sorted q-grams of one block's passages of one gram length."""

    def __init__(self, items: list[tuple[int, np.ndarray]], q: int):
        self.q, self.hasher = q, K.Hasher()
        self.ids = [i for i, _ in items]              # may hold nulls
        self.texts = [t for _, t in items]
        self.size = np.array([len(t) for t in self.texts], np.int64)
        self.k = np.array([budget(len(t), q) for t in self.texts], np.int64)
        self.need = self.size - q + 1 - self.k * q
        grams, owner, place = [], [], []
        for n, t in enumerate(self.texts):
            at = np.arange(len(t) - q + 1)
            grams.append(self.hasher.ranges(self.hasher.prefix(t), at, at + q))
            owner.append(np.full(len(at), n))
            place.append(at)
        g = np.concatenate(grams)
        order = np.argsort(g, kind="stable")
        self.gram, self.owner = g[order], np.concatenate(owner)[order]
        self.place = np.concatenate(place)[order]
        self.bits = max(16, min(26, int(len(g) * 64).bit_length()))
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self.gram >> np.uint64(64 - self.bits)] = True

    def hits(self, data: np.ndarray, off: np.ndarray):
        """``(document, position, passage, passage position)`` of all equal q-grams,
        in runs of positions with about ``HITS`` of them."""
        q, n = self.q, len(data) - self.q + 1
        if n <= 0:
            return
        prefix = self.hasher.prefix(data)
        h = K.mix((prefix[q:] - prefix[:n]) * self.hasher.down[:n]
                  + np.uint64(q * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        pos = np.flatnonzero(self.seen[h >> np.uint64(64 - self.bits)])
        doc = np.searchsorted(off, pos, side="right") - 1
        inside = pos + q <= off[doc + 1]
        pos, doc = pos[inside], doc[inside]
        lo = np.searchsorted(self.gram, h[pos], side="left")
        times = np.searchsorted(self.gram, h[pos], side="right") - lo
        total = np.cumsum(times)
        a = 0
        while a < len(pos):
            b = max(int(np.searchsorted(total, (total[a - 1] if a else 0) + HITS, side="right")), a + 1)
            row = np.repeat(np.arange(a, b), times[a:b])
            entry = np.arange(len(row)) - np.repeat(total[a:b] - times[a:b] - (total[a - 1] if a else 0), times[a:b]) \
                + np.repeat(lo[a:b], times[a:b])
            if len(row):
                yield doc[row], pos[row], self.owner[entry], self.place[entry]
            a = b

    def regions(self, data: np.ndarray, off: np.ndarray):
        """``(document, passage, first diagonal)`` of the bands that reach the bound.

        Positions come in ascending runs; a band is counted as soon as no later
        position can lie in it, so only the bands around a run's end are held.
        """
        out, held = [], None
        for doc, pos, item, place in self.hits(data, off):
            band = (pos - place) // (self.k[item] + 1)
            here = [np.concatenate([x, x]) for x in (doc, item, place)] + [np.concatenate([band, band - 1])]
            if held is not None:
                here = [np.concatenate(x) for x in zip(held, here)]
            held = self._settled(here, int(pos[-1]), out)
        if held is not None:
            self._settled(held, None, out)
        return sorted(out)

    def _settled(self, rows, upto: int | None, out: list):
        """Adds the bands that are complete before position ``upto`` to ``out``; the distinct rows of the others."""
        doc, item, place, band = _distinct(rows)
        new_band = np.ones(len(doc), bool)
        new_band[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
        step = self.k[item] + 1
        open_ = np.zeros(len(doc), bool) if upto is None else (band + 2) * step + self.size[item] > upto
        first = np.flatnonzero(new_band)
        count = np.diff(np.append(first, len(doc)))
        first = first[(count >= self.need[item[first]]) & ~open_[first]]
        out += zip(doc[first].tolist(), item[first].tolist(), (band[first] * step[first]).tolist())
        return [x[open_] for x in (doc, item, place, band)]


def banded(patterns: list[np.ndarray], texts: list[np.ndarray], diag: np.ndarray, width: int,
           end_at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits of each whole pattern inside its text, and where that ends.

    Cell ``w`` of row ``i`` stands for text position ``i + diag + w``; all rows
    of a call advance together. Starts are free, or fixed at ``end_at``.
    """
    n, rows = len(patterns), max(len(p) for p in patterns)
    cell = np.arange(width)
    size = np.array([len(t) for t in texts])
    p = np.zeros((n, rows), np.int64)
    for r, x in enumerate(patterns):
        p[r, :len(x)] = x
    t = np.full((n, rows + width + 1), 256, np.int64)
    for r, x in enumerate(texts):
        lo = int(diag[r])
        a, b = max(lo, 0), min(lo + rows + width + 1, len(x))
        if a < b:
            t[r, a - lo:b - lo] = x[a:b]
    at = diag[:, None] + cell
    ok = (at >= 0) & (at <= size[:, None]) if end_at is None else at == end_at[:, None]
    d = np.where(ok, 0, FAR)
    d = np.minimum.accumulate(d - cell, axis=1) + cell if end_at is not None else d
    best, end = np.full(n, FAR), np.zeros(n, np.int64)
    length = np.array([len(x) for x in patterns])
    for i in range(1, rows + 1):
        step = d + (t[:, i - 1:i - 1 + width] != p[:, i - 1:i])
        step[:, :-1] = np.minimum(step[:, :-1], d[:, 1:] + 1)
        d = np.minimum.accumulate(step - cell, axis=1) + cell
        done = np.flatnonzero(length == i)
        if len(done):
            at = i + diag[done][:, None] + cell
            last = np.where((at >= 0) & (at <= size[done][:, None]), d[done], FAR)
            w = last.argmin(axis=1)
            best[done] = last[np.arange(len(done)), w]
            end[done] = i + diag[done] + w
    return best, end


def align(index: PassageIndex, data: np.ndarray, off: np.ndarray, regions):
    """``(document, passage, start, end, edits)`` of the regions within the budget."""
    out, slow = [], {}
    whole = data.tobytes()
    for doc, item, diag in regions:
        text, step = index.texts[item], int(index.k[item]) + 1
        lo = max(int(off[doc]), diag - step)
        hi = min(int(off[doc + 1]), diag + 3 * step + len(text))
        exact = whole.find(text.tobytes(), lo, hi)
        if exact >= 0:
            out.append((doc, item, exact - off[doc], exact - off[doc] + len(text), 0))
        elif index.k[item]:
            slow.setdefault(step, []).append((doc, item, diag))
    for step, rest in slow.items():
        for i in range(0, len(rest), 64):
            part = rest[i:i + 64]
            pats = [index.texts[x] for _, x, _ in part]
            docs = [data[off[d]:off[d + 1]] for d, _, _ in part]
            diag = np.array([g - off[d] - step for d, _, g in part])
            dist, end = banded(pats, docs, diag, 4 * step)
            good = np.flatnonzero(dist <= [index.k[x] for _, x, _ in part])
            if not len(good):
                continue
            # the same alignment backwards from its end gives the start
            size = np.array([len(docs[g]) for g in good])
            back, start = banded([pats[g][::-1] for g in good], [docs[g][::-1] for g in good],
                                 size - end[good] - 2 * step, 4 * step, size - end[good])
            for n, g in enumerate(good):
                out.append((part[g][0], part[g][1], int(size[n] - start[n]), int(end[g]),
                            int(dist[g])))
    return out


def whole_words(index: PassageIndex, data: np.ndarray, off: np.ndarray):
    """:func:`align` for passages shorter than ``Q``: the first place of each in each
    document that is equal and cuts no word."""
    texts = np.stack(index.texts)
    ends = [(joins(ord(t[0])), joins(ord(t[-1]))) for t in (x.tobytes().decode() for x in index.texts)]
    first, last = np.array(ends, bool).T
    out: dict = {}
    for doc, pos, item, _ in index.hits(data, off):      # ascending positions
        end, before = pos + index.q, np.maximum(pos - 1, 0)
        for _ in range(3):
            before = np.where((data[before] & 0xC0) == 0x80, np.maximum(before - 1, 0), before)
        good = ~(first[item] & _joined(data, before, pos > off[doc]))
        good &= ~(last[item] & _joined(data, end, end < off[doc + 1]))
        for i in range(index.q):
            good &= data[pos + i] == texts[item, i]
        doc, pos, item = doc[good], pos[good], item[good]
        _, once = np.unique(doc * len(index.ids) + item, return_index=True)
        for i in once:
            out.setdefault((int(doc[i]), int(item[i])), pos[i] - off[doc[i]])
    return [(d, i, at, at + index.q, 0) for (d, i), at in sorted(out.items())]


def places(index: PassageIndex, data: np.ndarray, off: np.ndarray):
    """``(document, passage, start, end, edits)`` of all passages of the index."""
    return whole_words(index, data, off) if index.q < Q else align(index, data, off, index.regions(data, off))


def _blocks(benchmark: DataFrame, item_col: str, text_col: str):
    """The passages in blocks of bounded size, by running totals of their bytes."""
    b = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("t")) \
        .where(F.col("t").rlike(r"(?U)\S") & ((F.octet_length("t") >= Q) | F.col("t").rlike(r"[\p{L}\p{N}]")))
    # buckets of hashed ids keep every block under the bound without ordering the table
    total = b.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-2 * total // BLOCK_BYTES))
    for i in range(n):
        part = b.where(F.pmod(F.xxhash64("item", "t"), F.lit(n)) == i)
        rows = part.toLocalIterator(prefetchPartitions=False)
        block, size = [], 0
        for r in rows:
            if size + len(r["t"]) > BLOCK_BYTES and block:
                yield block
                block, size = [], 0
            block.append((r["item"], r["t"]))
            size += len(r["t"])
        if block:
            yield block


def _scan(docs: DataFrame, id_type: str, block) -> DataFrame:
    classes: dict[int, list] = {}
    for item, text in block:
        t = fold(np.frombuffer(text.encode(), np.uint8))
        classes.setdefault(min(len(t), Q), []).append((item, t))
    raw = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batches):
        indexes = [PassageIndex(items, q) for q, items in sorted(raw.value.items())]
        for b in batches:
            for lo, text, off in K.text_chunks(b.column(1), K.SMALL_CHUNK):
                data, n, rows = fold(text), len(off) - 1, []
                for ix in indexes:
                    for doc, item, start, end, edits in places(ix, data, off):
                        rows.append((doc, ix.ids[item], int(start), int(end), edits))
                if not rows:
                    continue
                head = np.concatenate([[0], np.cumsum(K.code_points(text))])
                at = lambda d, x: int(head[off[d] + x] - head[off[d]])
                ids = b.column(0).slice(lo, n).take(pa.array([r[0] for r in rows]))
                yield pa.RecordBatch.from_arrays(
                    [ids, b.column(2).slice(lo, n).take(pa.array([r[0] for r in rows])),
                     pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([at(r[0], r[2]) for r in rows], pa.int64()),
                     pa.array([at(r[0], r[3]) for r in rows], pa.int64()),
                     pa.array([r[4] for r in rows], pa.int64())],
                    names=["id", "row", "item_id", "start", "end", "edits"])

    return docs.mapInArrow(K.tidy(run), f"id {id_type}, row long, item_id long, start long, end long, edits long")


def find_passages(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  id_col: str = "doc_id", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """``(id_col, item_id, start, end, edits)``: the best place of every passage in
    every document that holds it within its budget; places in code points."""
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                    F.monotonically_increasing_id().alias("row"))
    out = None
    for block in _blocks(benchmark, item_col, item_text_col):
        part = _scan(d, "long", block)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = d.where(F.lit(False)).select("id", "row", *[
            F.lit(0).cast("long").alias(c) for c in ("item_id", "start", "end", "edits")])
    # regions and bands of one passage in one row, and repeated passages, are few
    w = Window.partitionBy("row", "item_id").orderBy("edits", "start", "end")
    return out.withColumn("_n", F.row_number().over(w)).where("_n = 1") \
        .select(F.col("id").alias(id_col), "item_id", "start", "end", "edits")


def contaminated_rows(batches_docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``batches_docs`` that hold no passage; other columns untouched.

    Decided inside the scan (one block of passages after another), so no text is
    shuffled and rows without or with repeated ids are judged by their own text.
    """
    out = batches_docs
    schema = batches_docs.schema
    at = batches_docs.columns.index(text_col)
    for block in _blocks(benchmark, "item_id", "text"):
        classes: dict[int, list] = {}
        for item, text in block:
            t = fold(np.frombuffer(text.encode(), np.uint8))
            classes.setdefault(min(len(t), Q), []).append((item, t))
        raw = out.sparkSession.sparkContext.broadcast(classes)

        def run(batches, raw=raw):
            indexes = [PassageIndex(items, q) for q, items in sorted(raw.value.items())]
            for b in batches:
                clean = np.ones(b.num_rows, bool)
                for lo, text, off in K.text_chunks(b.column(at), K.SMALL_CHUNK):
                    data = fold(text)
                    for ix in indexes:
                        for doc, *_ in places(ix, data, off):
                            clean[lo + doc] = False
                yield b.filter(pa.array(clean))

        out = out.mapInArrow(K.tidy(run), schema)
    return out
