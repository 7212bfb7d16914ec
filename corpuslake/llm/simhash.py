"""Near duplicates by SimHash: exact comparison of tiles of fingerprints.

1. Every whole text becomes a 64-bit fingerprint in one map: a bit is set where
   over half of the shingles' XXH64 hashes (seed 42) have it.
2. Equal fingerprints are one. Distinct ones are cut into tiles by the population
   counts of their four 16-bit quarters (strips of ``STRIP`` counts; a tile of more
   than ``TILE`` fingerprints is dealt over several by hash).
3. The distance of two fingerprints is at least the sum of their quarters'
   differences in population count. Tile pairs whose strips are further apart than
   the radius are never made: every tile looks up the few neighbouring strips by an
   equi-join. All other pairs are compared in full, block by block, with exclusive-or
   and bit counts; inside a tile, blocks are skipped by the counts of eight bytes.
4. A tile pair gives a spanning forest of its links, never all of them. Components
   of the forests are the classes.

Nothing is approximate: the skipped pairs cannot be links. The number of compared
pairs stays quadratic, at about a hundredth of all pairs; a fingerprint is copied
to the neighbours of its tile (some dozens of 8 bytes), and once more for every
``TILE`` fingerprints that a tile's strip holds beyond the first.

Defined results: null, empty and wordless texts have fingerprint zero and link like
any other; a text of fewer words than a shingle is one shingle; repeated rows give
repeated results; rows that share an id are all compared, and their class is that of
each row's own text; a null id has the component of its class, or null where the
class holds no id. Extra columns are ignored, texts are read whole, and an empty
table gives an empty one.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.linkage import connected_components
from ..operators.skew import skew_join
from ..session import write_table
from . import kernels as K

TILE = 1 << 16         # fingerprints in one tile
BLOCK = 256            # fingerprints compared at once
STRIP = 2              # population counts of a quarter that share a strip
FANOUT = 32            # children of a node in a class's tree of links


def squeezed(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """The words one blank apart: bytes, starts and ends in them."""
    size = end - start
    at = np.cumsum(size + 1) - (size + 1)
    total = int(size.sum())
    word = np.repeat(np.arange(len(start)), size)
    inner = np.arange(total)
    first = np.cumsum(size) - size
    out = np.full(total + len(start), 32, np.uint8)
    out[inner + word] = data[inner - first[word] + start[word]]
    return out, at, at + size


def fingerprints_of(data: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """Fingerprints of lower-cased texts."""
    n_docs = len(off) - 1
    start, end, doc = K.words(data, off)
    text, begin, stop = squeezed(data, start, end)
    text = text.tobytes()
    n_words = np.bincount(doc, minlength=n_docs)
    n_shingles = np.where(n_words > 0, np.maximum(n_words - k + 1, 1), 0)
    first_word = np.cumsum(n_words) - n_words
    owner = np.repeat(np.arange(n_docs), n_shingles)
    head = np.arange(len(owner)) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles) + first_word[owner]
    tail = head + np.minimum(n_words[owner], k) - 1
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(text[a:b], 42) for a, b in zip(begin[head].tolist(), stop[tail].tolist())], np.uint64)
    out = np.zeros(n_docs, np.uint64)
    some = np.flatnonzero(n_shingles)
    if len(some):
        bounds = (np.cumsum(n_shingles) - n_shingles)[some]
        for bit in range(64):
            ones = np.add.reduceat(((h >> np.uint64(bit)) & np.uint64(1)).astype(np.int64), bounds)
            out[some] |= (2 * ones > n_shingles[some]).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints(docs: DataFrame, text_col: str, id_col: str, k: int) -> DataFrame:
    """``(id, fp)``: the fingerprint of every row as a signed long."""

    def run(batches):
        for b in batches:
            for lo, data, off in K.text_chunks(b.column(1)):
                fp = fingerprints_of(K.lower_ascii(data), off, k)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(fp)), pa.array(fp.view(np.int64))], names=["id", "fp"])

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(K.tidy(run), "id long, fp long")


def byte_counts(fp: np.ndarray) -> np.ndarray:
    """Population counts of the eight bytes, one row per fingerprint."""
    return np.bitwise_count(fp.view(np.uint8).reshape(-1, 8)).astype(np.int16)


def blocks(fp: np.ndarray):
    """Fingerprints ordered by their bytes' population counts, with each block's least and greatest counts."""
    fp = np.ascontiguousarray(fp, np.uint64)
    counts = byte_counts(fp)
    quarters = counts[:, 0::2] + counts[:, 1::2]
    order = np.lexsort(np.concatenate([counts[:, 0::2], quarters], axis=1).T)
    fp, counts = fp[order], counts[order]
    at = np.arange(0, len(fp), BLOCK)
    both = np.concatenate([counts, quarters[order]], axis=1)
    return fp, np.minimum.reduceat(both, at), np.maximum.reduceat(both, at)


def forest(one, two, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """``(child, parent)`` fingerprints of a spanning forest of the links between
    two tiles' :func:`blocks`, or inside one (``two`` is None)."""
    b, two = two, one if two is None else two
    nodes = one[0] if b is None else np.concatenate([one[0], two[0]])
    shift = 0 if b is None else len(one[0])
    root = np.arange(len(nodes))
    for i in range(len(one[1])):
        gap = np.maximum(np.maximum(two[1] - one[2][i], one[1][i] - two[2]), 0)
        near = np.flatnonzero((gap[:, :8].sum(axis=1) <= radius) & (gap[:, 8:].sum(axis=1) <= radius))
        left = one[0][i * BLOCK:(i + 1) * BLOCK]
        for j in near[near >= i] if b is None else near:
            right = two[0][j * BLOCK:(j + 1) * BLOCK]
            x, y = np.nonzero(np.bitwise_count(left[:, None] ^ right[None, :]) <= radius)
            x, y = x + i * BLOCK, y + j * BLOCK + shift
            apart = root[x] != root[y]
            while apart.any():
                low, high = np.minimum(root[x], root[y])[apart], np.maximum(root[x], root[y])[apart]
                np.minimum.at(root, high, low)
                while (root[root] != root).any():
                    root = root[root]
                apart = root[x] != root[y]
    member = np.flatnonzero((root != np.arange(len(root))) | (np.bincount(root, minlength=len(root))[root] > 1))
    member = member[np.argsort(root[member], kind="stable")]
    if not len(member):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    fresh = np.flatnonzero(np.diff(root[member], prepend=-1))
    size = np.diff(np.append(fresh, len(member)))
    place = np.arange(len(member)) - np.repeat(fresh, size)
    child = np.flatnonzero(place > 0)
    parent = np.repeat(fresh, size)[child] + (place[child] - 1) // FANOUT
    return nodes[member[child]], nodes[member[parent]]


def tiles(fps: DataFrame, tile: int) -> DataFrame:
    """``(q0..q3, part, tile, fps)``: the strips of a tile's quarters, its number among
    the tiles of the same strips, and its fingerprints."""
    strips = [F.expr(f"cast(bit_count(shiftrightunsigned(fp, {16 * i}) & 65535) div {STRIP} as int)").alias(f"q{i}")
              for i in range(4)]
    q = [f"q{i}" for i in range(4)]
    cut = fps.select("fp", *strips)
    need = cut.groupBy(*q).agg(F.ceil(F.count(F.lit(1)) / tile).alias("parts"))
    need = need.where("parts > 1")                  # fewer than 9^4 / STRIP^4 rows, as strips are
    part = F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1)))
    return cut.join(F.broadcast(need), q, "left").withColumn("part", part) \
        .groupBy(*q, "part").agg(F.collect_list("fp").alias("fps"))


def tile_pairs(names: DataFrame, radius: int) -> DataFrame:
    """``(a, b)`` of all tiles near enough to hold links, each pair once, ``a = b`` included.

    ``names(q0..q3, part)``; strips that differ by ``d > 0`` hold counts that differ
    by at least ``STRIP * (d - 1) + 1``.
    """
    reach = (radius - 1) // STRIP + 1
    cost = [0 if d == 0 else STRIP * (abs(d) - 1) + 1 for d in range(-reach, reach + 1)]
    steps = [s for s in itertools.product(range(-reach, reach + 1), repeat=4)
             if s >= (0, 0, 0, 0) and sum(cost[d + reach] for d in s) <= radius]
    step = F.explode(F.array(*[F.struct(*[F.lit(d).alias(f"d{i}") for i, d in enumerate(s)]) for s in steps]))
    a = names.select(F.struct("q0", "q1", "q2", "q3", "part").alias("a"), step.alias("s"))
    a = a.select("a", *[(F.col(f"a.q{i}") + F.col(f"s.d{i}")).alias(f"q{i}") for i in range(4)],
                 (F.expr("s.d0 = 0 and s.d1 = 0 and s.d2 = 0 and s.d3 = 0")).alias("same"))
    b = names.select("q0", "q1", "q2", "q3", "part", F.struct("q0", "q1", "q2", "q3", "part").alias("b"))
    return a.join(b, ["q0", "q1", "q2", "q3"]).where("not same or a.part <= part").select("a", "b")


def links(fps: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """``(src, dst)``: spanning forests of the links among distinct ``fps(fp)``.

    A task gets a tile and the neighbours of one part number: at most one tile for
    each strip in reach.
    """
    cut = write_table(tiles(fps, tile), "simhash-tiles")
    name = F.struct("q0", "q1", "q2", "q3", "part")
    pairs = write_table(tile_pairs(cut.select("q0", "q1", "q2", "q3", "part"), radius)
                        .withColumn("part", F.col("b.part")), "simhash-pairs")
    others = pairs.where("a != b").join(cut.select(name.alias("b"), "fps"), "b") \
        .select("a", "part", F.lit(False).alias("first"), "fps")
    firsts = pairs.select("a", "part").distinct().join(cut.select(name.alias("a"), "fps"), "a") \
        .select("a", "part", F.lit(True).alias("first"), "fps")
    own = F.col("a.part") == F.col("part")

    def run(group):
        first = np.array(group["first"].to_pylist())
        lists = group["fps"].combine_chunks()
        flat, at = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
        cells = [blocks(flat[at[i]:at[i + 1]]) for i in range(len(first))]
        me = cells[int(np.flatnonzero(first)[0])]
        found = [forest(me, None, radius)] if group["own"][0].as_py() else []
        found += [forest(me, c, radius) for c, f in zip(cells, first) if not f]
        child, parent = (np.concatenate([f[i] for f in found] + [np.zeros(0, np.uint64)]) for i in (0, 1))
        return pa.table({"src": pa.array(child.view(np.int64)), "dst": pa.array(parent.view(np.int64))})

    both = others.unionByName(firsts).select(F.struct("a", "part").alias("key"), own.alias("own"), "first", "fps")
    return both.groupBy("key").applyInArrow(run, "src long, dst long").distinct()


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", k: int = 5,
                    radius: int = 3, tile: int = TILE) -> DataFrame:
    """``(id_col, fingerprint, component_id)``, one row per input row: fingerprints of
    ``k``-word shingles (repeats included) link at ``radius`` or fewer differing bits."""
    rows = write_table(fingerprints(docs, text_col, id_col, k).withColumn("at", F.monotonically_increasing_id()),
                       "simhash-fps")
    fps = write_table(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    linked = connected_components(write_table(links(fps.select("fp"), radius, tile), "simhash-links"))
    group = linked.join(fps, F.col("node") == F.col("fp")).groupBy("label").agg(F.min("least").alias("component_id"))
    of = skew_join(linked.withColumnRenamed("node", "fp"), group, "label", spread=["fp"]).select("fp", "component_id")
    heads = fps.where("n > 1").select("fp", "least", "n").join(of, "fp", "full") \
        .select("fp", F.coalesce("component_id", "least").alias("component_id"))
    out = skew_join(rows, heads, "fp", "left", spread=["at"])
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.coalesce("component_id", "id").alias("component_id"))
