"""Prefix trie of conversations by burst tries.

1. Turns are numbered within their conversation and reduced to a 128-bit turn id of
   role and text, so no text is shuffled. Conversations are rebuilt from the first
   turns of their hundred's first conversation and their own later turns.
2. Equal conversations are one member class with a weight.
3. A container holds the suffixes of all classes below a trie head; the first is the
   root's. A container of more than ``limit`` turns bursts: its suffixes' next turn
   ids become heads of their own, counted by one aggregate, while the others are
   done. A round bursts all oversized containers of one depth, so there are as many
   rounds as turns shared by the suffixes of more than ``limit`` turns.
4. What remains is swept. A container of one class is a path, whose nodes follow row
   by row from running sums. The others hold at most ``limit`` turns each; they are
   sorted and swept into nodes, one container a call.
5. Totals of the containers (leaves, saved tokens) are added up from the deepest
   heads to the root.

A node is named by its smallest member and its depth, which no other node shares.

Defined results: rows without a conversation id belong to no conversation; a null
role or text is empty; turns are ordered by number, null first, and equal numbers by
turn id (repeated rows are repeated turns); ``c % 100`` keeps the sign of c; ids of
any type are read as whole numbers; texts and conversations of any length are whole;
extra columns are ignored; no conversations give no nodes, not even a root.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import partitioned_offsets
from ..operators.skew import skew_join
from ..session import write_table
from . import kernels as K

LIMIT = 1024           # turns in a container that is swept in one call
HEADS = 6              # turns taken from another conversation: fewer than this
GROUP = 100            # conversations that share the first one's head
ID_RANGE = 8           # log2 of the consecutive ids whose list is one block of text
_EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends string")


def turns(conv: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``(conv, pos, tid, chars, before)``: place, id and code points of every turn, and
    the code points of the turns before it."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conv.where(F.col(id_col).cast("long").isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.md5(F.concat_ws(":", F.length(role).cast("string"), role, text).cast("binary")).alias("tid"),
        F.length(text).cast("long").alias("chars"))
    at = partitioned_offsets(rows, "conv", [F.col("turn").asc_nulls_first(), F.col("tid")], "chars",
                             ordinal_col="pos", offset_col="before")
    return write_table(at.select("conv", "pos", "tid", "chars", "before"), "trie-turns")


def rebuilt(at: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv, depth, tid, chars, before)`` of the rebuilt conversations' turns, and
    ``(conv, h, base)`` of all conversations."""
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    convs = write_table(at.groupBy("conv").agg(F.sum(F.when(F.col("pos") < head, F.col("chars"))).alias("skipped"))
                        .withColumn("h", head).withColumn("base", F.col("conv") - F.col("conv") % GROUP), "trie-convs")
    first = at.where(F.col("pos") < HEADS - 1).where(F.col("conv") % GROUP == 0)
    taken = write_table(convs.join(first.withColumnRenamed("conv", "base"), "base").where("pos < h")
                        .select("conv", (F.col("pos") + 1).alias("depth"), "tid", "chars", "before"), "trie-taken")
    heads = taken.groupBy("conv").agg(F.count(F.lit(1)).alias("k"), F.sum("chars").alias("taken"))
    none = F.lit(0)
    shift = convs.join(heads, "conv", "left").select(
        "conv", (F.coalesce("k", none) - F.col("h")).alias("move"),
        (F.coalesce("taken", none) - F.coalesce("skipped", none)).alias("more"))
    rest = skew_join(at, shift, "conv", spread=["pos"]).where(F.col("pos") >= head).select(
        "conv", (F.col("pos") + 1 + F.col("move")).alias("depth"), "tid", "chars",
        (F.col("before") + F.col("more")).alias("before"))
    return write_table(taken.unionByName(rest), "trie-rebuilt"), convs


def classes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """``(cls, w, n, chars, ends)``: equal conversations under their smallest id, how many
    they are, their turns and code points, and the digest of their ids."""
    mark = [F.hex(F.expr(f"bit_xor(xxhash64('{s}', depth, tid))")) for s in "ab"]
    sums = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), *mark)
    sums = sums.toDF("conv", "n", "chars", "m1", "m2")
    every = write_table(convs.join(sums, "conv", "left").select(
        "conv", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("chars", F.lit(0)).alias("chars"),
        F.concat_ws(":", F.coalesce("n", F.lit(0)).cast("string"), "m1", "m2").alias("fp")), "trie-members")
    found = every.groupBy("fp").agg(F.min("conv").alias("cls"), F.count(F.lit(1)).alias("w"), F.min("n").alias("n"),
                                    F.min("chars").alias("chars"))
    # ids as text, a block for each range of ids; the blocks of a class in order into one digest
    block = every.groupBy("fp", F.shiftright("conv", ID_RANGE).alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("ids"))

    def digest(batches):
        last, sha = None, None
        for b in batches:
            done = []
            for fp, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if fp == last:
                    sha.update(b"," + ids.encode())
                    continue
                if last is not None:
                    done.append((last, sha.hexdigest()))
                last, sha = fp, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)],
                                             names=["fp", "ends"])
        if last is not None:
            yield pa.RecordBatch.from_pydict({"fp": [last], "ends": [sha.hexdigest()]})

    ends = block.repartition("fp").sortWithinPartitions("fp", "block").select("fp", "ids") \
        .mapInArrow(K.tidy(digest), "fp string, ends string")
    return write_table(found.join(ends, "fp").drop("fp"), "trie-classes")


def burst(rows: DataFrame, found: DataFrame, limit: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """The containers that are left, ``(cls, w, n, chars, ends, head, depth0, members)`` of
    every class, and the heads of every depth, ``(node, parent, n_convs, chars, ends, size, members)``."""
    root = found.agg(F.min("cls").alias("node"), F.lit(None).cast("long").alias("parent"), F.sum("w").alias("n_convs"),
                     F.lit(0).cast("long").alias("chars"), F.max(F.when(F.col("n") == 0, F.col("ends"))).alias("ends"),
                     F.sum("n").alias("size"), F.count(F.lit(1)).alias("members")).where("node is not null")
    heads = write_table(root, "trie-heads")
    least = heads.agg(F.min("node")).first()[0]
    inside = found.withColumn("head", F.lit(least).cast("long"))
    levels, done = [heads], []
    while True:
        depth = len(levels)
        state = heads.select(F.col("node").alias("head"), "members", ((F.col("size") > limit) & (F.col("members") > 1)).alias("over"))
        inside = write_table(inside, "trie-inside")
        inside = write_table(skew_join(inside, state, "head", spread=["cls"]), "trie-inside")
        done.append(inside.where("not over").drop("over").withColumn("depth0", F.lit(depth - 1).cast("long")))
        open_ = inside.where(f"over and n >= {depth}").drop("over", "members")
        if open_.limit(1).count() == 0:
            return done, levels
        # the next turn of every class is the head of its new container
        nxt = rows.where(F.col("depth") == depth).select(F.col("conv").alias("cls"), "tid", F.col("chars").alias("c"))
        step = write_table(open_.join(nxt, "cls").withColumn("key", F.concat_ws(":", F.col("head").cast("string"), "tid")),
                           "trie-next")
        new = write_table(step.groupBy("key").agg(
            F.min("cls").alias("node"), F.min("head").alias("parent"), F.sum("w").alias("n_convs"), F.min("c").alias("chars"),
            F.max(F.when(F.col("n") == depth, F.col("ends"))).alias("ends"), F.sum(F.col("n") - depth).alias("size"),
            F.count(F.lit(1)).alias("members")), "trie-heads")
        inside = skew_join(step.drop("head", "tid", "c"), new.select("key", F.col("node").alias("head")), "key", spread=["cls"]).drop("key")
        heads = new.drop("key")
        levels.append(heads)


def sweep(container: pd.DataFrame) -> pd.DataFrame:
    """Nodes below a container's head, and a row of depth -1 with the head's totals.

    ``container`` has a row ``(head, depth0, cls, w, ends, tids, lens)`` per class:
    the turn ids and code points of its turns after the head.
    """
    head, depth0 = int(container["head"].iloc[0]), int(container["depth0"].iloc[0])
    suffixes = sorted(((list(t), list(n), c, w, e) for t, n, c, w, e in zip(
        container["tids"], container["lens"], container["cls"], container["w"], container["ends"])), key=lambda x: x[0])
    out, path, before = [], [[head, 0, 0, 0, 0, 0, None]], []

    def close():
        node, depth = path.pop(), len(path)
        conv, convs, children, leaves, saved, chars, ends = node
        leaves, saved, up = leaves + (children == 0), saved + (convs - 1) * chars, path[-1]
        up[2], up[3], up[4] = up[2] + 1, up[3] + leaves, up[4] + saved
        out.append((conv, depth0 + depth, up, convs, children, leaves, saved, ends))

    for tids, lens, cls, w, ends in suffixes:
        same = 0
        while same < min(len(before), len(tids)) and before[same] == tids[same]:
            same += 1
        while len(path) - 1 > same:
            close()
        path += [[cls, 0, 0, 0, 0, n, None] for n in lens[same:]]
        for node in path[1:]:
            node[0], node[1] = min(node[0], cls), node[1] + w
        path[-1][6] = ends
        before = tids
    while len(path) > 1:
        close()
    rows = [(c, d, up[0], *rest) for c, d, up, *rest in out] + [(head, -1, None, 0, *path[0][2:5], None)]
    frame = pd.DataFrame(rows, columns=["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                        "saved_tokens", "ends"])
    return frame.astype({c: "Int64" for c in frame.columns[:-1]}).assign(depth0=depth0)


def prefix_trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256)``, one row per node; see the module."""
    rows, convs = rebuilt(turns(conversations, id_col, turn_col, role_col, text_col))
    done, levels = burst(rows, classes(rows, convs), limit)
    placed = done[0]
    for d in done[1:]:
        placed = placed.unionByName(d)
    steps = rows.select(F.col("conv").alias("cls"), "depth", "tid", F.col("chars").alias("c"), "before")
    steps = write_table(skew_join(steps, placed, "cls", spread=["depth"]).where("depth > depth0"), "trie-suffixes")

    # containers of one class are paths
    top, last = F.col("depth") == F.col("depth0") + 1, F.col("depth") == F.col("n")
    paths = steps.where("members = 1").select(
        F.col("cls").alias("conv_id"), "depth", F.when(top, F.col("head")).otherwise(F.col("cls")).alias("parent_conv_id"),
        F.col("w").alias("n_convs"), (~last).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("w") - 1) * (F.col("chars") - F.col("before"))).alias("saved_tokens"), F.when(last, F.col("ends")).alias("ends"),
        "depth0", "head")
    totals = ["n_children", "n_leaves", "saved_tokens"]
    tops = paths.where("depth = depth0 + 1").withColumn("n_children", F.lit(1).cast("long")).select("head", "depth0", *totals)

    # the others are sorted and swept
    turn = F.array_sort(F.collect_list(F.struct("depth", "tid", "c")))
    ready = steps.where("members > 1").groupBy("head", "depth0", "cls").agg(
        F.first("w").alias("w"), F.first("ends").alias("ends"), turn.alias("t")) \
        .select("head", "depth0", "cls", "w", "ends", F.col("t.tid").alias("tids"), F.col("t.c").alias("lens"))
    swept = write_table(ready.groupBy("head", "depth0").applyInPandas(sweep, _NODE + ", depth0 long"), "trie-swept")
    below = write_table(swept.where("depth = -1").select(F.col("conv_id").alias("head"), "depth0", *totals)
                        .unionByName(tops), "trie-below")

    # heads, from the deepest to the root
    out = paths.drop("depth0", "head").unionByName(swept.where("depth >= 0").drop("depth0"))
    for depth in range(len(levels) - 1, -1, -1):
        sums = below.where(F.col("depth0") == depth).drop("depth0")
        if depth < len(levels) - 1:
            sums = sums.unionByName(level.select(F.col("parent_conv_id").alias("head"), F.lit(1).cast("long").alias("n_children"),
                                                 "n_leaves", "saved_tokens"))
        sums = sums.groupBy(F.col("head").alias("node")).agg(*[F.sum(c).alias(c) for c in totals])
        zero = F.lit(0)
        level = write_table(levels[depth].join(sums, "node", "left").select(
            F.col("node").alias("conv_id"), F.lit(depth).cast("long").alias("depth"), F.col("parent").alias("parent_conv_id"),
            "n_convs", F.coalesce("n_children", zero).cast("long").alias("n_children"),
            F.greatest(F.coalesce("n_leaves", zero), F.lit(1)).cast("long").alias("n_leaves"),
            (F.coalesce("saved_tokens", zero) + (F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"), "ends"),
            "trie-level")
        out = out.unionByName(level)
    return out.withColumn("ends_sha256", F.coalesce("ends", F.lit(_EMPTY))).drop("ends")
