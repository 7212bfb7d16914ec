"""Record linkage: candidate groups from shared buckets, exact links inside groups,
connected components. Shared by the near-duplicate operators.

Nothing here is quadratic in a bucket and nothing is capped: buckets and groups
of any size are cut into blocks or linked as stars, which only widens groups.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_table
from .skew import skew_join


MISS = 1e-6            # links at the threshold that may share no band


def banding(threshold: float) -> tuple[int, int]:
    """``(bands, rows)`` that miss fewer than one in a million links at the threshold.

    A pair of similarity ``t`` shares no band with probability
    ``(1 - t**rows)**bands``: 4.7e-8 for 32 x 4 at 0.8, 4.3e-7 for 25 x 5 at 0.85.
    Lower thresholds take fewer rows, and as many bands as the bound needs; those
    below 0.06 would take more values than a signature has and are refused.
    """
    if threshold < 0.06:
        raise ValueError(f"a threshold of {threshold} is too low for banding")
    if threshold >= 0.8:
        return (25, 5) if threshold >= 0.85 else (32, 4)
    rows = 3 if threshold >= 0.7 else 2 if threshold >= 0.5 else 1
    return math.ceil(math.log(MISS) / math.log1p(-threshold ** rows)), rows


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, label)`` for every node with an edge; ``label`` is the
    smallest node of its connected component.

    Min-label propagation plus pointer jumping (the label of the label is
    in the same component and never larger), run until nothing changes;
    every round is a join/aggregate over edge endpoints only, with the
    labels written to the checkpoint folder. Nodes with many edges and labels
    of many nodes are dealt over tasks (:mod:`skew`).
    """
    both = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
    both = write_table(both.unionByName(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"))), "cc-edges")
    labels = write_table(both.select(F.col("src").alias("node")).distinct()
                         .withColumn("label", F.col("node")), "cc-labels")
    while True:
        prop = skew_join(both, labels.withColumnRenamed("node", "src"), "src", spread=["dst"]) \
            .groupBy(F.col("dst").alias("node")).agg(F.min("label").alias("nl"))
        new = labels.join(prop, "node", "left").select(
            "node", F.least("label", F.coalesce("nl", "label")).alias("label"))
        new = write_table(new, "cc-labels")
        jump = new.select(F.col("node").alias("label"), F.col("label").alias("ll"))
        new = skew_join(new, jump, "label", "left", spread=["node"]).select(
            "node", F.least("label", F.coalesce("ll", "label")).alias("label"))
        new = write_table(new, "cc-labels")
        changed = new.join(labels.withColumnRenamed("label", "old"), "node") \
            .where(F.col("label") != F.col("old")).limit(1).count()
        labels = new
        if changed == 0:
            return labels


def spanning_forest(n: int, linked) -> list[tuple[int, int]]:
    """Forest of the graph on ``0..n-1`` by breadth-first search.

    ``linked(i, rest)`` masks the members of ``rest`` (not found so far) that
    are linked with ``i``; only these comparisons are made.
    """
    rest, edges = np.arange(n), []
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            hit = linked(i, rest)
            found = rest[hit]
            edges += [(i, int(x)) for x in found]
            queue += found.tolist()
            rest = rest[~hit]
    return edges


def _edge_frame(pdf, ids, edges):
    return pdf.__class__({"src": [ids[a] for a, _ in edges], "dst": [ids[b] for _, b in edges]},
                         dtype="int64")


def bucket_forest(members: DataFrame, agree: int, width: int) -> DataFrame:
    """``(src, dst)`` for ``members(key, rep, sig)``: in every bucket ``key`` a
    spanning forest of the pairs whose signatures (``width`` 16-bit values)
    agree in at least ``agree`` places."""

    def run(pdf):
        sig = np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(-1, width)
        edges = spanning_forest(len(pdf), lambda i, rest: (sig[rest] == sig[i]).sum(axis=1) >= agree)
        return _edge_frame(pdf, pdf["rep"].to_numpy(), edges)

    return members.groupBy("key").applyInPandas(run, "src long, dst long")


def candidate_groups(cells: DataFrame, sig: DataFrame, agree: int, width: int,
                     bucket: int) -> DataFrame:
    """``(id, grp)`` of everything that shares a bucket with a likely partner.

    ``cells(rep, key)`` lists buckets, ``sig(rep, sig)`` signatures. Buckets with
    the same members count once; up to ``bucket`` members are compared by
    signature, larger buckets become a star around their smallest member.
    """
    buckets = cells.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("rep").alias("lead"),
        F.expr("bit_xor(xxhash64(rep))").alias("x")).where("n > 1")
    buckets = write_table(buckets.groupBy("n", "lead", "x").agg(F.min("key").alias("key")), "buckets")
    members = write_table(cells.join(buckets.select("key", "n", "lead"), "key"), "members")
    small = members.where(F.col("n") <= bucket).select("key", "rep")
    stars = members.where((F.col("n") > bucket) & (F.col("rep") != F.col("lead"))) \
        .select(F.col("lead").alias("src"), F.col("rep").alias("dst"))
    edges = bucket_forest(small.join(sig, "rep"), agree, width).unionByName(stars)
    return connected_components(write_table(edges.distinct(), "candidates")) \
        .select(F.col("node").alias("id"), F.col("label").alias("grp"))


def verified_edges(blocks: DataFrame, percent: int) -> DataFrame:
    """``(src, dst)`` for ``blocks(id, codes, grp, bi, bj)``: in every block pair a
    spanning forest of the pairs with ``100 * |A & B| >= percent * |A | B|``;
    ``codes`` holds a set's distinct 64-bit members."""

    def run(pdf):
        sets = [np.frombuffer(s, np.uint64) for s in pdf["codes"]]
        size = np.array([len(s) for s in sets])
        _, code = np.unique(np.concatenate(sets), return_inverse=True)
        shared = np.bincount(code)[code] > 1                      # others match nothing
        bounds = np.concatenate([[0], np.cumsum(size)])
        kept = np.concatenate([[0], np.cumsum(shared)])[bounds]
        code, own = code[shared], np.diff(kept)
        mark = np.zeros(code.max() + 1 if len(code) else 1, np.int64)
        state = {"left": None}

        def linked(i, rest):
            # the sets not yet found, laid end to end anew whenever they have halved
            if state["left"] is None or len(rest) * 2 <= len(state["left"][0]):
                state["left"] = (rest, np.concatenate(
                    [code[kept[r]:kept[r + 1]] for r in rest]), np.concatenate(
                    [[0], np.cumsum(own[rest])]))
            have, flat, at = state["left"]
            mark[code[kept[i]:kept[i + 1]]] = 1
            total = np.concatenate([[0], np.cumsum(mark[flat])])
            mark[code[kept[i]:kept[i + 1]]] = 0
            both = (total[at[1:]] - total[at[:-1]])[np.searchsorted(have, rest)]
            return 100 * both >= percent * (size[i] + size[rest] - both)

        return _edge_frame(pdf, pdf["id"].to_numpy(), spanning_forest(len(pdf), linked))

    return blocks.groupBy("grp", "bi", "bj").applyInPandas(run, "src long, dst long")


LEADS = 3              # rounds of comparing a large group with one of its sets


def lead_links(members: DataFrame, percent: int) -> DataFrame:
    """``(id, grp, linked)``: every set of ``members(id, grp, codes, rest)`` against its
    group's lead, the smallest id among those with ``rest``; the lead is linked with itself.

    Each set is read once; the lead's is copied to as many tasks as share the group.
    """
    lead = members.where("rest").groupBy("grp").agg(F.min("id").alias("lead"))
    lead = lead.join(members.select(F.col("id").alias("lead"), F.col("codes").alias("first")), "lead")
    both = skew_join(members.select("id", "grp", "codes"), lead, "grp", spread=["id"])

    def run(it):
        for rb in it:
            col = {n: rb.column(i) for i, n in enumerate(rb.schema.names)}
            hit = []
            for x, y in zip(col["codes"].to_pylist(), col["first"].to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                few, many = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(many, few), max(len(many) - 1, 0))
                same = int((many[at] == few).sum()) if len(many) else 0
                hit.append(100 * same >= percent * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([col["id"], col["grp"], col["lead"], pa.array(hit, pa.bool_())],
                                             names=["id", "grp", "lead", "linked"])

    return both.mapInArrow(run, "id long, grp long, lead long, linked boolean")


def verified_components(sets: DataFrame, percent: int, block_rows: int, block_items: int) -> DataFrame:
    """``(node, label)`` of the exact links inside the groups of ``sets(id, grp, codes)``;
    ``codes`` are ascending.

    A group of up to ``block_rows`` sets and ``block_items`` members is one task. A
    larger one is first compared with a few lead sets, one after the other. Sets linked
    with the first lead, or with a later one that itself meets them, are connected and
    need not be compared with each other; only the others go in blocks against all
    blocks of the group. Where nearly all sets are near copies of one text, a set is so
    copied a few times, however large the group.
    """
    need = sets.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("codes") / 8).alias("items"))
    need = need.select("grp", F.ceil(F.greatest(F.col("n") / block_rows, F.col("items") / block_items)).cast("long").alias("nb"))
    need = write_table(need.where("nb > 1"), "large-groups")
    zero = F.lit(0).cast("long")
    # large groups are few: each holds more than a block
    small = sets.join(F.broadcast(need.select("grp")), "grp", "left_anti") \
        .select("id", "codes", "grp", zero.alias("bi"), zero.alias("bj"))
    if need.limit(1).count() == 0:
        return connected_components(write_table(verified_edges(small, percent).distinct(), "links"))
    large = write_table(sets.join(F.broadcast(need), "grp").withColumn("rest", F.lit(True)), "large-sets")
    edges = []
    for i in range(LEADS):
        near = write_table(lead_links(large, percent).where("linked"), "lead-links")
        edges.append(near.where("id != lead").select(F.col("lead").alias("src"), F.col("id").alias("dst")))
        if i == 0:
            joined = near.select("id")
        else:                                            # a star that meets the connected ones
            met = near.join(large.where("not rest").select("id"), "id", "left_semi").select("grp").distinct()
            joined = near.join(met, "grp", "left_semi").select("id")
        flag = joined.distinct().withColumn("_in", F.lit(True))
        large = write_table(large.join(flag, "id", "left").withColumn("rest", F.col("rest") & F.col("_in").isNull())
                            .drop("_in"), "large-sets")
        if large.where("rest").limit(1).count() == 0:
            break
    left = large.where("rest").groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("long").alias("nr"))
    dealt = large.join(left, "grp").withColumn("h", F.xxhash64("id"))
    to = F.explode(F.sequence(zero, F.col("nr") - 1))
    as_member = dealt.select("id", "codes", "grp", to.alias("bi"), F.pmod("h", "nb").alias("bj"))
    as_rest = dealt.where("rest").select("id", "codes", "grp", F.pmod("h", "nr").alias("bi"),
                                         F.explode(F.sequence(zero, F.col("nb") - 1)).alias("bj"))
    pairs = as_member.unionByName(as_rest).dropDuplicates(["id", "grp", "bi", "bj"])
    links = verified_edges(small.unionByName(pairs), percent)
    for e in edges:
        links = links.unionByName(e)
    return connected_components(write_table(links.distinct(), "links"))
