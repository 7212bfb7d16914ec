"""Prefix tries, collocations and SimHash classes against brute force, on odd tables too."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpuslake.llm import collocations as C, prefix_trie as P, simhash as S

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASH = ["conv", "pos", "tid", "chars", "before", "depth", "n", "w", "cls", "head", "key", "fp", "node", "parent", "members",
         "id", "part", "shard", "kind", "k", "slice", "data", "f", "a", "l", "r", "score", "cut", "rank", "phrase", "least", "_n"]


def clashing(df, own):
    for i, c in enumerate(CLASH):
        if c not in own:
            df = df.withColumn(c, F.lit(None).cast("string") if i % 2 else F.lit(-3))
    return df


# prefix trie

def brute_trie(rows):
    conv = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tid = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            conv[c].append(((turn is not None, turn or 0), tid, len(text)))
    own = {c: [(tid, n) for _, tid, n in sorted(t)] for c, t in conv.items()}
    paths = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(np.fmod(c, 100))
        paths[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, t in paths.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    out = []
    for node, m in members.items():
        below = [x for x in members if x[:len(node)] == node]
        kids = [x for x in below if len(x) == len(node) + 1]
        leaves = sum(not any(y[:-1] == x for y in members if len(y) == len(x) + 1) for x in below)
        ends = ",".join(str(c) for c in sorted(c for c in m if len(paths[c]) == len(node)))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids), leaves,
                    sum((len(members[x]) - 1) * (x[-1][1] if x else 0) for x in below), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(df, **kw):
    return sorted((tuple(r[c] for c in COLS) for r in P.prefix_trie(df, **kw).collect()), key=repr)


def conversations():
    rng, rows = random.Random(5), []
    for c in list(range(95, 130)) + [205, 206, 301, -5, -100, -101, -160]:
        for t in range(rng.choice([1, 1, 2, 3, 9])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["hi", "é🙂", "go on", "", None])))
    rows += [(130 + i, t, "user", "same" * t) for i in range(30) for t in range(8)]       # copies
    rows += [(170, t, "user", f"long {t}") for t in range(300)]                            # one very long
    rows += [(None, 0, "user", "lost"), (None, None, None, None), (100, None, None, None), (100, 0, "user", "tie"),
             (100, 0, "user", "a tie"), (100, 0, "user", "tie"), (301, None, "x", "y" * 200_000), (400, None, None, None), (706, 1, "user", "dropped")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [4, 100_000])
def test_trie_equals_brute_force(spark, limit):
    rows = conversations()
    df = clashing(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3), ())
    want = brute_trie(rows)
    assert zlib.crc32(b"706") % 6 == 5          # a conversation without turns
    assert trie(df, limit=limit) == want


def test_trie_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert trie(df) == []
    one = spark.createDataFrame([("7", None, None, None)], df.schema)
    assert trie(one) == brute_trie([(7, None, None, None)])
    assert trie(spark.createDataFrame([(None, 1, "user", "x")], df.schema)) == []


# collocations

def brute_phrases(docs, max_len=3, threshold=10, cover=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\v\f\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, max_len + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= threshold}
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= cover * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in cand.items()):
                continue
            score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def phrase_rows(df, **kw):
    return sorted(tuple(r) for r in C.collocations(df, bits=(16, 17, 17, 16), **kw)
                  .select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def phrase_docs():
    rng, docs = random.Random(8), []
    words = ["the", "The", "of", "é", "naïve", "|", "x" * 50, "a", "b"] + [f"w{i}" for i in range(40)]
    for i in range(150):
        t = [rng.choice(words[:rng.choice([6, 49])]) for _ in range(rng.choice([0, 1, 2, 30, 200]))]
        seps = rng.choices([" ", "  ", "\t", ". ", "\n", ","], [20, 2, 1, 2, 1, 1], k=len(t))
        docs.append((rng.choice(["en", "en", "de", None, ""]), "".join(a + b for a, b in zip(t, seps))))
    docs += [("en", "hot phrase here " * 4000), ("xx", "only three words"), (None, None), ("de", ""), ("de", " \t\n.")]
    docs += [("fr", "copy of a line")] * 12
    return docs


@pytest.mark.parametrize("shards,max_len", [(4, 3), (2, 4)])
def test_phrases_equal_brute_force(spark, shards, max_len):
    docs = phrase_docs()
    df = clashing(spark.createDataFrame(docs, "lang string, text string").repartition(3), ())
    assert phrase_rows(df, shards=shards, max_len=max_len) == brute_phrases(docs, max_len)


def test_phrases_of_colliding_counters(spark):
    """Counters shared by many phrases only count more of them exactly."""
    docs = [("en", " ".join(f"q{i % 7000} q{i * 31 % 7000}" for i in range(30_000)))] + phrase_docs()
    df = spark.createDataFrame(docs, "lang string, text string")
    assert phrase_rows(df, top=50) == brute_phrases(docs, top=50)


def test_phrases_of_nothing(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert phrase_rows(df) == []
    assert phrase_rows(spark.createDataFrame([(None, None), ("en", "")], df.schema)) == []
    with pytest.raises(ValueError):
        C.collocations(df, threshold=300)


# SimHash

def fingerprint(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(max(len(w) - k + 1, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(docs, k, radius):
    fps = [fingerprint(t, k) for _, t in docs]
    v, root = np.array(fps, np.uint64), np.arange(len(fps))
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= radius):
            root[root == root[j]] = root[i]
    least = {}
    for (i, _), r in zip(docs, root):
        least[r] = min([x for x in (least.get(r), i) if x is not None], default=None)
    return sorted(((i, f"{f:016x}", least[r]) for (i, _), f, r in zip(docs, fps, root)), key=repr)


def simhash_docs():
    rng, docs = random.Random(3), []
    texts = [None, "", " \n", "one", "ONE", "a  b\tc", "A b c", "x" * 300_000, "many words " * 50_000]
    for _ in range(12):
        base = [f"v{rng.randrange(2000)}" for _ in range(rng.choice([3, 40, 400]))]
        for _ in range(rng.choice([1, 5, 25])):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 5])):
                w[rng.randrange(len(w))] = "É"
            texts.append(rng.choice([" ", "  ", "\t"]).join(w))
    docs = list(enumerate(texts)) + [(4, "a b c"), (3, "one"), (None, "one"), (None, "alone here"), (None, None)]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("k,radius,tile", [(3, 3, 1 << 16), (5, 6, 8)])
def test_simhash_equals_brute_force(spark, k, radius, tile):
    docs = simhash_docs()
    df = clashing(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), ("fingerprint",))
    got = S.near_duplicates(df, k=k, radius=radius, tile=tile).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_classes(docs, k, radius)
    assert S.near_duplicates(df.where("false"), k=k, radius=radius).collect() == []


def test_tiles_lose_no_link(spark):
    """Dense clusters of fingerprints at all distances, over many tiles and blocks."""
    rng = np.random.default_rng(2)
    seeds = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    v = [s for s in seeds]
    for s in seeds:
        for _ in range(40):
            v.append(s := s ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, rng.integers(1, 6)).astype(np.uint64)))
    v = np.unique(np.array(v, np.uint64))
    root = np.arange(len(v))
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= 3):
            root[root == root[j]] = root[i]
    fps = spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp long")
    edges = [(r.src, r.dst) for r in S.links(fps, 3, tile=16).collect()]
    at = {int(x): i for i, x in enumerate(v.view(np.int64))}
    got = np.arange(len(v))
    for a, b in edges:
        assert bin((a ^ b) & (2 ** 64 - 1)) and root[at[a]] == root[at[b]]
        got[got == got[at[a]]] = got[at[b]]
    assert len(np.unique(got)) == len(np.unique(root)) < len(v)
