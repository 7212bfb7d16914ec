"""Near duplicates, contamination, tool calls and the pipeline against brute force."""

import json
import random
import re
import unicodedata

import numpy as np
import pytest

from corpuslake.llm import decontaminate as D, near_dups as N, tool_calls as T
from corpuslake.llm import kernels as K

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(t, k):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute_classes(docs, k, percent):
    sets = {i: shingles(t, k) for i, t in docs if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def make_docs(seed=4):
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(3000)]
    docs, n = [(i, t) for i, t in enumerate([None, "", "  \n", "x", "X", "one two", "ONE two", "a b c", "É b c", "é b c"])], 10
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice([12, 60, 250]))]
        for _ in range(rng.choice([1, 2, 6, 30])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
                w[rng.randrange(len(w))] = rng.choice(words)
            docs.append((n, " ".join(w)))
            n += 1
    rng.shuffle(docs)
    return docs + [(None, docs[5][1]), (None, None)]


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, k, percent):
    docs = make_docs()
    d = spark.createDataFrame([(i, t, b"x", 1) for i, t in docs], "doc_id long, text string, sig binary, id long").repartition(4)
    rows = N.near_duplicates(d, k=k, percent=percent).collect()
    want = brute_classes(docs, k, percent)
    assert len(rows) == len(docs)
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_templates_do_not_hide_links(spark):
    """Pairs beside templates of smaller id, in shared buckets; a word put in front; one large family."""
    rng = random.Random(8)
    docs, n = [], 0
    for _ in range(30):
        base = [f"q{rng.randrange(10**6)}" for _ in range(120)]
        for _ in range(4):
            w = list(base)
            for i in rng.sample(range(120), 12):
                w[i] = f"t{rng.randrange(10**6)}"
            docs.append((n, " ".join(w)))
            n += 1
        docs.append((n, " ".join(base)))
        docs.append((n + 1, "front " + " ".join(base)))
        n += 2
    family = [f"f{i}" for i in range(200)]
    for _ in range(100):
        w = list(family)
        for i in rng.sample(range(200), rng.choice([0, 1, 3, 8])):
            w[i] = f"z{rng.randrange(10**6)}"
        docs.append((n, " ".join(w)))
        n += 1
    d = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute_classes(docs, 3, 85)
    got = {r.doc_id: r.component_id for r in N.near_duplicates(d, k=3, percent=85).collect()}
    assert got == {i: c for i, (_, c) in want.items()}


def test_blocks_and_stars(spark, monkeypatch):
    """Tiny limits: stars for large buckets and several blocks in a group change nothing."""
    monkeypatch.setattr(N, "BUCKET", 4)
    monkeypatch.setattr(N, "BLOCK_DOCS", 7)
    docs = make_docs(11)
    want = brute_classes(docs, 3, 85)
    rows = N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=3, percent=85).collect()
    assert {r.doc_id: r.component_id for r in rows if r.doc_id is not None} == {i: c for i, (_, c) in want.items()}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert N.near_duplicates(empty).count() == 0


def test_signature_is_superminhash():
    """Against the definition: every element's own permutation and noise, minimum per slot."""
    m = 16
    code = K.stream(40, 3)
    bounds = np.array([0, 1, 4, 40, 40])
    got = N.super_minhash(code, bounds, m)
    for d in range(4):
        want = [2**64 - 1] * m
        for c in code[bounds[d]:bounds[d + 1]].tolist():
            p = list(range(m))
            for j in range(m):
                x = int(K.mix(np.array([(c + (j + 1) * 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0])
                k = j + ((x & 0xFFFFFFFF) * (m - j) >> 32)
                p[j], p[k] = p[k], p[j]
                want[p[j]] = min(want[p[j]], (j << 56) | (x >> 8))
        assert got[d].tolist() == want
    assert len(set(got[2].tolist())) == m


# ---------------------------------------------------------------- contamination

def fold(t):
    return re.sub(r"[\x20\x09-\x0D]", " ", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")).encode()


def brute_edits(p, t):
    row = np.zeros(len(t) + 1, int)
    tb = np.frombuffer(t, np.uint8)
    for i, c in enumerate(p):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (tb != c), row[1:] + 1)
        row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return int(row.min())


def test_find_passages(spark):
    rng = random.Random(6)
    syl = ["an", "the", "or", "ing", "ed", "on", "é", "st", " ", " "]
    text = lambda n: "".join(rng.choice(syl) for _ in range(n))
    items = [(i, text(rng.choice([30, 60, 110]))) for i in range(12)] + [(12, "tiny"), (13, ""), (14, None), (15, "dup item text here"),
                                                                        (15, "dup item text here")]
    docs = [(0, None), (1, ""), (2, "tiny"), (3, "a TINY one"), (None, "x " + items[3][1])]
    for n in range(10, 90):
        t = text(rng.choice([5, 100, 400]))
        for _ in range(rng.choice([0, 1, 2])):
            p = list(rng.choice(items[:12])[1])
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5, 9])):
                i = rng.randrange(len(p))
                p[i:i + 1] = rng.choice([[], ["Q"], [p[i], "z"]])
            at = rng.randrange(len(t) + 1)
            t = t[:at] + "".join(p).upper() + t[at:]
        docs.append((n, t))
    d = spark.createDataFrame([(i, t, 7, 8) for i, t in docs], "doc_id long, text string, row long, item_id long").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {}
    for r in D.find_passages(d, b).collect():
        assert (r.doc_id, r.item_id) not in got
        got[(r.doc_id, r.item_id)] = r
    want = {}
    for i, t in docs:
        for j, p in items:
            f = fold(p)
            if f:
                e = brute_edits(f, fold(t))
                if e <= D.budget(len(f), min(len(f), D.Q)):
                    want[(i, j)] = e
    assert {k: r.edits for k, r in got.items()} == want
    assert any(e for e in want.values())
    texts = dict(docs)
    for (i, j), r in got.items():
        if r.edits == 0 and i is not None:
            assert fold(texts[i][r.start:r.end]) == fold(dict(items)[j])
    clean = D.contaminated_rows(d, b)
    assert clean.columns == d.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, _ in docs if not any(k[0] == i for k in want))
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_passages(d, none).count() == 0 and D.contaminated_rows(d, none).count() == len(docs)
    assert D.find_passages(d.where("false"), b).count() == 0


def test_passages_without_words_and_short_ones(spark):
    """Blank passages match nothing, short ones only whole words; against a search character by character."""
    letter = lambda c: unicodedata.category(c)[0] in "LMN" and not "\u3040" <= c <= "\u9fff"
    rng = random.Random(8)
    blank = [" ", "\n", " \t\r\n ", " " * 40, "\u3000", "\u00a0 \u2003" * 9, ".", "...", "- -", "🙂", "\ufeff"]
    short = ["a", "42", "é", "C++", "(x", "a b", " a", "北京", "e\u0301t", "Straße", "a."]
    items = list(enumerate(blank + short))
    bits = ["a", "A", "42", "é", "C++", "(x", "b", " ", "  ", "北", "京", "e\u0301t", "Straße", ".", "🙂", "—", "0", "\n", "\u3000", "ß"]
    made = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 14))) for _ in range(300)]
    texts = made + ["clean words, nothing else 142 421 bad", " " * 60, "the answer is 42.", "A", "xa a", "我在北京市"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for n, t in enumerate(texts):
        f = fold(t).decode()
        for j, p in items[len(blank):]:
            p = fold(p).decode()
            for i in range(len(f) - len(p) + 1):
                j_before = i and letter(f[i - 1]) and letter(p[0])
                j_after = i + len(p) < len(f) and letter(f[i + len(p)]) and letter(p[-1])
                if f.startswith(p, i) and not j_before and not j_after:
                    want[(n, j)] = (i, i + len(p), 0)
                    break
    got = {(r.doc_id, r.item_id): (r.start, r.end, r.edits) for r in D.find_passages(d, b).collect()}
    assert got == want and {j for _, j in want} == {j for j, _ in items[len(blank):]}
    assert {r.doc_id for r in D.contaminated_rows(d, b).collect()} == set(range(len(texts))) - {n for n, _ in want}
    none = b.where(f"item_id < {len(blank)}")
    assert D.find_passages(d, none).count() == 0 and D.contaminated_rows(d, none).count() == len(texts)


def test_passages_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_BYTES", 100)
    items = [(i, f"passage number {i} " * 4) for i in range(8)]
    docs = [(i, f"before {'passage number %d ' % i * 4} after") for i in range(8)]
    rows = D.find_passages(spark.createDataFrame(docs, "doc_id long, text string"),
                           spark.createDataFrame(items, "item_id long, text string")).collect()
    exact = {(r.doc_id, r.item_id) for r in rows if r.edits == 0}
    assert exact == {(i, i) for i in range(8)}


# ---------------------------------------------------------------- tool calls

def test_tool_calls(spark):
    calls = [("a", 0, "c1", "search", '{"limit": 5, "query": "x"}', None),
             ("a", 2, "c2", "search", '{"query": "", "limit": 5.5, "z": 1}', "c1"),
             ("a", 4, "c3", "count", '{"words": true}', "c2"), ("a", 6, "c4", "nope", "{}", "gone"),
             ("a", 8, "c5", "count", "not json", "c6"), ("a", 9, "c6", "count", None, "c5"),
             ("b", 1, "d1", "translate", '{"to":"xx","text":"é \\u00e9"}', None),
             ("b", 1, "d1", "translate", '{"to":"de","text":"dup"}', None),
             (None, None, "e1", "count", '{"words": 3}', "c4"), ("b", 2, None, "count", "{}", None)]
    num = {"a": 1, "b": 2, None: None}
    c = spark.createDataFrame([(num[x[0]],) + x[1:] for x in calls],
                              "conv_id long, turn long, call_id string, name string, arguments string, depends_on string")
    res = spark.createDataFrame([("c1", "r1"), ("c1", "r0"), ("c2", None), ("zz", "lost"), (None, "n"), ("d1", "ok")],
                                "call_id string, content string")
    every = T.link_tool_calls(c, res, T.SCHEMAS).collect()
    rows = {r.call_id: r for r in every if r.call_id}
    assert set(rows) == {"c1", "c2", "c3", "c4", "c5", "c6", "d1", "e1", "zz"}
    lost = rows.pop("zz")
    assert (lost.n_calls, lost.n_results, lost.conv_id, lost.valid, lost.errors) == (0, 1, None, False, "call: missing")
    assert json.loads(lost.json)["result"] == "lost"
    loose = sorted((r.n_calls, r.conv_id, r.errors) for r in every if r.call_id is None)
    assert loose == [(0, None, "call: missing; call_id: missing"),
                     (1, 2, ".words: missing; call_id: missing; result: missing")]
    assert rows["c1"].valid and rows["c1"].n_results == 2 and "repeated" in rows["c1"].errors
    assert json.loads(rows["c1"].json) == {"arguments": {"limit": 5, "query": "x"}, "depends_on": None, "id": "c1",
                                           "name": "search", "position": 0, "result": "r0"}
    assert rows["c1"].json == json.dumps(json.loads(rows["c1"].json), sort_keys=True, separators=(",", ":"))
    assert not rows["c2"].valid and all(x in rows["c2"].errors for x in (".z: unknown", "wrong length", "not integer"))
    assert "not integer" in rows["c3"].errors and rows["c3"].depth == 2
    assert "unknown tool" in rows["c4"].errors and "missing" in rows["c4"].errors
    assert "cycle" in rows["c5"].errors and "cycle" in rows["c6"].errors and "not JSON" in rows["c5"].errors
    assert rows["d1"].n_calls == 2 and rows["e1"].conv_id is None
    order = sorted((r for r in rows.values() if r.conv_id == 1), key=lambda r: r.position)
    assert [r.position for r in order] == list(range(6)) and [r.call_id for r in order][-2:] == ["c5", "c6"]
    at = {r.call_id: r.position for r in order}
    assert at["c1"] < at["c2"] < at["c3"]


def test_tool_call_chain(spark):
    """A chain of 200 calls, listed backwards by turn."""
    rows = [(1, 1000 - i, f"k{i:03d}", "count", '{"words":1}', f"k{i - 1:03d}" if i else None) for i in range(200)]
    c = spark.createDataFrame(rows, "conv_id long, turn long, call_id string, name string, arguments string, depends_on string")
    r = spark.createDataFrame([], "call_id string, content string")
    got = {x.call_id: x for x in T.link_tool_calls(c, r, T.SCHEMAS).collect()}
    assert all(got[f"k{i:03d}"].depth == i == got[f"k{i:03d}"].position for i in range(200))
    assert T.link_tool_calls(c.where("false"), r, T.SCHEMAS).count() == 0


def test_odd_json_is_an_error_and_no_crash(spark):
    args = [r'{"query": "\ud800", "limit": 1}', "[" * 100_000, '{"limit": NaN, "query": "x"}', '{"limit": 1e999, "query": "x"}',
            '{"query": "ok", "limit": 1}', "7", "", None]
    c = spark.createDataFrame([(1, i, f"k{i}", "search", a, None) for i, a in enumerate(args)],
                              "conv_id long, turn long, call_id string, name string, arguments string, depends_on string")
    r = spark.createDataFrame([], "call_id string, content string")
    got = [x for x in T.link_tool_calls(c, r, T.SCHEMAS).orderBy("turn").collect()]
    assert [x.valid for x in got] == [True, False, False, False, True, False, False, False]
    assert r'"query":"\ud800"' in got[0].json and json.loads(got[0].json)["arguments"]["query"] == "\ud800"
    assert all("not JSON" in got[i].errors for i in (1, 2, 3, 6, 7)) and all("NaN" not in x.json for x in got)
    assert T.check(None, {"type": ["string", "null"]}) == [] and T.check(3, {"type": ["string", "null"]}) == [".: not string or null"]
    with pytest.raises(ValueError, match="unknown schema types"):
        T.link_tool_calls(c, r, {"search": {"type": "object", "properties": {"query": {"type": "text"}}}})


# ---------------------------------------------------------------- rows that share an id, repetitive texts

def test_rows_that_share_an_id_keep_their_links(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "xy")
    docs = [(1, a), (1, b), (2, a + " word"), (3, b + " word"), (4, "none like this one at all"), (1, a)]
    got = sorted((r.doc_id, r.component_id) for r in N.near_duplicates(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3), k=3, percent=85).collect())
    assert got == [(1, 1), (1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]
    import corpus_pipeline as P
    schema = "doc_id long, text string, _row int, row int, __row int"
    for parts in (1, 4):
        left = P.near_dedup(spark, spark.createDataFrame([d + (0, 1, None) for d in docs], schema).repartition(parts), "")
        assert left.columns == ["doc_id", "text", "_row", "row", "__row"]
        assert sorted((r.doc_id, r.text[0]) for r in left.collect()) == [(1, "x"), (1, "y"), (4, "n")]


def test_runs_in_passage_and_document_stay_small():
    """A run of one character in both: 60 million equal q-grams, found in bounded memory."""
    import tracemalloc
    passage = b"a question about tables " + b"-" * 1000 + b" and its answer"
    text = np.frombuffer(b"start " + b"-" * 64_000 + b" end " + passage + b" tail", np.uint8)
    index = D.PassageIndex([(7, np.frombuffer(passage, np.uint8))], D.Q)
    tracemalloc.start()
    regions = index.regions(text, np.array([0, len(text)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400_000_000
    at = text.tobytes().find(passage)
    step = int(index.k[0]) + 1
    assert any(d <= at < d + 2 * step for _, _, d in regions)


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as P
    from conftest import SF001
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality_rules", "near_dedup", "decontamination", "pii", "packing"]
    rows = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns
        after = {r.doc_id: r.text for r in out.collect()}
        if name == "near_dedup":
            want = brute_classes(sorted(rows.items()), 5, 80)
            assert set(after) == {i for i, (_, c) in want.items() if i == c}
        if name == "decontamination":
            bench = [fold(r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
            for i, t in rows.items():
                assert (i in after) or min(brute_edits(b, fold(t)) - D.budget(len(b), D.Q) for b in bench) <= 0
                assert i not in after or not any(b in fold(t) for b in bench)
        docs = spark.createDataFrame(out.collect(), docs.schema)
        rows = after
    packed = P.packing(spark, docs, SF001)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(rows)


def test_pipeline_odd_rows(spark):
    import corpus_pipeline as P
    from conftest import SF001
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    good = " ".join(f"word{i} other{i}" for i in range(40))
    rows = [(1, good, "en", "s", 1), (1, good, "en", "s", 1), (2, None, None, None, None), (None, good + " x", None, None, None),
            (3, "", "", "", 0), (4, good + " tail@mail.example.com", "en", "s", None), (5, "very " + good * 500, "en", "s", 5)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in P.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, SF001).collect(), schema)
        ids = [r.doc_id for r in docs.collect()]
        assert ids.count(1) == (1 if data else 0) and None not in ids     # the null id's text is a near copy
        assert P.packing(spark, docs, SF001).count() >= len(ids)
