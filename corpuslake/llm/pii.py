"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Wide patterns propose candidate spans. Five labelers (strict pattern, shape or
checksum, gazetteer, context words before, neighbouring characters) vote yes, no
or nothing on each. Votes and coarse features of all candidates of all documents
are counted by pattern, a table bounded by the number of patterns, from which

* expectation-maximisation estimates, for every kind, the share of true spans
  and how each labeler votes on true and on false ones, without any labels;
* a logistic regression on kind, votes and features is trained on the posteriors
  and decides about every candidate.

The contract's base patterns are always spans; accepted candidates that overlap
no span are added. Offsets are code points, ends exclusive.

Defined results: null and empty texts have no spans; every row is judged by its
own text, so repeated rows and null ids are rows like any other.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_table
from . import kernels as K

BASE = ["email", "ip", "card", "phone"]
KINDS = BASE + ["secret", "person"]

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# for searching, in parts that read a run of their characters once, however long
_LOCAL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# wide proposals
_WIDE_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]+"
                         r"(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]+)+")
_WIDE_NUMBER = re.compile(r"[+(]?[0-9][0-9 ().-]{6,24}[0-9]")
_SECRET = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{12,}+|(?:gh[pousr]_|sk-|xox[abp]-)[A-Za-z0-9-]{12,}+"
                     r"|(?<![0-9A-Za-z])(?=[0-9]*+[a-f])[0-9a-f]{16,}+(?![0-9A-Za-z])"
                     r"|(?<![0-9A-Za-z+/])(?=[A-Za-z+/]*+[0-9])(?=[0-9+/]*+[A-Za-z])[A-Za-z0-9+/]{20,}+={0,2}"
                     r"(?![0-9A-Za-z])")
_KEYED = re.compile(rb"(?:gh[pousr]_|sk-|xox[abp]-)(?=[A-Za-z0-9-]{12})")
_HEX = K.byte_class(b"0123456789abcdef")
_PERSON = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Mme|Herr|Frau)\.? ([A-Z][\w'-]+(?: [A-Z][\w'-]+)?)")
_TITLE = re.compile(rb"(?:Mr|Mrs|Ms|Dr|Prof|Mme|Herr|Frau)\.? [A-Z]")

# gazetteers: endings of hosts, prefixes of keys, given names
_ENDINGS = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "it", "eu", "us",
            "ch", "at", "nl", "be"}
_KEY_STARTS = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "xoxa-", "xoxb-", "xoxp-")
_NAMES = {"james", "john", "robert", "michael", "david", "mary", "patricia", "linda", "maria", "anna",
          "peter", "paul", "thomas", "hans", "julia", "laura", "jean", "pierre", "marie", "carlos",
          "jose", "ana", "luis", "sofia"}
_CUES = {
    "email": r"mail|contact|write to|reach",
    "phone": r"phone|tel|call|fax|mobile|cell|contact",
    "card": r"card|visa|mastercard|amex|credit",
    "ip": r"\bip\b|host|server|address|client",
    "secret": r"passw|pwd|token|secret|key|auth|bearer|credential",
    "person": r"name|by|from|signed|dear|regards",
}
_CUES = {k: re.compile(v, re.I) for k, v in _CUES.items()}
_AGAINST = re.compile(r"version|isbn|page|order no|total|commit|sha|md5|checksum|\bv$|section|figure", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str):
    """Leftmost, non-overlapping matches of ``_EMAIL``."""
    free = 0
    for m in _LOCAL.finditer(text):
        start = max(m.start(), free)
        host = _HOST.match(text, m.end()) if start < m.end() - 1 else None
        if host:
            free = host.end()
            yield "email", start, free


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The contract's spans, kind after kind, each in order of place."""
    out = []
    if "@" in text:
        out += _emails(text)
    for m in _IP.finditer(text) if "." in text else ():
        if all(map(_octet, m[0].split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        d = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_DIGIT.findall(m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def _vote(kind: str, s: str, before: str, prev: str, after: str) -> tuple[int, ...]:
    digits = "".join(_DIGIT.findall(s))
    if kind == "email":
        strict = 1 if _EMAIL.fullmatch(s) else -1
        end = re.split(r"[.)\] ]", s)[-1].lower()
        shape = 1 if end.isalpha() and 2 <= len(end) <= 10 else -1
        gaz = 1 if end in _ENDINGS else 0
    elif kind == "ip":
        strict = 1 if _IP.fullmatch(s) and all(len(p) < 4 and int(p) < 256 for p in s.split(".")) else -1
        shape = 1 if not s.startswith("0") else -1
        gaz = 1 if s.startswith(("10.", "192.168.", "172.16.")) else 0
    elif kind == "card":
        strict = 1 if 13 <= len(digits) <= 19 and luhn(digits) else -1
        shape = 1 if 13 <= len(digits) <= 19 and re.fullmatch(r"[0-9]+|[0-9]{4}([ -][0-9]{4}){3}", s) else -1
        gaz = 1 if digits[:1] in "3456" else -1
    elif kind == "phone":
        plain = re.fullmatch(r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", s)
        strict = 1 if plain or s.startswith("+") and 9 <= len(digits) <= 15 else -1
        shape = 1 if 9 <= len(digits) <= 15 and s.count("(") == s.count(")") else -1
        gaz = 1 if re.match(r"\+(1|33|34|39|44|49)\b", s) else 0
    elif kind == "secret":
        strict = 1 if re.fullmatch(r"(AKIA|ASIA)[A-Z0-9]{16}|[0-9a-f]{16,128}|(gh[pousr]_|sk-|xox[abp]-).+", s) else -1
        p = np.unique(np.frombuffer(s.encode(), np.uint8), return_counts=True)[1] / len(s.encode())
        shape = 1 if -(p * np.log2(p)).sum() >= 2.8 and digits else -1
        gaz = 1 if s.startswith(_KEY_STARTS) else 0
    else:
        strict = 1 if " " in s else 0
        shape = 1 if s[1:2].islower() else -1
        gaz = 1 if s.split()[0].lower() in _NAMES else 0
    cue = 1 if _CUES[kind].search(before) else -1 if _AGAINST.search(before) else 0
    loose = not (prev.isalnum() or after.isalnum() or prev and prev in "._@/" and kind != "secret")
    return strict, shape, gaz, cue, 1 if loose else -1


def candidates(text: str) -> list[tuple[int, int, int, int]]:
    """``(kind, start, end, pattern)`` of every proposed span.

    ``pattern`` packs the kind, the votes and the features: length and share of
    digits in a few steps, and whether there is a separator.
    """
    found = []
    if "@" in text or "(at)" in text or "[at]" in text:
        found += [("email", m.start(), m.end()) for m in _WIDE_EMAIL.finditer(text)]
    for m in _WIDE_NUMBER.finditer(text):
        n = len(_DIGIT.findall(m[0]))
        kind = "ip" if _IP.fullmatch(m[0]) else "card" if n >= 13 else "phone"
        if kind != "card" or n <= 19 and luhn("".join(_DIGIT.findall(m[0]))):   # else no card at all
            found.append((kind, m.start(), m.end()))
    found += [("secret", m.start(), m.end()) for m in _SECRET.finditer(text)]
    found += [("person", m.start(1), m.end(1)) for m in _PERSON.finditer(text)]
    out = []
    for kind, a, b in found:
        s = text[a:b]
        votes = _vote(kind, s, text[max(0, a - 32):a], text[a - 1:a], text[b:b + 1])
        p = KINDS.index(kind)
        for v in votes:
            p = 3 * p + v + 1
        size = min(len(s) // 6, 7)
        share = int(4 * len(_DIGIT.findall(s)) / len(s))
        p = ((p * 8 + size) * 5 + share) * 2 + bool(re.search(r"[ ().:-]", s))
        out.append((KINDS.index(kind), a, b, p))
    return out


LABELERS = 5


def unpack(p: np.ndarray):
    """Kinds, votes (0 no, 1 nothing, 2 yes) and features of packed patterns."""
    p, sep = p // 2, p % 2
    p, share = p // 5, p % 5
    p, size = p // 8, p % 8
    votes = np.zeros((len(p), LABELERS), np.int64)
    for i in range(LABELERS - 1, -1, -1):
        p, votes[:, i] = p // 3, p % 3
    return p, votes, np.stack([size, share, sep], axis=1)


def design(p: np.ndarray) -> np.ndarray:
    kind, votes, feats = unpack(p)
    cols = [np.ones(len(p))] + [kind == k for k in range(len(KINDS))]
    cols += [votes[:, i] == v for i in range(LABELERS) for v in (0, 2)]
    cols += [feats[:, 0] == s for s in range(8)] + [feats[:, 1] == s for s in range(5)] + [feats[:, 2]]
    return np.stack([c.astype(float) for c in cols], axis=1)


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior that a candidate of each pattern is personal data.

    For each kind a prior and, for each labeler, the distribution of its votes on
    true and on false candidates. It starts from the balance of votes; pseudo-counts
    keep a labeler that always votes alike from deciding alone.
    """
    kind, votes, _ = unpack(patterns)
    post = 1 / (1 + np.exp(-(votes - 1).sum(axis=1).astype(float)))
    agree = np.array([[3.0, 2.0, 1.0], [1.0, 2.0, 3.0]])     # pseudo-votes on false and true ones
    for k in range(len(KINDS)):
        at = np.flatnonzero(kind == k)
        if not len(at):
            continue
        n, v, q = counts[at].astype(float), votes[at], post[at]
        for _ in range(rounds):
            prior = ((n * q).sum() + 1) / (n.sum() + 2)
            ll = np.tile(np.log([1 - prior, prior]), (len(at), 1))
            for i in range(LABELERS):
                for y, w in ((0, n * (1 - q)), (1, n * q)):
                    c = np.bincount(v[:, i], weights=w, minlength=3) + agree[y]
                    ll[:, y] += np.log(c / c.sum())[v[:, i]]
            new = 1 / (1 + np.exp(np.clip(ll[:, 0] - ll[:, 1], -50, 50)))
            done = np.abs(new - q).max() < 1e-6
            q = new
            if done:
                break
        post[at] = q
    return post


def train(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights of the logistic span classifier, by Newton steps on the posteriors."""
    if not len(patterns):
        return np.zeros(design(np.zeros(0, np.int64)).shape[1])
    y, x = expectation_maximisation(patterns, counts), design(patterns)
    # a pattern's weight grows slowly with its count, or the commonest would drown the rest
    n = np.log1p(counts.astype(float))
    w, ridge = np.zeros(x.shape[1]), 0.1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (p - y)) + ridge * w
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def final_spans(base, cands, weights: np.ndarray) -> list[tuple[str, int, int]]:
    """Base spans and the accepted candidates that overlap no span, likelier ones first."""
    spans = [(KINDS.index(k), a, b) for k, a, b in base]
    if cands:
        z = design(np.array([c[3] for c in cands])) @ weights
        for i in np.argsort(-z, kind="stable"):
            k, a, b, _ = cands[i]
            if z[i] > 0 and all(b <= s or e <= a for _, s, e in spans):
                spans.append((k, a, b))
    return [(KINDS[k], a, b) for k, a, b in sorted(spans)]


def join_spans(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _suspects(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Documents that could hold any base or candidate span."""
    long_token = np.zeros(len(off) - 1, bool)
    digits = K.segment_sums((data >= 48) & (data <= 57), off)
    at_sign = K.segment_sums((data == 64) | (data == 91) | (data == 40), off)
    start, end, doc = K.words(data, off)
    marks = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57) | (data >= 65) & (data <= 90))])
    long_token[doc[(end - start >= 14) & (marks[end] - marks[start] >= 1)
                   & ((marks[end] - marks[start] >= 8) | (end - start >= 16))]] = True
    whole = data.tobytes()
    for pattern in (_TITLE, _KEYED):
        for m in pattern.finditer(whole):
            long_token[np.searchsorted(off, m.start(), side="right") - 1] = True
    first, last = K.runs(_HEX[data], off)
    long_token[np.searchsorted(off, first[last - first >= 16], side="right") - 1] = True
    return np.flatnonzero((digits >= 4) | (at_sign > 0) | long_token)


def extract(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id, base, cands)``: the base spans joined, and packed candidates, of every row."""

    def run(batches):
        for b in batches:
            for lo, data, off in K.text_chunks(b.column(1), K.SMALL_CHUNK):
                n = len(off) - 1
                base, cands = [""] * n, [[]] * n
                for d in _suspects(data, off).tolist():
                    text = data[off[d]:off[d + 1]].tobytes().decode()
                    base[d] = join_spans(base_spans(text))
                    cands[d] = [x for c in candidates(text) for x in c]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, n), pa.array(base), pa.array(cands, pa.list_(pa.int64()))],
                    names=["id", "base", "cands"])

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return d.mapInArrow(K.tidy(run), "id long, base string, cands array<long>")


def fit(extracted: DataFrame) -> np.ndarray:
    """Classifier weights from the counts of all candidates' patterns."""
    p = extracted.where(F.size("cands") > 0).select(F.explode(F.expr(
        "transform(sequence(4, size(cands), 4), i -> element_at(cands, i))")).alias("p"))
    rows = p.groupBy("p").agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()
    return train(np.array([r["p"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64))


def _quads(flat) -> list[tuple[int, ...]]:
    return [tuple(flat[i:i + 4]) for i in range(0, len(flat), 4)]


def _parsed(joined: str) -> list[tuple[str, int, int]]:
    parts = (x.split(":") for x in joined.split(",") if x)
    return [(k, int(a), int(b)) for k, a, b in parts]


def find_pii(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id_col, n_<base kind>..., n_added, base_sha256, spans)``, one row per input row."""
    ext = write_table(extract(docs, text_col, id_col), "pii-candidates")
    weights = fit(ext)

    def run(batches):
        for b in batches:
            counts, shas, spans = [[] for _ in range(len(BASE) + 1)], [], []
            for base, cands in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                own = _parsed(base)
                every = final_spans(own, _quads(cands), weights) if cands else own
                for i, k in enumerate(BASE):
                    counts[i].append(sum(s[0] == k for s in own))
                counts[-1].append(len(every) - len(own))
                shas.append(hashlib.sha256(base.encode()).hexdigest())
                spans.append(join_spans(every))
            yield pa.RecordBatch.from_arrays(
                [b.column(0)] + [pa.array(c, pa.int64()) for c in counts]
                + [pa.array(shas, pa.string()), pa.array(spans, pa.string())],
                names=["id"] + [f"n_{k}" for k in BASE] + ["n_added", "base_sha256", "spans"])

    schema = "id long, " + ", ".join(f"n_{k} long" for k in BASE) \
        + ", n_added long, base_sha256 string, spans string"
    return ext.mapInArrow(K.tidy(run), schema).withColumnRenamed("id", id_col)


def mask(text: str, spans) -> str:
    """The text with every span replaced by its kind; overlapping spans become one mask."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_col: str = "text", count_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span masked in its text, and the character count of changed rows renewed.

    Candidates are found again inside this pass, so no text is shuffled. A null
    text stays null, and so does its count.
    """
    with_id = docs.withColumn("_id", F.lit(None).cast("long")).select("_id", text_col)
    weights = fit(write_table(extract(with_id, text_col, "_id"), "pii-candidates"))
    at, schema = docs.columns.index(text_col), docs.schema
    count_at = docs.columns.index(count_col) if count_col in docs.columns else None

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            changed = set()
            for lo, data, off in K.text_chunks(b.column(at), K.SMALL_CHUNK):
                for d in _suspects(data, off).tolist():
                    t = texts[lo + d]
                    spans = final_spans(base_spans(t), candidates(t), weights)
                    if spans:
                        texts[lo + d] = mask(t, spans)
                        changed.add(lo + d)
            columns = list(b.columns)
            if changed:
                columns[at] = pa.array(texts, b.schema.field(at).type)
                if count_at is not None:
                    old = b.column(count_at).to_pylist()
                    columns[count_at] = pa.array(
                        [len(texts[i]) if i in changed else o for i, o in enumerate(old)],
                        b.schema.field(count_at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return docs.mapInArrow(K.tidy(run), schema)
