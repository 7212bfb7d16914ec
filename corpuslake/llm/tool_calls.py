"""Tool-call linking: calls and results joined, ordered, validated, serialised.

* Results are brought to one row per call id before the join (their number and
  the first content), calls likewise, so repeated ids multiply nothing and a hot
  id is summed where it is read.
* A call may depend on another. The dependency forest is levelled by pointer
  doubling: a round doubles the known distance to the ancestor, so a chain of
  ``n`` calls takes ``log2(n)`` joins, and no conversation is gathered anywhere.
  A call on a cycle never reaches a root; it is marked and comes last.
* The position in the conversation is the rank by (level, turn, id): every call
  comes after what it depends on. Ranks are taken over ranges of all calls, so a
  conversation with a third of the calls is spread over many tasks.
* Arguments are checked against the tool's schema (a subset of JSON Schema) and
  written as canonical JSON: sorted keys, no blanks, no escapes but needed ones.

Defined results: a call or result without an id cannot be linked and is a row of its
own with an error, as is a result whose call does not exist (no conversation, turn or
position); a null conversation is one of its own; missing results, unknown tools,
unparsable or null arguments and unresolved dependencies are named in ``errors``.
Arguments nested too deeply to parse, and numbers that JSON doesn't have, are not
JSON; lone surrogates are written as escapes. Of repeated ids the smallest row (of
results the smallest content) counts, in any order of rows. Texts are whole, extra
columns are ignored, empty tables give empty ones.
"""

from __future__ import annotations

import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import partitioned_offsets
from ..session import write_table
from . import kernels as K

_SURROGATE = re.compile("[\ud800-\udfff]")
_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list,
          "object": dict, "null": type(None)}
CYCLE_DEPTH = 1 << 62


def check(value, schema: dict, at: str = "") -> list[str]:
    """What in ``value`` violates ``schema`` (type, enum, bounds, lengths, properties)."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else list(kinds)
    if unknown := sorted(k for k in kinds if k not in _TYPES):
        raise ValueError(f"unknown schema types: {', '.join(unknown)}")
    fits = [k for k in kinds if isinstance(value, _TYPES[k]) and (k == "boolean" or not isinstance(value, bool))]
    if kinds and not fits:
        return [f"{at or '.'}: not {' or '.join(kinds)}"]
    kind, out = fits[0] if fits else None, []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not allowed")
    if kind in ("integer", "number"):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            out.append(f"{at}: out of bounds")
    if kind == "string" and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        out.append(f"{at}: wrong length")
    if kind == "array":
        for i, v in enumerate(value):
            out += check(v, schema.get("items", {}), f"{at}[{i}]")
    if kind == "object":
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += check(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: unknown")
    return out


def parsed(text: str | None):
    """The JSON value of ``text``; ValueError for what is none."""

    def refuse(name):
        raise ValueError(f"{name} is not JSON")

    try:
        return json.loads(text or "", parse_constant=refuse, parse_float=_finite)
    except RecursionError:
        raise ValueError("nested too deeply") from None


def _finite(text: str) -> float:
    x = float(text)
    if not math.isfinite(x):
        raise ValueError("beyond a number's range")
    return x


def canonical(value) -> str:
    out = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return _SURROGATE.sub(lambda m: f"\\u{ord(m[0]):04x}", out)


def _checked_schema(schema: dict) -> None:
    """Raises for types that :func:`check` doesn't know, before any job runs."""
    kinds = schema.get("type", [])
    bad = [k for k in ([kinds] if isinstance(kinds, str) else kinds) if k not in _TYPES]
    if bad:
        raise ValueError(f"unknown schema types: {bad}")
    for part in [*schema.get("properties", {}).values(), *([schema["items"]] if "items" in schema else [])]:
        _checked_schema(part)


def levels(calls: DataFrame) -> DataFrame:
    """``(call_id, depth, state)`` for ``(call_id, depends_on)`` with unique ids.

    ``state`` is ``ok``, ``missing`` (a call depends, perhaps over others, on an
    unknown id, which counts as a root above it) or ``cycle``.
    """
    known = calls.select(F.col("call_id").alias("up"), F.lit(True).alias("known"))
    step = calls.select("call_id", F.col("depends_on").alias("up")).join(known, "up", "left") \
        .select("call_id", F.when(F.col("known"), F.col("up")).alias("up"),
                (F.col("up").isNotNull() & F.col("known").isNull()).alias("missing"))
    step = write_table(step.select("call_id", "up", F.col("up").isNotNull().cast("long").alias("depth"),
                                   "missing"), "levels")
    n, reach = step.count(), 1
    while reach < n and step.where("up is not null").limit(1).count():
        far = step.select(F.col("call_id").alias("up"), F.col("up").alias("up2"),
                          F.col("depth").alias("depth2"), F.col("missing").alias("missing2"))
        step = write_table(step.join(far, "up", "left").select(
            "call_id", F.col("up2").alias("up"), (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth"),
            (F.col("missing") | F.coalesce("missing2", F.lit(False))).alias("missing")), "levels")
        reach *= 2
    state = F.when(F.col("up").isNotNull(), "cycle").when(F.col("missing"), "missing").otherwise("ok")
    # on a cycle depths only grow; such calls share one level after all others
    return step.select("call_id", F.when(F.col("up").isNotNull(), F.lit(CYCLE_DEPTH)).otherwise(F.col("depth"))
                       .alias("depth"), state.alias("state"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """``calls(conv_id, turn, call_id, name, arguments, depends_on)`` and
    ``results(call_id, content)`` linked: one row per call id with ``n_calls,
    n_results, depth, position, valid, errors, json``."""
    for schema in schemas.values():
        _checked_schema(schema)
    parts = ["conv_id", "turn", "name", "arguments", "depends_on"]
    one = calls.where("call_id is not null").groupBy("call_id").agg(
        F.min(F.struct(*parts)).alias("c"), F.count(F.lit(1)).alias("n_calls")) \
        .select("call_id", *[F.col(f"c.{p}").alias(p) for p in parts], "n_calls")
    one = write_table(one, "calls")
    res = results.where("call_id is not null").groupBy("call_id").agg(
        F.min("content").alias("content"), F.count(F.lit(1)).alias("n_results"))
    # any type of id, and no id that the null conversation could be mistaken for
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    # levels and positions move ids alone; arguments and contents meet them once
    slim = one.select("call_id", conv.alias("conv"), F.coalesce(F.col("turn"), F.lit(-1)).alias("_turn")) \
        .join(levels(one.select("call_id", "depends_on")), "call_id")
    place = partitioned_offsets(slim, "conv", ["depth", "_turn", "call_id"], ordinal_col="position") \
        .select("call_id", "depth", "state", "position")
    none = F.lit(0).cast("long")
    cols = ["conv_id", "turn", "call_id", "name", "arguments", "depends_on", "content", F.coalesce("n_calls", none).alias("n_calls"),
            F.coalesce("n_results", none).alias("n_results"), "depth", "position", F.coalesce("state", F.lit("ok")).alias("state")]
    rows = one.join(place, "call_id").join(res, "call_id", "full").select(*cols)
    # what has no id stands alone
    one_, zero = F.lit(1).cast("long"), none
    loose = calls.where("call_id is null").select("call_id", *parts).withColumn("n_calls", one_).withColumn("n_results", zero) \
        .unionByName(results.where("call_id is null").select("call_id", "content").withColumn("n_calls", zero)
                     .withColumn("n_results", one_), allowMissingColumns=True)
    null = lambda c, t: F.lit(None).cast(t).alias(c)
    rows = rows.unionByName(loose.select("conv_id", "turn", F.col("call_id").cast("string").alias("call_id"), "name", "arguments",
                                         "depends_on", "content", "n_calls", "n_results", null("depth", "long"),
                                         null("position", "long"), F.lit("ok").alias("state")))

    def run(batches):
        for b in batches:
            valid, errors, out = [], [], []
            for r in b.to_pylist():
                args, bad, extra = None, [], [] if r["state"] == "ok" else [f"depends_on: {r['state']}"]
                if not r["n_calls"]:
                    bad = ["call: missing"]
                else:
                    try:
                        args = parsed(r["arguments"])
                        bad = check(args, schemas[r["name"]]) if r["name"] in schemas else ["unknown tool"]
                    except ValueError:
                        bad = ["arguments: not JSON"]
                    except RecursionError:
                        args, bad = None, ["arguments: nested too deeply"]
                extra += ["call_id: missing"] * (r["call_id"] is None)
                extra += ["result: missing"] * (r["n_results"] == 0)
                extra += ["call: repeated id"] * (r["n_calls"] > 1) + ["result: repeated"] * (r["n_results"] > 1)
                valid.append(not bad)
                errors.append("; ".join(bad + extra))
                out.append(canonical({
                    "arguments": args, "depends_on": r["depends_on"], "id": r["call_id"],
                    "name": r["name"], "position": r["position"], "result": r["content"]}))
            keep = ["conv_id", "turn", "call_id", "depth", "position", "n_calls", "n_results"]
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(c)) for c in keep]
                + [pa.array(valid, pa.bool_()), pa.array(errors, pa.string()), pa.array(out, pa.string())],
                names=keep + ["valid", "errors", "json"])

    types = dict(rows.dtypes)
    return rows.mapInArrow(K.tidy(run), f"conv_id {types['conv_id']}, turn {types['turn']}, call_id string, "
                           f"depth {types['depth']}, position long, n_calls long, n_results long, "
                           "valid boolean, errors string, json string")


#: The tools that :func:`from_conversations` calls.
SCHEMAS = {
    "search": {"type": "object", "required": ["query", "limit"], "additionalProperties": False, "properties": {
        "query": {"type": "string", "minLength": 1, "maxLength": 2000},
        "limit": {"type": "integer", "minimum": 1, "maximum": 200}}},
    "translate": {"type": "object", "required": ["text", "to"], "additionalProperties": False, "properties": {
        "text": {"type": "string", "minLength": 1}, "to": {"type": "string", "enum": ["de", "en", "es", "fr"]}}},
    "count": {"type": "object", "required": ["words"], "properties": {
        "words": {"type": "integer", "minimum": 1}, "of": {"type": "string"}}},
}


def from_conversations(conv: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that a conversation's turns stand for.

    A user turn calls a tool chosen by its text's md5 and depends on the user
    turn two before; the assistant's next turn is the result. Turns of other roles
    stand for nothing; those without a conversation or turn have no call id.
    """
    text = F.coalesce("text", F.lit(""))
    ident = lambda t: F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), t.cast("string"))
    n_words = F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    pick = F.ascii(F.md5(text.cast("binary"))) % 3
    args = F.when(pick == 0, F.to_json(F.struct(text.alias("query"), n_words.alias("limit")))) \
        .when(pick == 1, F.to_json(F.struct(text.alias("text"), F.element_at(
            F.array(*map(F.lit, ["de", "en", "es", "fr", "xx"])), (F.length(text) % 5 + 1).cast("int")).alias("to")))) \
        .otherwise(F.to_json(F.struct(n_words.alias("words"), text.alias("of"))))
    name = F.when(pick == 0, "search").when(pick == 1, "translate").otherwise("count")
    calls = conv.where("role = 'user'").select(
        "conv_id", "turn", ident(F.col("turn")).alias("call_id"), name.alias("name"), args.alias("arguments"),
        F.when(F.col("turn") >= 2, ident(F.col("turn") - 2)).alias("depends_on"))
    results = conv.where("role = 'assistant'").select(
        ident(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results
