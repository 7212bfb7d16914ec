"""Text column expressions: cleaning, splitting, prompt formatting.

Every function maps Column(s) to a Column built from Spark SQL built-ins, so
the work stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

_WS_TRIM = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


def _lit(s):
    return F.lit(s) if isinstance(s, str) else s


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: trim every Unicode whitespace character."""
    return _trim_chars(_col(c), _WS_TRIM)


def _trim_chars(c: Column, chars: str) -> Column:
    # btrim(str, trimStr) removes any character of trimStr from both ends.
    return F.call_function("btrim", c, F.lit(chars))


def strip_boilerplate(c, start_markers=None, end_markers=None) -> Column:
    """B1: cut a book to the text between start and end markers, then strip.

    Start: the first marker (list order) that is found and followed by a
    newline; the text starts after that newline. End: the first end marker
    (list order) found anywhere. Empty when end precedes start.
    """
    t = _col(c)
    starts = start_markers if start_markers is not None else fixed.START_MARKERS
    ends = end_markers if end_markers is not None else fixed.END_MARKERS
    start_opts = []
    for m in starts:
        pos = F.instr(t, m)
        nl = F.call_function("locate", F.lit("\n"), t, pos)
        start_opts.append(F.when((pos > 0) & (nl > 0), nl + 1))
    start = F.coalesce(*start_opts, F.lit(1))          # 1-based first kept char
    end_opts = [F.when(F.instr(t, m) > 0, F.instr(t, m)) for m in ends]
    end = F.coalesce(*end_opts, F.length(t) + 1)       # 1-based first cut char
    n = F.greatest(end - start, F.lit(0))
    return py_strip(F.call_function("substr", t, start, n))


def ascii_ratio(c) -> Column:
    """Share of code points below 128; NULL for empty text."""
    t = _col(c)
    ascii_n = F.length(F.regexp_replace(t, r"[^\x00-\x7F]", ""))
    return ascii_n / F.nullif(F.length(t), F.lit(0))


def ascii_filter(c, threshold: float = 0.9) -> Column:
    """B2 predicate: keep when the ASCII share is strictly above threshold.

    Empty text has no share and is dropped (the reference divides by zero).
    """
    return F.coalesce(ascii_ratio(c) > F.lit(threshold), F.lit(False))


def collapse_blank_lines(c) -> Column:
    """Every run ``\\n <whitespace>* \\n`` becomes exactly two newlines."""
    return F.regexp_replace(_col(c), r"\n" + fixed.WS + r"*\n", "\n\n")


def byte_length(c) -> Column:
    """UTF-8 size in bytes."""
    return F.octet_length(_col(c))


def char_length(c) -> Column:
    """Size in code points."""
    return F.length(_col(c))


def append_separator(c, sep: str = " " + fixed.ENDOFTEXT + " ") -> Column:
    """B5 (per document form): the text followed by the separator."""
    return F.concat(_col(c), F.lit(sep))


def join_ordered(texts_with_order: Column, sep: str = fixed.ENDOFTEXT) -> Column:
    """B5 (grouped form): an aggregate joining texts in order with ``sep``.

    ``texts_with_order`` is ``struct(order_key, text)``; use inside ``agg``.
    """
    arr = F.sort_array(F.collect_list(texts_with_order))
    return F.array_join(F.transform(arr, lambda s: s["text"]), sep)


# --- word-level tokenizer --------------------------------------------------

# A word's characters up to U+00FF one by one, which Java looks up in one table of bits; a range, or a
# class with "^", is a chain of calls for every character. Wider ones and single dashes are rare.
_NARROW = "[" + "".join(f"\\x{{{i:x}}}" for i in range(256)
                        if not chr(i).isspace() and chr(i) not in fixed.WORD_DELIMS + "-") + "]"
_WIDE = "[\\x{100}-\\x{10ffff}&&[^" + fixed.WS_CHARS + "]]"       # the range first: nothing more is tried below it
_REST = f"{_NARROW}*+(?:(?:{_WIDE}++|-(?!-)){_NARROW}*+)*+"
_WORD_TOKEN = f"{_NARROW}+{_REST}|[{re.escape(fixed.WORD_DELIMS)}]|--|(?:{_WIDE}|-){_REST}"


def word_split(c) -> Column:
    """Split on the delimiters and whitespace keeping the delimiters.

    Equal to splitting on ``([,.:;?_!"()']|--|\\s)`` with the delimiters
    kept, stripping the pieces and dropping empty ones.
    """
    return F.regexp_extract_all(_col(c), F.lit(_WORD_TOKEN), F.lit(0))


def word_decode_text(tokens, punct: str = fixed.DECODE_PUNCT_V2) -> Column:
    """Join tokens with spaces, drop the whitespace before punctuation."""
    joined = F.array_join(_col(tokens), " ")
    return F.regexp_replace(joined, fixed.WS + "+([" + re.escape(punct) + "])", "$1")


def pre_split(c, pattern: str = fixed.GPT2_SPLIT_PATTERN) -> Column:
    """All matches of a GPT-style split pattern (Unicode classes on)."""
    return F.regexp_extract_all(_col(c), F.lit("(?U)" + pattern), F.lit(0))


def split_specials(c, specials) -> Column:
    """Pieces of the text around exact special-token matches.

    Returns ``array<struct<s:string, is_special:boolean>>``; empty pieces
    are dropped. Longer specials are matched first.
    """
    specials = sorted(set(specials), key=lambda s: (-len(s), s))
    for a in specials:
        for b in specials:
            if a != b and a in b:
                raise ValueError(f"special {a!r} is contained in {b!r}")
    t = _col(c)
    if specials:
        # a special, or a run of anything else; only a special's first character is looked ahead from
        alts = "|".join(rx_escape(s) for s in specials)
        heads = "".join(sorted({re.escape(s[0]) for s in specials}))
        parts = F.regexp_extract_all(t, F.lit(f"(?s){alts}|(?:[^{heads}]+|(?!{alts})[{heads}])+"), F.lit(0))
    else:
        parts = F.filter(F.array(t), lambda p: F.length(p) > 0)
    spec = F.array(*[F.lit(s) for s in specials]) if specials else F.array().cast("array<string>")
    return F.transform(parts, lambda p: F.struct(p.alias("s"),
                                                 F.array_contains(spec, p).alias("is_special")))


# --- instruction data ------------------------------------------------------

def format_prompt(instruction, input_=None, output=None) -> Column:
    """Header + instruction (+ input when non-empty) (+ response)."""
    ins = _col(instruction)
    parts = [F.lit(fixed.PROMPT_HEADER + fixed.INSTRUCTION_TAG), ins]
    if input_ is not None:
        inp = F.coalesce(_col(input_), F.lit(""))
        parts.append(F.when(F.length(inp) > 0, F.concat(F.lit(fixed.INPUT_TAG), inp))
                     .otherwise(F.lit("")))
    if output is not None:
        parts += [F.lit(fixed.RESPONSE_TAG), F.coalesce(_col(output), F.lit(""))]
    return F.concat(*parts)


def extract_response(generated, prompt) -> Column:
    """Text after the prompt, every response tag removed, stripped."""
    g = _col(generated)
    rest = F.call_function("substr", g, F.length(_col(prompt)) + 1)
    return py_strip(F.replace(rest, F.lit(fixed.RESPONSE_MARK), F.lit("")))


def rx_escape(s: str) -> str:
    """Escape regex metacharacters only (valid in Java regex and RE2)."""
    return "".join("\\" + ch if ch in "\\.^$|?*+()[]{}" else ch for ch in s)


TEMPLATE_PATTERN = ("(?s)^" + rx_escape(fixed.PROMPT_HEADER + fixed.INSTRUCTION_TAG)
                    + ".+?(" + rx_escape(fixed.INPUT_TAG) + ".+?)?"
                    + rx_escape(fixed.RESPONSE_TAG) + ".*$")


def template_ok(c) -> Column:
    """Does the text follow the prompt template (with a response)?"""
    return F.coalesce(_col(c).rlike(TEMPLATE_PATTERN), F.lit(False))
