"""Queries of the pipeline operators: thin calls over whole tables.

Tool calls and exact similarity classes have an oracle in SQL; forests,
classifiers, tokenizers and alignments are held against brute force and held-out
labels in tests/llm.
"""

from __future__ import annotations

from . import collocations, decontaminate, linear, oracles, packing, pii, prefix_trie, quality_forest, token_counts, token_files
from . import simhash, tool_calls, toxicity
from .common import table
from .near_dups import near_duplicates

QUERIES: dict = {}
ORACLE = {"op4_tool_calls": oracles.TOOL_CALLS, "op5_superminhash": oracles.NEAR_DUPLICATES,
          "op11_burst_trie": oracles.PREFIX_TRIE, "op12_dynamic_phrases": oracles.COLLOCATIONS}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_isolation_forest(spark, sf_dir):
    """Rule statistics, base verdict and the isolation forest's verdict of every document."""
    return quality_forest.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_weak_pii(spark, sf_dir):
    """Base and added spans of personal data of every document."""
    return pii.find_pii(table(spark, sf_dir, "documents"))


@query
def op3_ftrl_quality(spark, sf_dir):
    """Quality score of every document."""
    return linear.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_tool_calls(spark, sf_dir):
    """Every call of every conversation, linked, ordered, checked and serialised."""
    calls, results = tool_calls.from_conversations(table(spark, sf_dir, "conversations"))
    return tool_calls.link_tool_calls(calls, results, tool_calls.SCHEMAS)


@query
def op5_superminhash(spark, sf_dir):
    """One row per document: its duplicate class at 85 % of three-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


@query
def op6_token_files(spark, sf_dir):
    """Ids of every document as read back from the compressed shards."""
    return token_files.round_trip(table(spark, sf_dir, "documents"))


@query
def op7_toxic_segments(spark, sf_dir):
    """Toxicity score and passages of every document."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_token_counts(spark, sf_dir):
    """Token count of every document."""
    return token_counts.count_documents(table(spark, sf_dir, "documents"))


@query
def op9_sum_of_squares(spark, sf_dir):
    """Every piece of every document and its place in a sequence."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op10_qgram_decontamination(spark, sf_dir):
    """Every benchmark passage found in every document."""
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_burst_trie(spark, sf_dir):
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op12_dynamic_phrases(spark, sf_dir):
    """The 2,000 firmest phrases of two and three words of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op13_simhash(spark, sf_dir):
    """Fingerprint of three-word shingles of every document, and its class at three differing bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, radius=3)
