"""Imports every query module so the registry is complete."""

from __future__ import annotations

import importlib

from .registry import ORACLE, QUERIES

_MODULES = ["q_text", "q_bpe", "q_seq", "q_eval", "q_vec", "q_stream"]


def load_all():
    for m in _MODULES:
        try:
            importlib.import_module(f"{__package__}.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"{__package__}.{m}":
                raise
    return QUERIES, ORACLE
