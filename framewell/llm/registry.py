"""Queries of the subpackage: every module of PLANS gives QUERIES, name -> (builder, oracle SQL or None)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

PLANS: tuple[str, ...] = ("q_jaccard", "q_suffix", "q_packing", "q_wordpiece", "q_language", "q_order", "q_licenses", "q_decontam", "q_interpolation", "q_hnsw", "q_bitslice", "q_exact", "q_collocations")


def _all() -> dict[str, tuple[Callable, str | None]]:
    out: dict[str, tuple[Callable, str | None]] = {}
    for name in PLANS:
        out |= importlib.import_module(f"framewell.llm.{name}").QUERIES
    return out


def queries() -> dict[str, Callable]:
    return {name: build for name, (build, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _all().items() if sql}
