"""Registered queries of the library's own operators: name -> (builder, oracle SQL)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

#: Modules of framewell.plans that register queries.
MODULES: tuple[str, ...] = ("profiling", "joining", "ranking", "sequencing", "vectoring", "texts", "ruling", "systems", "scalars", "artifacts", "serving", "machines", "extracting")


def _all() -> dict[str, tuple[Callable, str | None]]:
    out: dict[str, tuple[Callable, str | None]] = {}
    for name in MODULES:
        out |= importlib.import_module(f"framewell.plans.{name}").QUERIES
    return out


def queries() -> dict[str, Callable]:
    return {name: build for name, (build, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _all().items() if sql}
