"""Name -> (Spark plan builder, DuckDB oracle SQL) registry.

Each plan module registers its queries with :func:`query`; the oracle text sits
beside the Spark code so both sides are reviewed together.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Entry:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    section: str


_REGISTRY: dict[str, Entry] = {}


def query(name: str, section: str, oracle: str | None = None):
    def deco(fn):
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Entry(name, fn, oracle, section)
        return fn
    return deco


def _load():
    # importing the plan modules fills the registry
    from tabprism.plans import (explain_plans, model_plans, prep_plans,  # noqa: F401
                                profile_plans, text_plans)


def entries() -> dict[str, Entry]:
    _load()
    return dict(_REGISTRY)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: e.build for k, e in entries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: e.oracle for k, e in entries().items() if e.oracle}
