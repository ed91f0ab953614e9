"""Registered queries: one per operator unit, each with an optional DuckDB oracle text.

Each query takes ``(spark, sf_dir)``, reads the given tables (or data Spark derives from
them) in full, and returns a DataFrame whose computed columns carry the same aliases as the
oracle SQL. Doubles are rounded to 6 digits on both sides for engine-independent hashing.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco


MODULES = ("q_prep", "q_splits", "q_metrics", "q_tensor", "q_train", "q_sources")


def load_all() -> None:
    import importlib

    for m in MODULES:
        try:
            importlib.import_module(f"{__name__}.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"{__name__}.{m}":
                raise
