"""Query registry: name -> (Spark query, oracle SQL or None)."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    fn: QueryFn
    sql: Callable[[], str] | None
    covers: tuple[str, ...]
    doc: str


REGISTRY: dict[str, Entry] = {}


def query(name: str, covers: tuple[str, ...] = (), sql: Callable[[], str] | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(fn, sql, covers, (fn.__doc__ or "").strip())
        return fn
    return deco


def _load() -> None:
    from . import q_baseline, q_features, q_geo, q_io, q_reshape, q_scoring, q_models  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load()
    return {k: v.fn for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v.sql() for k, v in REGISTRY.items() if v.sql is not None}
