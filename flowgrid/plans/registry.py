"""Query registry: key -> (callable(spark, sf_dir) -> DataFrame, oracle SQL | None).

Oracle SQL is written for DuckDB over the pre-registered driver views; the
mobility stand-in tables come from ``adapters.ADAPTER_SQL``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from flowgrid.plans.adapters import ADAPTER_SQL


@dataclass
class Entry:
    key: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Entry] = {}


def query(key: str, sql: str | None = None, note: str = ""):
    """Decorator registering a query under ``key``."""

    def deco(fn):
        if key in REGISTRY:
            raise KeyError(f"duplicate query key {key}")
        REGISTRY[key] = Entry(key, fn, sql, note)
        return fn

    return deco


def with_adapters(body: str) -> str:
    """``body`` is ``cte AS (...), ... SELECT ...`` or a bare ``SELECT``."""
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return f"WITH {ADAPTER_SQL}\n{body}"
    return f"WITH {ADAPTER_SQL},\n{body}"
