"""The registered queries over the benchmark tables, each with an equivalent SQL text where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelwright.registry import datasets, listings, models, pages, panels, relational, scans

Query = Callable[[SparkSession, str], DataFrame]


def _entries() -> dict[str, tuple[Query, str | None]]:
    out: dict[str, tuple[Query, str | None]] = {}
    for module in (panels, relational, datasets, listings, models, pages, scans):
        for name, entry in module.QUERIES.items():
            if name in out:
                raise ValueError(f"query {name} is registered twice")
            out[name] = entry
    return out


def all_queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in _entries().items()}


def all_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _entries().items() if sql is not None}
