"""The register of queries: each with its SQL twin, where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wayfold.sources.fixtures import duckdb_text

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: str = "") -> Callable[[Query], Query]:
    """Registers a query; `uses` names the derived views that its SQL reads."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            views = ", ".join(f"{v} AS ({duckdb_text(v)})" for v in uses.split())
            ORACLES[name] = f"WITH {views} {sql}" if views and not sql.lstrip().startswith("WITH+") else sql.replace("WITH+", f"WITH {views}," if views else "WITH", 1)
        return f

    return add
