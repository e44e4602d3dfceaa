"""Query registry: name -> (Spark job, independent DuckDB oracle SQL).

Each job takes ``(spark, sf_dir)`` and reads the parquet tables there (or
data Spark derives from them), so its work grows with the tables.  The
oracle SQL is written separately against the same tables; a job without an
oracle is checked on row counts plus unit tests against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Job] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Job) -> Job:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    from . import catalog_history, catalog_listings, catalog_nested, catalog_notes, catalog_sources  # noqa: F401


def queries() -> dict[str, Job]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
