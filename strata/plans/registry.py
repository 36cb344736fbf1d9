"""Named queries with their SQL oracles.

Each registered query takes ``(spark, sf_dir)`` and returns a DataFrame over
the benchmark tables; the optional oracle is the same result written as plain
SQL over those tables (DuckDB dialect), used to check the Spark plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}

# Fixed load stamp of registered queries, so their output is reproducible.
LOAD_TS = "2024-01-01T00:00:00"


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from strata.plans import (  # noqa: F401
        forensic_queries,
        history_queries,
        io_queries,
        log_queries,
        stream_queries,
        vault_queries,
    )


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)
