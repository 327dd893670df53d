"""Registered queries: name → (Spark callable(spark, sf_dir), DuckDB oracle SQL or None).

Every query reads the driver's tables (or frames Spark derives from them) in
full. ``None`` as oracle marks results SQL cannot reproduce (fitted models,
random splits); those are checked by row count here and by invariants in the
tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn

    return deco


def _load() -> None:
    # Importing the modules registers their queries.
    from fundcast.plans import queries_campaign  # noqa: F401
    from fundcast.plans import queries_files  # noqa: F401
    from fundcast.plans import queries_text  # noqa: F401
    from fundcast.plans import queries_ml  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
