"""Registry of checkable queries: name → (Spark builder, DuckDB oracle or None).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables (or data Spark derives from them).  Oracles are written
independently in DuckDB SQL over the same tables; only the retail → CRM
mapping is shared (see ``oracle_views``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load() -> None:
    # Importing the query modules fills the registry.
    from leadlens.plans import q_eval, q_features, q_models, q_quality, q_scores  # noqa: F401
