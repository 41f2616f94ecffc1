"""Registry of named queries: each is (spark, sf_dir) -> DataFrame, with the
equivalent DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[Callable, str | None]]:
    # Importing the modules registers their queries.
    from vireo.plans import (q_prepare, q_quality, q_features, q_joins, q_profile,  # noqa: F401
                             q_drift, q_evaluate, q_privacy, q_explore, q_kpi, q_stream, q_ml, q_io, q_jobs)
    return REGISTRY
