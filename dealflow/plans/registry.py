"""Query registry: one Spark query per operator of the survey inventory, each paired with
a DuckDB oracle (or none for file round trips / non-SQL checks).

Every query reads the stand-in tables derived from the driver's parquet files (whole
tables, no sampling) and returns a lazy DataFrame whose column names equal the oracle's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import every query module so its ``@register`` calls run."""
    from dealflow.plans.queries import (  # noqa: F401
        q_functions,
        q_joins_aggs,
        q_models,
        q_quality_reconcile,
        q_sources_predicates,
    )
