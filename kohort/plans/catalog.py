"""Registry of named queries and their SQL oracles.

Every query takes ``(spark, data_dir)`` and returns a DataFrame over the
whole input tables.  Most are lazy; those with quantiles, imputation, pivots
over values found in the data, or a model run jobs while they are built and
continue from tables written to the shared checkpoint folder.  The oracle, when there is one, is DuckDB SQL over
the same base tables (registered as views), re-deriving everything.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from ..sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
SURVEY_IDS: dict[str, str] = {}


def register(name: str, survey_id: str, sql: str | None = None):
    """Decorator: register ``fn(t: Tables) -> DataFrame`` under ``name``."""

    def wrap(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        SURVEY_IDS[name] = survey_id
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


def load_all() -> None:
    """Import every query module so the registry is complete."""
    from . import (  # noqa: F401
        aggregate_queries,
        profile_queries,
        sql_queries,
        cohort_queries,
    )
