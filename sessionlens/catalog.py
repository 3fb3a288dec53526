"""Registry of named queries: name -> f(spark, sf_dir) -> DataFrame.

Each query reads the driver tables in ``sf_dir`` (through the adapter) and
returns a DataFrame. Those about loads, written tables, quintiles and checks
write tables into the shared folder when called; the rest is lazy. The DuckDB
twin of each
query, where one exists, is in ``sessionlens.oracle_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sessionlens.build import Build
from sessionlens.config import DEFAULT, Params

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Callable[[Build], DataFrame]] = {}


def query(name: str):
    def deco(fn: Callable[[Build], DataFrame]):
        _REGISTRY[name] = fn
        return fn

    return deco


def _bind(fn: Callable[[Build], DataFrame], params: Params) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Build(spark, sf_dir, params))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries(params: Params = DEFAULT) -> dict[str, Query]:
    # Import the modules that register queries.
    from sessionlens.plans import registry  # noqa: F401

    return {name: _bind(fn, params) for name, fn in _REGISTRY.items()}
