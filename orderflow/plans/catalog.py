"""Registry of every query the library exposes: name -> Spark callable + DuckDB twin.

A Spark callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame built
from the driver's tables at ``sf_dir`` (so its work grows with them).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..params import DEFAULT, Params
from ..sources import store
from . import oracle_queries as OQ
from .oracle_tables import with_tables

SparkQuery = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, SparkQuery] = {}
_ORACLE: dict[str, Callable[[Params], str]] = {}


def register(name: str, oracle: Callable[[Params], str] | None = None):
    def deco(fn):
        _REGISTRY[name] = fn
        if oracle is not None:
            _ORACLE[name] = oracle
        return fn
    return deco


def _tables(spark: SparkSession, sf_dir: str, params: Params = DEFAULT):
    """The order book for ``sf_dir``: each stage that is asked for is derived once per
    session and sources, written as Parquet to the shared checkpoint folder, then read back."""
    return store.opened(spark, sf_dir, params)


def _oq(name: str):
    return lambda p: with_tables(OQ.queries(p)[name], p)


def _load():
    # importing the modules registers their queries
    from . import registry_defs  # noqa: F401


def spark_queries() -> dict[str, SparkQuery]:
    _load()
    return dict(_REGISTRY)


def oracle_sql(params: Params = DEFAULT) -> dict[str, str]:
    _load()
    return {name: fn(params) for name, fn in _ORACLE.items()}
