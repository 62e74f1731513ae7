"""Every operator as a query over the supplied tables, with SQL that says what it must return."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from importlib import import_module
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

from dayline.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL if there is any."""
    def register(fn):
        QUERIES[fn.__name__] = shipped(fn)
        if sql:
            ORACLE[fn.__name__] = dedent(sql).strip()
        return fn
    return register


def shipped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query in any session: its workers get this package first, as those of ``build_session`` do."""
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ship(spark), sf_dir)
    return run


def load_all() -> None:
    for module in ("sources", "sinks", "columns", "joins", "aggregates", "windows", "analysis",
                   "models", "flows"):
        import_module(f"{__name__}.{module}")
