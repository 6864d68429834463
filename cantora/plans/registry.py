"""Registry of named queries and their DuckDB oracles.

``@query("key", oracle=SQL)`` registers a ``(spark, sf_dir) -> DataFrame``
function. Registered results pass through ``finalize``: exact decimal amounts
become doubles (the decimal is exact, its conversion correctly rounded, so both
engines agree), every other type is kept. Oracles cast the same columns with
``CAST(... AS DOUBLE)``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from cantora.sources.bridge import Star
from cantora.sources.warehouse import star

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def finalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cols.append(c.cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else c)
    return df.select(*cols)


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with an optional oracle."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finalize(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def star_query(name: str, oracle: str | None = None):
    """Like ``query`` for functions of a ``Star``: ``fn(star) -> DataFrame``."""
    def deco(fn: Callable[[Star], DataFrame]):
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(star(spark, sf_dir))
        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        query(name, oracle)(wrapped)
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib
    for mod in ("scans", "cleaning", "filters", "joins", "aggregates", "windows",
                "ordering", "kpis", "forecasting", "quality", "parameters"):
        try:
            importlib.import_module(f"cantora.plans.{mod}")
        except ModuleNotFoundError as e:  # modules are added as coverage grows
            if e.name != f"cantora.plans.{mod}":
                raise
