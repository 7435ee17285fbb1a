"""Registry of named queries over the driver tables.

Each query is a function ``(spark, sf_dir) -> DataFrame`` built only from
DataFrame operations; ``oracle`` holds an independent DuckDB SQL text over
the same tables (views named after the tables) when one exists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vellum.sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
FAMILY: dict[str, str] = {}


def query(name: str, oracle: str | None = None, family: str = ""):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name``."""

    def deco(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        FAMILY[name] = family or fn.__module__.rsplit(".", 1)[-1]
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn

    return deco
