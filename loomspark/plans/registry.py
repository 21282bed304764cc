"""Queries by name, each with the SQL that gives the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomspark.sources.tables import oracle_prefix, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, raw: bool = False):
    """Registers f(t), t giving tables by name. sql: a select over generated and derived tables, after own common tables if it begins with a comma."""

    def put(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: table(spark, sf_dir, name))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLE[f.__name__] = sql if raw else f"{oracle_prefix()} {sql}"
        return f

    return put
