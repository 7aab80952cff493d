"""Named queries and, where SQL can say the same, their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimloom.plans.views import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(tables)`` under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql:
            ORACLE[name] = sql
        return build

    return register
