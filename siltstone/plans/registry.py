"""Queries with their SQL: a decorator that collects both."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.runtime import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The tables of a directory as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.dir, name)


def query(sql: str | None = None):
    """Registers a function of Tables as a query by its name, with the SQL that gives the same rows."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, d: f(Tables(spark, d))
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add
