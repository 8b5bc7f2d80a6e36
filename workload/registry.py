"""The list of queries, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    """Register the decorated function under its name, with its SQL."""

    def register(function):
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function

    return register
