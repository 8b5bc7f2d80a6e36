"""Bounded ordered results. Spark plans each as a top-n, not as a full sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from recordlake.functions.columns import col, cols


def first_by_key(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in ascending key order, NULL first."""
    return df.orderBy(*cols(keys)).limit(n)


def last_by_key(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The ``n`` rows with the greatest keys, greatest first, NULL last."""
    return df.orderBy(*[col(k).desc() for k in keys]).limit(n)
