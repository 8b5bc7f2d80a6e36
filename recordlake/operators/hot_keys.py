"""Heavy keys: find them, and keep them out of shuffled joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.functions.columns import cols


def hot_keys(
    counts: DataFrame, keys: Sequence[str], hot_rows: int | Column, max_hot: int
) -> DataFrame:
    """The keys with more than ``hot_rows`` records, the ``max_hot`` heaviest at most.

    ``counts`` has the keys and ``records``. The result is small by construction,
    so it may be broadcast. Nothing is lost by the limit: a key left out is
    handled by the shuffle, and holds no more than ``1 / max_hot`` of all rows.
    Ties are broken by key, so every evaluation finds the same keys.
    """
    return (
        counts.where(F.col("records") > hot_rows)
        .orderBy(F.col("records").desc(), *cols(keys))
        .limit(max_hot)
        .select(*cols(keys))
    )


def split_hot(
    df: DataFrame, keys: Sequence[str], hot: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Split rows into those with a hot key and the others, without a shuffle."""
    heavy = df.join(F.broadcast(hot), list(keys), "left_semi")
    rest = df.join(F.broadcast(hot), list(keys), "left_anti")
    return heavy.select(*cols(df.columns)), rest.select(*cols(df.columns))
