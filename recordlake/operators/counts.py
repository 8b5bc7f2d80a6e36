"""Counting operators. Every one of them returns a lazy frame.

All are hash aggregations with a partial step before the shuffle, so a value
that holds a large share of the rows arrives as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.functions.columns import col, cols
from recordlake.operators.hot_keys import hot_keys, split_hot


def key_counts(df: DataFrame, keys: Sequence[str], ordered: bool = True) -> DataFrame:
    """Rows per combination of keys, as ``records``; NULL is a group of its own.

    Ordered by the keys, NULL first, unless ``ordered`` is false.
    """
    counts = df.groupBy(*cols(keys)).agg(F.count("*").alias("records"))
    return counts.orderBy(*cols(keys)) if ordered else counts


def value_counts(df: DataFrame, column: str, ordered: bool = True) -> DataFrame:
    """Value frequency of one column."""
    return key_counts(df, [column], ordered)


def share_of_total(df: DataFrame, keys: Sequence[str], ordered: bool = True) -> DataFrame:
    """Rows per combination of keys and their share of all rows in percent.

    The total is a scalar subquery that adds up the counts, so ``df`` is read once
    and the counts' shuffle is used twice. A window over the groups would bring all
    of them to one task.
    """
    counts = key_counts(df, keys, ordered=False)
    total = counts.agg(F.sum("records")).scalar()
    shares = counts.withColumn("percent", F.try_divide("records", total) * 100)
    return shares.orderBy(*cols(keys)) if ordered else shares


def repeat_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their row count."""
    return key_counts(df, keys, ordered=False).where("records > 1")


def repeat_key_records(
    df: DataFrame, keys: Sequence[str], hot_rows: int = 1_000_000, max_hot: int = 10_000
) -> DataFrame:
    """All records whose key occurs more than once. Rows with a NULL key are not kept.

    The heaviest keys are known to repeat: their records need no shuffle. The
    others are matched by a shuffled semi join in which no key is heavy.
    """
    keyed = df
    for key in keys:
        keyed = keyed.where(col(key).isNotNull())
    counts = repeat_keys(keyed, keys)
    hot = hot_keys(counts, keys, hot_rows, max_hot)
    heavy, rest = split_hot(keyed, keys, hot)
    matched = rest.join(counts.select(*cols(keys)), list(keys), "left_semi")
    return heavy.unionByName(matched)


def records_per_key_range(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Least and most rows that any one key has."""
    return key_counts(df, keys, ordered=False).agg(
        F.min("records").alias("min_records"), F.max("records").alias("max_records")
    )


def group_min_max_count(
    df: DataFrame, keys: Sequence[str], column: str, ordered: bool = True
) -> DataFrame:
    """Least and greatest value of a column and the row count, per group."""
    result = df.groupBy(*cols(keys)).agg(
        F.min(col(column)).alias("min_value"),
        F.max(col(column)).alias("max_value"),
        F.count("*").alias("records"),
    )
    return result.orderBy(*cols(keys)) if ordered else result


def min_max(df: DataFrame, column: str) -> DataFrame:
    """Least and greatest value of a column over all rows."""
    return df.agg(
        F.min(col(column)).alias("min_value"), F.max(col(column)).alias("max_value")
    )


def row_count(df: DataFrame, condition: Column | str | None = None) -> DataFrame:
    """Number of rows, of those that meet a condition if one is given."""
    rows = df if condition is None else df.where(condition)
    return rows.agg(F.count("*").alias("records"))


def non_null_count(
    df: DataFrame, column: str, condition: Column | str | None = None
) -> DataFrame:
    """Number of non-NULL values of a column among the rows that meet a condition."""
    rows = df if condition is None else df.where(condition)
    return rows.agg(F.count(col(column)).alias("records"))


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct values of a column. NULL counts as one value."""
    return df.select(col(column)).distinct().agg(F.count("*").alias("distinct_values"))


def date_part_counts(
    df: DataFrame, date: str, keys: Sequence[str] = (), ordered: bool = True
) -> DataFrame:
    """Rows per year and month of a date, below optional leading keys."""
    parts = df.select(
        *cols(keys),
        F.year(col(date)).alias("date_year"),
        F.month(col(date)).alias("date_month"),
    )
    return key_counts(parts, [*keys, "date_year", "date_month"], ordered)


def presence_counts(
    df: DataFrame, keys: Sequence[str], column: str, ordered: bool = True
) -> DataFrame:
    """Rows per key and per flag ``has_<column>``: ``Y`` if not NULL, else ``N``."""
    flag = f"has_{column}"
    flagged = df.select(
        *cols(keys), F.when(col(column).isNotNull(), "Y").otherwise("N").alias(flag)
    )
    return key_counts(flagged, [*keys, flag], ordered)
