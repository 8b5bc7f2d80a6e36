"""Analyst queries over a lake, by DataFrame or by SQL text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from recordlake.functions.columns import col
from recordlake.operators.counts import key_counts, share_of_total
from recordlake.plans import visits


def months_of_year(
    lake: DataFrame,
    year: int,
    months: Sequence[int],
    year_column: str = visits.PARTITION_BY[0],
    month_column: str = visits.PARTITION_BY[1],
) -> DataFrame:
    """Some months of a year; prunes to their directories."""
    return lake.where((col(year_column) == year) & col(month_column).isin(list(months)))


def label_type_counts(lake: DataFrame) -> DataFrame:
    """Records by year, month, visa label and visa type."""
    return key_counts(lake, [*visits.PARTITION_BY, "i94visa_value", "visatype"])


def label_counts(lake: DataFrame) -> DataFrame:
    """Records by year, month and visa label."""
    return key_counts(lake, [*visits.PARTITION_BY, "i94visa_value"])


def type_counts(lake: DataFrame) -> DataFrame:
    """Records by year, month and visa type."""
    return key_counts(lake, [*visits.PARTITION_BY, "visatype"])


def month_counts(lake: DataFrame) -> DataFrame:
    """Records by year and month."""
    return key_counts(lake, visits.PARTITION_BY)


def month_shares(lake: DataFrame) -> DataFrame:
    """Records by year and month, with their percentage of all."""
    return share_of_total(lake, visits.PARTITION_BY)


def query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Run SQL text over frames named in braces: ``select ... from {lake}``."""
    return spark.sql(sql, **frames)


def register(frames: dict[str, DataFrame]) -> None:
    """Make frames known to SQL text under plain names, for this session."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
