"""Profile every column of a lake and export the value counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from recordlake.operators.counts import value_counts
from recordlake.operators.profiling import first_value_counts, profile_value_counts
from recordlake.sources.readers import read_lake
from recordlake.sources.writers import write_csv_tables, write_value_counts_csv


def export_column_profile(
    spark: SparkSession,
    lake_path: str,
    out: str,
    n: int | None = None,
    near_unique: Sequence[str] | None = None,
    mode: str = "errorifexists",
) -> None:
    """Write the value counts of all columns, the first ``n`` of each if given: a CSV folder per column.

    Each folder has the columns ``position, value, records``. See :func:`profile_value_counts`.
    """
    profile = profile_value_counts(read_lake(spark, lake_path), n=n, near_unique=near_unique)
    write_csv_tables(profile, out, "column_name", mode)


def export_value_counts(
    df: DataFrame,
    column: str,
    path: str,
    n: int | None = None,
    near_unique: bool = False,
    mode: str = "errorifexists",
) -> None:
    """Write the value counts of one column as ``<column>,count``, the first ``n`` if given."""
    if near_unique and n is not None:
        counts = first_value_counts(df, column, n, sample_fraction=0.01)
    else:
        counts = value_counts(df, column, ordered=False)
    write_value_counts_csv(counts, column, path, n, mode=mode)
