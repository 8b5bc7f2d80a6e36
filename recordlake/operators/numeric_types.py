"""Which integer type, if any, would hold the values of a double column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from recordlake.functions.columns import col, columns_with_dtype

# The names that recommendations use, the int limit and 2**63.
INT_TYPE = "IntegerType"
LONG_TYPE = "LongType"
KEEP_TYPE = "double"
INT_LIMIT = 2147483647
LONG_BOUND = 9223372036854775808.0
_SQL_TYPES = {INT_TYPE: "int", LONG_TYPE: "bigint"}


def recommend_numeric_types(
    df: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """Recommended type of each double column: ``column_name, proposed``.

    ``double`` if any value has a fraction, is NaN or lies beyond bigint;
    ``IntegerType`` if all absolute values are under 2147483647; ``LongType``
    otherwise, also for a column that is NULL throughout.

    All columns are judged by one aggregation: one scan, one row per task
    shuffled.
    """
    columns = list(columns if columns is not None else columns_with_dtype(df, "double"))
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, proposed string")
    checks = []
    for i, name in enumerate(columns):
        value = col(name)
        is_other = (
            F.isnan(value)
            | (F.rint(value) != value)
            | (value >= LONG_BOUND)
            | (value < -LONG_BOUND)
        )
        checks.append(F.coalesce(F.bool_or(is_other), F.lit(False)).alias(f"other{i}"))
        checks.append(F.max(F.abs(value)).alias(f"greatest{i}"))
    proposals = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.when(F.col(f"other{i}"), KEEP_TYPE)
            .when(F.col(f"greatest{i}") < INT_LIMIT, INT_TYPE)
            .otherwise(LONG_TYPE)
            .alias("proposed"),
        )
        for i, name in enumerate(columns)
    ]
    return df.agg(*checks).select(F.inline(F.array(*proposals)))


def apply_numeric_types(df: DataFrame, proposals: list[Row]) -> DataFrame:
    """Cast columns to their recommended types.

    ``proposals`` are the collected rows of :func:`recommend_numeric_types`, one
    per column.
    """
    casts = {
        p["column_name"]: col(p["column_name"]).try_cast(_SQL_TYPES[p["proposed"]])
        for p in proposals
        if p["proposed"] in _SQL_TYPES
    }
    return df.withColumns(casts) if casts else df
