"""Extract the code tables from format text and keep them as CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.operators.code_tables import Section, extract_code_tables
from recordlake.operators.quality import key_checks
from recordlake.plans import visits
from recordlake.sources.readers import read_exported
from recordlake.sources.writers import write_csv_tables


def export_code_tables(
    spark: SparkSession,
    text_path,
    out: str,
    sections: Sequence[Section] = visits.CODE_TABLES,
    mode: str = "errorifexists",
) -> None:
    """Write every code table to ``<out>/lookup=<name>/`` with columns ``key,value``."""
    tables = extract_code_tables(spark, text_path, sections, ordered=False)
    labelled = tables.select(
        F.col("section").alias("lookup"), "key", "value"
    ).orderBy("lookup", "key")
    write_csv_tables(labelled, out, "lookup", mode)


def read_code_tables(
    spark: SparkSession,
    path: str,
    names: Sequence[str] = tuple(s.name for s in visits.CODE_TABLES),
) -> dict[str, DataFrame]:
    """The exported code tables by name. All columns are strings."""
    return {
        name: read_exported(
            spark, f"{path.rstrip('/')}/lookup={name}", schema="key string, value string"
        )
        for name in names
    }


def code_table_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Every code table has unique keys and none that is NULL."""
    return key_checks(tables, "key")
