"""The ingest manifest: what each input file of a lake brought."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.functions.columns import col, cols
from recordlake.sources.layouts import file_layouts, read_layout, united
from recordlake.sources.writers import whole_partition_values, write_lake

#: Readers of a lake pass folders over whose names begin with an underscore.
MANIFEST_FOLDER = "_manifest"


def manifest_path(lake: str) -> str:
    return f"{lake.rstrip('/')}/{MANIFEST_FOLDER}"


def ingest_manifest(
    spark: SparkSession,
    paths: Sequence[str],
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    options: dict | None = None,
    schema=None,
) -> DataFrame:
    """``file, columns, n_columns, records`` by partition, of every input file with records.

    ``columns`` are the file's own, in its order, whatever the other files have. Only the
    partition columns are read, in one job: files of one layout are one scan, which knows its
    columns, so no list of files meets the records. A file without a partition column has NULL
    there.
    """
    parts = []
    for layout in file_layouts(spark, paths, fmt, options):
        frame = read_layout(spark, layout, fmt, options, schema)
        held = [c for c in partition_by if c in frame.columns]
        parts.append(
            frame.select(
                F.col("_metadata.file_path").alias("file"),
                F.array(*map(F.lit, layout.columns)).alias("columns"),
                *cols(held),
            )
        )
    if not parts:
        raise ValueError("no input file")
    rows = united(parts)
    rows = rows.withColumns({c: F.lit(None).cast("int") for c in partition_by if c not in rows.columns})
    counted = rows.groupBy("file", "columns", *cols(partition_by)).agg(F.count("*").alias("records"))
    return whole_partition_values(counted, partition_by).select(
        "file", "columns", F.size("columns").alias("n_columns"), "records", *cols(partition_by)
    )


def write_manifest(
    manifest: DataFrame, lake: str, partition_by: Sequence[str] = (), mode: str = "append"
) -> None:
    """Keep a manifest within its lake, by the same partitions and with the same write mode."""
    write_lake(manifest, manifest_path(lake), partition_by, mode)


def read_manifest(spark: SparkSession, lake: str) -> DataFrame:
    return spark.read.parquet(manifest_path(lake))


def column_counts(manifest: DataFrame, partition_by: Sequence[str], expected: int) -> DataFrame:
    """Per partition ``n_columns``: that of a file with another count than expected, if there is one.

    Of several such counts it is the least below the expected one, else the greatest.
    """
    found = manifest.groupBy(*cols(partition_by)).agg(
        F.min("n_columns").alias("least"), F.max("n_columns").alias("most")
    )
    odd = F.when(F.col("least") < expected, F.col("least")).otherwise(F.col("most"))
    return found.select(*cols(partition_by), odd.alias("n_columns"))


def missing_columns(manifest: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Files that lack expected columns or have others: ``file, missing, unexpected``."""
    listed = F.array(*map(F.lit, expected))
    found = manifest.select(
        "file",
        F.array_except(listed, col("columns")).alias("missing"),
        F.array_except(col("columns"), listed).alias("unexpected"),
    ).distinct()
    return found.where((F.size("missing") > 0) | (F.size("unexpected") > 0))
