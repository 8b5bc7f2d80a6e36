"""Build the raw lake from monthly files, and check it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from recordlake.operators.quality import lake_checks
from recordlake.plans import visits
from recordlake.sources.manifest import (
    column_counts,
    ingest_manifest,
    read_manifest,
    write_manifest,
)
from recordlake.sources.readers import expand_paths, read_files, read_lake
from recordlake.sources.writers import whole_partition_values, write_lake


def ingest_files(
    spark: SparkSession,
    paths: list[str],
    out: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "append",
    options: dict | None = None,
    schema=None,
    same_schema: bool = False,
    rebalance: bool = False,
    manifest: bool = False,
) -> None:
    """Write files of any installed format to one parquet lake, as one job.

    A monthly file holds one partition's rows, so its tasks write to one
    directory each and no shuffle is needed.

    ``manifest`` also keeps, within the lake and in the same mode, which columns and how many
    records of each partition every file had, by a second scan of the partition columns alone.
    """
    rows = read_files(spark, paths, fmt, options, schema, same_schema)
    rows = whole_partition_values(rows, partition_by)
    write_lake(rows, out, partition_by, mode, rebalance=rebalance)
    if manifest:
        told = ingest_manifest(spark, paths, fmt, partition_by, options, schema)
        write_manifest(told, out, partition_by, mode)


def monthly_paths(
    base: str, years: Sequence[str], months: Sequence[str], suffix: str = ".parquet"
) -> list[str]:
    """Paths of the monthly files, e.g. of years ``["16"]`` and months ``["jan"]``."""
    return expand_paths(
        visits.FILE_TEMPLATE, base=[base], yy=years, mmm=months, suffix=[suffix]
    )


def build_raw_lake(
    spark: SparkSession,
    base: str,
    out: str,
    years: Sequence[str],
    months: Sequence[str] = visits.MONTH_NAMES,
    suffix: str = ".parquet",
    fmt: str = "parquet",
    mode: str = "replace_partitions",
    options: dict | None = None,
    schema=None,
    same_schema: bool = False,
) -> DataFrame:
    """Ingest the monthly files into a lake by year and month; return its checks.

    By default the months that the files hold are replaced and all others stay, so
    one month can be built again. ``mode="overwrite"`` clears the whole lake first.
    Formats without types need a ``schema`` (see :func:`visits.raw_schema`).

    The columns that the checks count per month are those of the month's own files, out of the
    manifest that is written with the lake: a file that lacks one fails its month alone.
    """
    paths = monthly_paths(base, years, months, suffix)
    ingest_files(
        spark, paths, out, fmt, visits.PARTITION_BY, mode, options,
        schema=schema, same_schema=same_schema, manifest=True,
    )
    expected = [
        {"i94yr": 2000 + int(yy), "i94mon": visits.MONTH_NAMES.index(mmm) + 1}
        for yy in years
        for mmm in months
    ]
    return raw_lake_checks(read_lake(spark, out), expected, read_manifest(spark, out))


def raw_lake_checks(
    lake: DataFrame, expected: list[dict] | None = None, manifest: DataFrame | None = None
) -> DataFrame:
    """28 columns, no empty month, and ids unique within each month.

    With a manifest the columns are those of each month's files, else those of the lake.
    """
    counts = None
    if manifest is not None:
        counts = column_counts(manifest, visits.PARTITION_BY, visits.RAW_COLUMN_COUNT)
    return lake_checks(
        lake, visits.PARTITION_BY, visits.RECORD_ID, visits.RAW_COLUMN_COUNT, expected, counts
    )
