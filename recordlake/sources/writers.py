"""Sinks: partitioned lakes, partition replacement and headered CSV."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.functions.columns import col, cols, partition_condition
from recordlake.sources.readers import CSV_LAYOUT, read_lake

WRITE_MODES = ("errorifexists", "append", "overwrite", "replace_partitions")
_PLAIN_VALUE = re.compile(r"[\w.\-]+")
# Partitions whose files a task keeps open together; rows of further ones are sorted first.
_OPEN_PARTITIONS = 32
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def whole_partition_values(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Turn double partition columns into ints: directories ``y=2016``, not ``y=2016.0``.

    A value with a fraction, or beyond the ints, fails the job: cut, its rows would land
    in another partition.
    """
    doubles = {name for name, dtype in df.dtypes if dtype in ("double", "float")}
    return df.withColumns({n: _whole(n) for n in partition_by if n in doubles})


def _whole(name: str) -> Column:
    value, whole = col(name), col(name).try_cast("int")
    unfit = value.isNotNull() & (whole.isNull() | (whole.cast("double") != value))
    message = F.concat(F.lit(f"{name} is no whole number: "), value.cast("string"))
    return F.when(unfit, F.raise_error(message)).otherwise(whole)


def write_lake(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
    rebalance: bool = False,
    max_records_per_file: int | None = None,
) -> None:
    """Write a parquet lake, one directory level per partition column.

    ``mode`` is ``errorifexists`` (the safe one), ``append``, ``overwrite`` (the
    whole target) or ``replace_partitions`` (only the partitions that occur in
    ``df``; a rerun gives the same lake). An ``overwrite`` clears the target
    before it writes, so a job that fails leaves it empty until it is run again.

    Rows are written where they are read, without a shuffle. ``rebalance`` is
    for input that is not laid out by partition already: it gathers the rows of
    a partition into few files, and adaptive execution splits the partitions
    that are too big for one task.

    A task keeps the files of a few partitions open instead of sorting its rows by
    partition, so it does not hold its input in memory. A session that sets
    ``spark.sql.maxConcurrentOutputFileWriters`` decides how many.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}, not {mode!r}")
    if mode == "replace_partitions" and not partition_by:
        raise ValueError("replace_partitions needs partition columns")
    if rebalance and partition_by:
        df = df.hint("rebalance", *cols(partition_by))
    writer = df.write
    if mode == "replace_partitions":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "overwrite":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "static")
    else:
        writer = writer.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    with _unsorted_writes(df.sparkSession):
        writer.parquet(path)


@contextmanager
def _unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Within it partitioned writes keep files open; Spark has no such option for one write."""
    if int(spark.conf.get(_OPEN_FILES, "0")):
        yield
        return
    spark.conf.set(_OPEN_FILES, _OPEN_PARTITIONS)
    try:
        yield
    finally:
        spark.conf.unset(_OPEN_FILES)


def _first_files(spark: SparkSession, path: str, partitions: list[dict]) -> dict[tuple, str]:
    """A file of each listed partition that holds rows: one entry per partition at most.

    No data column is read. Values are text, as in the directory names.
    """
    try:
        lake = read_lake(spark, path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return {}
    names = list(partitions[0])
    files = lake.select(*cols(names), F.col("_metadata.file_path").alias("_recordlake_file"))
    found = (
        files.where(partition_condition(partitions))
        .groupBy(*cols(names))
        .agg(F.min("_recordlake_file"))
        .collect()
    )
    return {tuple(map(str, row[:-1])): row[-1] for row in found}


def _partition_path(path: str, partition: dict) -> str:
    for value in partition.values():
        if not _PLAIN_VALUE.fullmatch(str(value)):
            raise ValueError(f"partition value {value!r} has no plain directory name")
    return "/".join([path.rstrip("/"), *(f"{k}={v}" for k, v in partition.items())])


def replace_partitions(
    df: DataFrame, path: str, partitions: list[dict], rebalance: bool = False
) -> None:
    """Make the listed partitions of a lake hold exactly the rows ``df`` has for them.

    Other partitions stay as they are and a rerun changes nothing. A dynamic
    overwrite leaves a partition alone that gets no new rows, so partitions that
    became empty are emptied afterwards: they are those that still have a file from
    before. ``df`` is evaluated once, by the write. If a job fails in between, such
    partitions keep their old rows until the call is repeated, which is all it takes.
    """
    spark = df.sparkSession
    names = list(partitions[0])
    new = df.where(partition_condition(partitions))
    before = _first_files(spark, path, partitions)
    write_lake(new, path, names, "replace_partitions", rebalance=rebalance)
    after = _first_files(spark, path, partitions) if before else {}
    stale = {p for p, file in before.items() if after.get(p) == file}
    no_rows = new.limit(0).drop(*names)
    for partition in partitions:
        if tuple(str(v) for v in partition.values()) in stale:
            no_rows.write.mode("overwrite").parquet(_partition_path(path, partition))


def write_value_counts_csv(
    counts: DataFrame,
    column: str,
    path: str,
    n: int | None = None,
    count_name: str = "count",
    mode: str = "errorifexists",
) -> None:
    """Write a value count as headered CSV, in the order of the values.

    The header is ``<column>,<count_name>``. With ``n`` the first ``n`` rows go to one
    file, else all rows to as many files as they need. :func:`read_exported` gives back
    every value as it was.
    """
    ordered = counts.orderBy(col(column).asc_nulls_first())
    if n is not None:
        ordered = ordered.limit(n).coalesce(1)
    rows = ordered.select(col(column), F.col("records").alias(count_name))
    rows.write.mode(mode).csv(path, **CSV_LAYOUT)


def write_csv_tables(
    tables: DataFrame, path: str, table_column: str, mode: str = "errorifexists"
) -> None:
    """Write one folder of headered CSV per value of ``table_column``.

    :func:`read_exported` gives back every value as it was.
    """
    tables.write.mode(mode).partitionBy(table_column).csv(path, **CSV_LAYOUT)


def roundtrip(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a new path as parquet and read it back."""
    write_lake(df, path)
    return read_lake(spark, path)
