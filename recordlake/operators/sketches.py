"""Distinct counts from stored sketches: a year's count merges its months without a scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.functions.columns import col, cols
from recordlake.sources.writers import write_lake

#: A sketch has 2**LG_K registers of a byte at most.
LG_K = 14
#: Standard errors that the bounds of an estimate span on either side.
SIGMAS = 3


def relative_error(lg_k: int = LG_K) -> float:
    """The relative standard error of merged sketches."""
    return 1.04 / 2 ** (lg_k / 2)


def distinct_sketches(
    df: DataFrame, partition_by: Sequence[str], columns: Sequence[str], lg_k: int = LG_K
) -> DataFrame:
    """``column_name, records, nulls, sketch`` per partition and column, in one scan.

    A sketch is at most 2**lg_k bytes, whatever the partition holds, and combines per task before
    the shuffle. Values of any type enter as 64-bit hashes; NULLs are counted apart.
    """
    figures = []
    for i, name in enumerate(columns):
        value = F.when(col(name).isNotNull(), F.xxhash64(col(name)))
        figures += [
            F.hll_sketch_agg(value, F.lit(lg_k)).alias(f"sketch_{i}"),
            F.count_if(col(name).isNull()).alias(f"nulls_{i}"),
        ]
    found = df.groupBy(*cols(partition_by)).agg(F.count("*").alias("records"), *figures)
    listed = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.col("records"),
                F.col(f"nulls_{i}").alias("nulls"),
                F.col(f"sketch_{i}").alias("sketch"),
            )
            for i, name in enumerate(columns)
        ]
    )
    return found.select(*cols(partition_by), F.inline(listed))


def store_sketches(
    sketches: DataFrame, path: str, partition_by: Sequence[str], mode: str = "replace_partitions"
) -> None:
    """Keep sketches by partition; those of partitions counted again take the place of the old."""
    write_lake(sketches, path, partition_by, mode)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merged_distinct_counts(sketches: DataFrame, by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """Estimated distinct values per column and group of partitions, NULL being one value.

    Gives ``column_name, records, estimate, at_least, at_most``. The bounds are three standard
    errors of the sketch away (2.4 % with the default size), and never beyond the records; nothing
    but sketches is read. For an exact count see :func:`distinct_count`.
    """
    merged = sketches.groupBy(*cols(by), "column_name").agg(
        F.sum("records").alias("records"),
        F.max((F.col("nulls") > 0).cast("bigint")).alias("null_value"),
        F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(False))).alias("found"),
    )
    share = SIGMAS * relative_error(lg_k)
    present = F.col("records") - F.col("nulls")
    return merged.select(
        *cols(by),
        "column_name",
        "records",
        (F.least("found", present) + F.col("null_value")).alias("estimate"),
        (F.floor(F.least("found", present) * (1 - share)) + F.col("null_value")).alias("at_least"),
        (F.least(F.ceil(F.col("found") * (1 + share)), present) + F.col("null_value")).alias("at_most"),
    )


def surely_repeated(counts: DataFrame) -> DataFrame:
    """Merged counts of columns that cannot be unique: fewer values at most than records."""
    return counts.where(F.col("at_most") < F.col("records"))
