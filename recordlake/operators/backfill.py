"""Which partitions of a derived lake no longer follow from its source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.functions.columns import col, cols, quoted

#: What a partition of the derived lake can be; the first needs nothing done.
STATES = ("complete", "missing", "short", "surplus", "stale", "orphaned")
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _comparable(df: DataFrame, name: str) -> Column:
    """A value that is the same in both lakes, also where one stores whole numbers as ints."""
    dtype = dict(df.dtypes)[name]
    return col(name).cast("double") if dtype in _NUMBERS else col(name).cast("string")


def partition_digests(df: DataFrame, partition_by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per partition ``records`` and a digest of its records' values, whatever their order.

    The digest is a sum of two 64-bit hashes of each record, so a record more, less, twice or
    changed tells. Sums combine before the shuffle: what travels is one row per partition and task.
    """
    values = [_comparable(df, c) for c in columns]
    nulls = [v.isNull() for v in values]
    hashes = [F.xxhash64(F.lit(seed), *values, *nulls) for seed in (0, 1)]
    # 22 bits at a time: sums of whole hashes could overflow, these only beyond 2^41 records.
    parts = [
        F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << 22) - 1).cast("bigint"))
        for h in hashes
        for shift in (0, 22, 44)
    ]
    return df.groupBy(*cols(partition_by)).agg(
        F.count("*").alias("records"),
        F.struct(*[F.sum(p).alias(f"sum_{i}") for i, p in enumerate(parts)]).alias("digest"),
    )


def backfill_plan(
    source: DataFrame,
    derived: DataFrame | None,
    partition_by: Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    """Every partition of a source lake or of a lake derived from it, and its state.

    Gives the partition columns, ``source_records``, ``derived_records`` (0 where there are none)
    and ``state``:

    * ``complete``: as many records on both sides, with the same ``columns``;
    * ``missing``: none in the derived lake; ``orphaned``: none in the source any more;
    * ``short``, ``surplus``: fewer or more records than the source has;
    * ``stale``: as many, but not the same, for instance after a correction of the source.

    ``columns`` are carried by both lakes unchanged: the record id at least; with more of them a
    changed value is found too. Each lake is scanned once, by these columns alone; the join is over
    one row per partition. ``derived`` is None where no lake was built yet.
    """
    before = partition_digests(source, partition_by, columns).alias("source")
    if derived is None:
        derived = source.limit(0)
    after = partition_digests(derived, partition_by, columns).alias("derived")
    same = [
        F.col(f"source.{quoted(n)}").eqNullSafe(F.col(f"derived.{quoted(n)}")) for n in partition_by
    ]
    n_source = F.coalesce("source.records", F.lit(0).cast("bigint"))
    n_derived = F.coalesce("derived.records", F.lit(0).cast("bigint"))
    state = (
        F.when(n_source == 0, "orphaned")
        .when(n_derived == 0, "missing")
        .when(n_derived < n_source, "short")
        .when(n_derived > n_source, "surplus")
        .when(F.col("source.digest") != F.col("derived.digest"), "stale")
        .otherwise("complete")
    )
    return before.join(after, same, "full_outer").select(
        *[F.coalesce(f"source.{quoted(n)}", f"derived.{quoted(n)}").alias(n) for n in partition_by],
        n_source.alias("source_records"),
        n_derived.alias("derived_records"),
        state.alias("state"),
    )


def to_rebuild(plan: DataFrame) -> DataFrame:
    """The partitions of a plan that have something to be done."""
    return plan.where(F.col("state") != "complete")
