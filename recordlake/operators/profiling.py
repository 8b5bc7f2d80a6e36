"""Column profiles: value frequencies of many columns, and table overviews."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.columns import col
from recordlake.operators.counts import value_counts
from recordlake.scratch import scratch_path

# What a value is ordered and counted as, by its type; all columns share these four members.
_MEMBERS = {"whole": "bigint", "real": "double", "exact": "decimal(38,18)", "text": "string"}
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.DateType, T.TimestampType)

PROFILE_COLUMNS = ("column_name", "position", "value", "records")


def _member(dtype: T.DataType) -> str | None:
    if isinstance(dtype, _WHOLE):
        return "whole"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return "real"
    if isinstance(dtype, T.DecimalType):
        return "exact" if dtype.scale <= 18 and dtype.precision - dtype.scale <= 20 else None
    return "text" if isinstance(dtype, T.StringType) else None


def _as_member(value: Column, dtype: T.DataType) -> Column:
    """The value in its member's type, in the same order."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(value)
    return value.cast("int").cast("bigint") if isinstance(dtype, T.BooleanType) else value.cast(_MEMBERS[_member(dtype)])


def _as_text(dtype: T.DataType) -> Column:
    """The text of a value out of its member, as a cast of the value itself gives it."""
    member = F.col(_member(dtype))
    if isinstance(dtype, T.DateType):
        return F.date_from_unix_date(member.cast("int")).cast("string")
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(member).cast("string")
    return member.cast(dtype).cast("string")


def profile_value_counts(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    n: int | None = None,
    near_unique: Sequence[str] | None = None,
    sample_fraction: float = 0.01,
) -> DataFrame:
    """Values of each column, in ascending order, with their row counts: all, or the first ``n``.

    One long frame: ``column_name, position, value, records``. Values are given
    as text but ordered as what they are (9 before 10), NULL first. ``n`` counts
    values, it does not pick the most frequent ones.

    All columns are counted in one scan, whatever they hold; only those of rare types (binary, for
    instance) get one each. With ``n``, a sample bounds each column first: if ``n`` different
    values of the sample lie at or below a value, the first ``n`` of the column do as well, and
    larger ones never leave the scan. So of a near-unique column (an id) only a small share is
    shuffled, and the result is exact for any sample. ``near_unique`` names the columns to be
    bounded, all by default. Positions of all values are counted by ranges of values, without
    a column passing through one task; they are bigints then.
    """
    columns = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    together = [c for c in columns if _member(types[c])]
    bounds = {}
    if n is not None:
        asked = [c for c in together if near_unique is None or c in near_unique]
        bounds = _sampled_bounds(df, asked, n, sample_fraction) if asked else {}
    profiles = [_joint_profile(df, together, n, bounds)] if together else []
    profiles += [_single_profile(df, c, n, None) for c in columns if c not in together]
    return reduce(DataFrame.unionAll, profiles)


def _entries(df: DataFrame, columns: Sequence[str], bounds: dict[str, Column]) -> DataFrame:
    """A row ``slot, whole, real, exact, text`` per value of each column, up to the column's bound."""
    types = {f.name: f.dataType for f in df.schema.fields}
    used = [m for m in _MEMBERS if any(_member(types[c]) == m for c in columns)]
    listed = []
    for slot, name in enumerate(columns):
        value = _as_member(col(name), types[name])
        members = [
            (value if m == _member(types[name]) else F.lit(None)).cast(_MEMBERS[m]).alias(m) for m in used
        ]
        entry = F.struct(F.lit(slot).alias("slot"), *members)
        if name in bounds:
            entry = F.when(value.isNull() | (value <= bounds[name]), entry)
        listed.append(entry)
    entries = F.array(*listed)
    return df.select(F.inline(F.array_compact(entries) if bounds else entries))


def _order(entries: DataFrame) -> list[Column]:
    """The order of a column's values: one member at most is not NULL."""
    return [F.asc_nulls_first(m) for m in _MEMBERS if m in entries.columns]


def _sampled_bounds(df: DataFrame, columns: Sequence[str], n: int, fraction: float) -> dict[str, Column]:
    """For columns with ``n`` different values in a sample: the last of the sample's first ``n``."""
    entries = _entries(df.sample(fraction, seed=1), columns, {})
    members = [m for m in _MEMBERS if m in entries.columns]
    values = entries.where(reduce(Column.__or__, [F.col(m).isNotNull() for m in members]))
    place = F.row_number().over(Window.partitionBy("slot").orderBy(*_order(entries)))
    last = values.distinct().withColumn("place", place).where(F.col("place") == n)
    types = {f.name: f.dataType for f in df.schema.fields}
    bounds = {}
    # One row per column at most.
    for row in last.collect():
        name = columns[row["slot"]]
        member = _member(types[name])
        bounds[name] = F.lit(row[member]).cast(_MEMBERS[member])
    return bounds


def _joint_profile(df: DataFrame, columns: Sequence[str], n: int | None, bounds: dict[str, Column]) -> DataFrame:
    entries = _entries(df, columns, bounds)
    counts = entries.groupBy(*entries.columns).agg(F.count("*").alias("records"))
    order = _order(entries)
    if n is None:
        numbered = _numbered_by_ranges(counts, order)
    else:
        # The limit is applied per task before the shuffle by column, so one task never gets
        # more than n rows per column and upstream task.
        place = F.row_number().over(Window.partitionBy("slot").orderBy(*order))
        numbered = counts.withColumn("position", place).where(F.col("position") <= n)
    types = {f.name: f.dataType for f in df.schema.fields}
    texts: dict[T.DataType, list[int]] = {}
    for slot, name in enumerate(columns):
        texts.setdefault(types[name], []).append(slot)
    value = F.coalesce(*[F.when(F.col("slot").isin(slots), _as_text(t)) for t, slots in texts.items()])
    names = F.element_at(F.array(*map(F.lit, columns)), F.col("slot") + 1)
    return numbered.select(names.alias("column_name"), "position", value.alias("value"), "records")


def _numbered_by_ranges(counts: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``position`` within each slot: sorted ranges are numbered by themselves and then moved on.

    The counts are stored by ranges of values; what the ranges hold of each column, one small
    row per range and column, is summed up and broadcast.
    """
    spark, path = counts.sparkSession, scratch_path(counts.sparkSession, "ranges")
    ranges = counts.repartitionByRange("slot", *order).withColumn("part", F.spark_partition_id())
    ranges.write.parquet(path)
    ranges = spark.read.schema(ranges.schema).parquet(path)
    earlier = Window.partitionBy("slot").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = ranges.groupBy("slot", "part").agg(F.count("*").alias("held"))
    before = before.select("slot", "part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("slot", "part").orderBy(*order))
    numbered = ranges.withColumn("place", place).join(F.broadcast(before), ["slot", "part"])
    return numbered.withColumn("position", F.col("place") + F.col("before"))


def _single_profile(
    df: DataFrame, column: str, n: int | None, sample_fraction: float | None
) -> DataFrame:
    value = col(column).cast("string").alias("value")
    if n is None:
        counts = value_counts(df, column, ordered=False).withColumn("slot", F.lit(0))
        numbered = _numbered_by_ranges(counts, [col(column).asc_nulls_first()])
    else:
        first = first_value_counts(df, column, n, sample_fraction)
        # At most n rows are numbered here.
        numbered = first.withColumn(
            "position", F.row_number().over(Window.orderBy(col(column)))
        )
    return numbered.select(F.lit(column).alias("column_name"), "position", value, "records")


def first_value_counts(
    df: DataFrame, column: str, n: int, sample_fraction: float | None = None
) -> DataFrame:
    """Value counts of the first ``n`` values of a column, in value order.

    With ``sample_fraction`` a sample of the column sets an upper bound first:
    if ``n`` distinct values of the sample lie at or below it, then the first
    ``n`` values of the column do as well. Rows above the bound cannot matter and
    are dropped before the aggregation, which for a near-unique column saves
    shuffling nearly all rows. The result is exact whatever the sample holds;
    a sample with fewer than ``n`` values sets no bound.
    """
    rows = df.select(col(column))
    if sample_fraction is not None:
        lowest = (
            rows.where(col(column).isNotNull())
            .sample(sample_fraction, seed=1)
            .distinct()
            .orderBy(col(column))
            .limit(n)
        )
        bound = lowest.agg(
            F.when(F.count("*") >= n, F.max(col(column))).alias("bound")
        ).scalar()
        rows = rows.where(F.coalesce(col(column) <= bound, F.lit(True)))
    return value_counts(rows, column).limit(n)


def near_unique_columns(
    df: DataFrame, columns: Sequence[str] | None = None, min_values: int = 1_000_000
) -> DataFrame:
    """Approximate distinct values of each column and whether it has very many.

    One scan that shuffles one small sketch per column and task.
    """
    columns = list(columns or df.columns)
    sketches = df.agg(
        *[F.approx_count_distinct(col(c)).alias(f"d{i}") for i, c in enumerate(columns)]
    )
    return sketches.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col(f"d{i}").alias("approx_values"),
                        (F.col(f"d{i}") >= min_values).alias("near_unique"),
                    )
                    for i, c in enumerate(columns)
                ]
            )
        )
    )


def table_overview(df: DataFrame, name: str = "table") -> DataFrame:
    """One row per column: table, position, column, type, nullable, row and column count."""
    described = F.array(
        *[
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(f.nullable).alias("nullable"),
                F.col("n_rows"),
                F.lit(len(df.columns)).alias("n_columns"),
            )
            for i, f in enumerate(df.schema.fields, start=1)
        ]
    )
    return df.agg(F.count("*").alias("n_rows")).select(F.inline(described))


def table_preview(df: DataFrame, n: int = 5) -> DataFrame:
    """``n`` rows as they come; fewer if the table has fewer."""
    return df.limit(n)
