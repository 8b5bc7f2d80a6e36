"""Data-quality checks.

Each check returns rows ``check, subject, observed, expected, passed`` instead
of raising, so results can be shown, stored or turned into a failure by the
caller (:func:`failed_checks`, :func:`require_all_passed`).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordlake.functions.columns import col, cols, literal_rows, quoted

CHECK_COLUMNS = ("check", "subject", "observed", "expected", "passed")


def _check(name: str, subject: Column, observed: Column, expected: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        subject.alias("subject"),
        observed.cast("bigint").alias("observed"),
        expected.cast("bigint").alias("expected"),
        F.coalesce(observed == expected, F.lit(False)).alias("passed"),
    )


def _rows(df: DataFrame, *checks: Column) -> DataFrame:
    return df.select(F.inline(F.array(*checks)))


def partition_name(names: Sequence[str]) -> Column:
    """Text such as ``y=2016/m=4`` from partition columns."""
    parts = [
        F.concat(F.lit(f"{n}="), F.coalesce(col(n).cast("string"), F.lit("null")))
        for n in names
    ]
    return F.concat_ws("/", *parts)


def distinct_with_null(column: Column) -> Column:
    """Aggregate: number of distinct values, NULL being one of them."""
    has_null = F.coalesce(F.bool_or(column.isNull()), F.lit(False))
    return F.count_distinct(column) + has_null.cast("int")


def lake_checks(
    df: DataFrame,
    partition_by: Sequence[str],
    unique_column: str,
    expected_columns: int,
    expected_partitions: list[dict] | None = None,
    column_counts: DataFrame | None = None,
) -> DataFrame:
    """Per partition: column count, not empty, and a column unique within it.

    One job for all partitions. The distinct count shuffles by partition and
    value, so a large partition is spread over the tasks. A partition listed in
    ``expected_partitions`` that has no rows fails, and so does one that has rows but
    is not listed; without the list, the partitions found are checked.

    ``column_counts`` gives the columns that the input files of each partition had (see
    :func:`recordlake.sources.column_counts`), a row per partition, which is broadcast: they
    are counted in place of the frame's, and a partition with records but without a row fails. The frame itself
    has the same columns for all partitions, whatever the files held.
    """
    stats = df.groupBy(*cols(partition_by)).agg(
        F.count("*").alias("n_rows"),
        distinct_with_null(col(unique_column)).alias("n_values"),
    )
    if expected_partitions is not None:
        types = dict(df.dtypes)
        wanted = literal_rows(
            df.sparkSession,
            [
                {n: F.lit(p[n]).cast(types[n]) for n in partition_by}
                for p in expected_partitions
            ],
        )
        # Null-safe, and unlisted partitions stay: they have no place in the lake.
        wanted = wanted.withColumn("listed", F.lit(True)).alias("wanted")
        found = stats.alias("found")
        same = [
            F.col(f"wanted.{quoted(n)}").eqNullSafe(F.col(f"found.{quoted(n)}")) for n in partition_by
        ]
        stats = wanted.join(found, same, "full_outer").select(
            *[F.coalesce(f"wanted.{quoted(n)}", f"found.{quoted(n)}").alias(n) for n in partition_by],
            *[F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in ("n_rows", "n_values")],
            F.coalesce("listed", F.lit(False)).alias("listed"),
        )
    n_columns = F.lit(len(df.columns))
    if column_counts is not None:
        told = F.broadcast(column_counts).alias("told")
        same = [
            F.col(f"told.{quoted(n)}").eqNullSafe(F.col(f"stats.{quoted(n)}")) for n in partition_by
        ]
        stats = stats.alias("stats").join(told, same, "left").select("stats.*", "told.n_columns")
        nothing_read = F.when(F.col("n_rows") == 0, n_columns)
        n_columns = F.coalesce(F.col("n_columns"), nothing_read)
    subject = partition_name(partition_by)
    n_rows = F.col("n_rows")
    wanted_rows = F.greatest(n_rows, F.lit(1))
    if expected_partitions is not None:
        wanted_rows = F.when(F.col("listed"), wanted_rows).otherwise(F.lit(0).cast("bigint"))
    return _rows(
        stats,
        _check("column_count", subject, n_columns, F.lit(expected_columns)),
        _check("not_empty", subject, n_rows, wanted_rows),
        _check(f"unique_{unique_column}", subject, F.col("n_values"), n_rows),
    )


def unique_in_partition(
    df: DataFrame, partition_by: Sequence[str], column: str
) -> DataFrame:
    """Per partition: number of distinct values against number of rows."""
    stats = df.groupBy(*cols(partition_by)).agg(
        F.count("*").alias("n_rows"), distinct_with_null(col(column)).alias("n_values")
    )
    return _rows(
        stats,
        _check(
            f"unique_{column}",
            partition_name(partition_by),
            F.col("n_values"),
            F.col("n_rows"),
        ),
    )


def join_preserves_rows(
    before: DataFrame, after: DataFrame, partition_by: Sequence[str]
) -> DataFrame:
    """Per partition: rows after an enrichment against rows before it."""
    sides = before.select(*cols(partition_by), F.lit(0).alias("side")).unionAll(
        after.select(*cols(partition_by), F.lit(1).alias("side"))
    )
    stats = sides.groupBy(*cols(partition_by)).agg(
        F.count_if(F.col("side") == 0).alias("n_before"),
        F.count_if(F.col("side") == 1).alias("n_after"),
    )
    return _rows(
        stats,
        _check(
            "rows_preserved",
            partition_name(partition_by),
            F.col("n_after"),
            F.col("n_before"),
        ),
    )


def key_checks(tables: dict[str, DataFrame], column: str | Column = "key") -> DataFrame:
    """Per table: a key column is unique and has no NULL. One job for all tables."""
    key = col(column) if isinstance(column, str) else column
    keys = [
        df.select(F.lit(name).alias("name"), key.cast("string").alias("k"))
        for name, df in tables.items()
    ]
    stats = (
        reduce(DataFrame.unionAll, keys)
        .groupBy("name")
        .agg(
            F.count("*").alias("n_rows"),
            distinct_with_null(F.col("k")).alias("n_values"),
            F.count_if(F.col("k").isNull()).alias("n_null"),
        )
    )
    return _rows(
        stats,
        _check("unique", F.col("name"), F.col("n_values"), F.col("n_rows")),
        _check("non_null", F.col("name"), F.col("n_null"), F.lit(0)),
    )


def same_table_checks(before: DataFrame, after: DataFrame, name: str) -> DataFrame:
    """Two frames have the same columns as a set, in the same order, and as many rows.

    For a round trip or a copy. The column checks need no scan.
    """
    sides = before.select(F.lit(0).alias("side")).unionAll(
        after.select(F.lit(1).alias("side"))
    )
    stats = sides.agg(
        F.count_if(F.col("side") == 0).alias("n_before"),
        F.count_if(F.col("side") == 1).alias("n_after"),
    )
    shared = len(set(before.columns) & set(after.columns))
    union = len(set(before.columns) | set(after.columns))
    in_place = sum(a == b for a, b in zip(before.columns, after.columns))
    width = max(len(before.columns), len(after.columns))
    subject = F.lit(name)
    return _rows(
        stats,
        _check("same_column_set", subject, F.lit(shared), F.lit(union)),
        _check("same_column_order", subject, F.lit(in_place), F.lit(width)),
        _check(
            "same_column_count", subject, F.lit(len(after.columns)), F.lit(len(before.columns))
        ),
        _check("same_row_count", subject, F.col("n_after"), F.col("n_before")),
    )


def date_agreement(
    df: DataFrame, year: str, month: str, date: str
) -> DataFrame:
    """Rows whose year and month columns disagree with a date; none are expected.

    A NULL date disagrees.
    """
    agrees = F.year(col(date)).eqNullSafe(col(year)) & F.month(col(date)).eqNullSafe(
        col(month)
    )
    stats = df.agg(F.count_if(~agrees).alias("n_off"))
    return _rows(
        stats, _check("date_agreement", F.lit(date), F.col("n_off"), F.lit(0))
    )


def sequence_completeness(
    df: DataFrame, partition_by: Sequence[str], column: str, ordered: bool = True
) -> DataFrame:
    """Per partition: do the ids start at 1 and end at the row count?"""
    stats = df.groupBy(*cols(partition_by)).agg(
        F.min(col(column)).alias("min_id"),
        F.max(col(column)).alias("max_id"),
        F.count("*").alias("records"),
    )
    result = stats.withColumns(
        {
            "starts_at_one": F.col("min_id") == 1,
            "ends_at_count": F.col("max_id") == F.col("records"),
        }
    )
    return result.orderBy(*cols(partition_by)) if ordered else result


def failed_checks(checks: DataFrame) -> DataFrame:
    return checks.where(~F.col("passed"))


def require_all_passed(checks: DataFrame, shown: int = 20) -> None:
    """Raise ``ValueError`` if any check failed, naming the first few."""
    failures = failed_checks(checks).limit(shown).collect()
    if failures:
        told = "; ".join(
            f"{r['check']} {r['subject']}: {r['observed']}, expected {r['expected']}"
            for r in failures
        )
        raise ValueError(f"data-quality checks failed: {told}")


def append_check_results(
    checks: DataFrame, path: str, run_id: str, run_time: Column | None = None
) -> None:
    """Append check rows to a history table, marked with the run they belong to."""
    when = F.current_timestamp() if run_time is None else run_time
    checks.select(
        F.lit(run_id).alias("run_id"), when.alias("run_time"), *CHECK_COLUMNS
    ).write.mode("append").parquet(path)


def read_check_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def compare_check_runs(history: DataFrame) -> DataFrame:
    """Each check result beside that of the last earlier run of the same check and subject.

    Adds ``previous_run``, ``previous_observed``, ``change`` (of the observed value), ``status``
    and ``failing_since``. ``status`` is ``passed``, ``failed`` (for the first time known), ``fails
    again``, ``recovered`` or ``still failing``; ``failing_since`` is the time of the first of
    the failures that reach up to this one without a passed run in between.

    Runs are ordered by ``run_time`` and not by their place in the history, so a run that is
    appended late stands where it belongs; of runs at one time the ``run_id`` decides. A result
    that was appended twice counts once. The window of a check and subject has a row per run.
    """
    runs = history.select("run_id", "run_time", *CHECK_COLUMNS).distinct()
    order = Window.partitionBy("check", "subject").orderBy("run_time", "run_id")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    failed = ~F.col("passed")
    placed = runs.withColumns(
        {
            "previous_run": F.lag("run_id").over(order),
            "previous_observed": F.lag("observed").over(order),
            "previous_passed": F.lag("passed").over(order),
            "failed_before": F.coalesce(F.bool_or(failed).over(earlier), F.lit(False)),
            "passes": F.count_if(F.col("passed")).over(so_far),
        }
    )
    streak = Window.partitionBy("check", "subject", "passes")
    first = F.min(F.when(failed, F.col("run_time"))).over(streak)
    before_failed = F.coalesce(~F.col("previous_passed"), F.lit(False))
    status = (
        F.when(F.col("passed"), F.when(before_failed, "recovered").otherwise("passed"))
        .when(before_failed, "still failing")
        .when(F.col("failed_before"), "fails again")
        .otherwise("failed")
    )
    return placed.select(
        "run_id", "run_time", *CHECK_COLUMNS, "previous_run", "previous_observed",
        (F.col("observed") - F.col("previous_observed")).alias("change"),
        status.alias("status"),
        F.when(failed, first).alias("failing_since"),
    )


def new_failures(history: DataFrame) -> DataFrame:
    """The results with which a check began to fail, first or again."""
    return compare_check_runs(history).where(F.col("status").isin("failed", "fails again"))
