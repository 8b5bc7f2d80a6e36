"""Anomalies: values far from the middle of their group, measured by the group's own spread."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.functions.columns import col, cols, quoted

#: A normal distribution's standard deviation over its median and its mean deviation.
MEDIAN_SCALE, MEAN_SCALE = 1.4826, 1.2533
#: Values further from the median than so many deviations are labelled.
LIMIT = 3.5
ACCURACY = 10_000


def _judged(column: Column) -> Column:
    """The value as a double, NULL where there is nothing to judge."""
    value = column.cast("double")
    return F.when(~F.isnan(value), value)


def _median(value: Column, accuracy: int, exact: bool) -> Column:
    return F.percentile(value, 0.5) if exact else F.percentile_approx(value, 0.5, accuracy)


def group_quantiles(
    df: DataFrame,
    column: str,
    by: Sequence[str] = (),
    probabilities: Sequence[float] = (0.25, 0.5, 0.75),
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Rows ``probability, quantile`` per group, with the group's number of values, by sketches.

    A quantile is a value of the group whose rank is off by ``records / accuracy`` at most. Sketches
    combine before the shuffle, so a group of any size is one small row per task. NULL and NaN do
    not count; a group without other values has no rows.
    """
    value = _judged(col(column))
    sketched = df.groupBy(*cols(by)).agg(
        F.count(value).alias("records"),
        F.percentile_approx(value, list(probabilities), accuracy).alias("found"),
    )
    asked = F.array(*map(F.lit, probabilities))
    pairs = F.arrays_zip(asked.alias("probability"), F.col("found").alias("quantile"))
    return sketched.where("records > 0").select(*cols(by), "records", F.inline(pairs).alias("probability", "quantile"))


def rank_errors(df: DataFrame, quantiles: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """How far the ranks of quantiles are off: ``quantiles`` with ``rank_error``, in records.

    The exact check of :func:`group_quantiles`, by one more scan. A value that occurs several times
    has all the ranks that it takes up; the error is the distance to the nearest of them.
    """
    asked = F.collect_list(F.struct("records", "probability", "quantile")).alias("asked")
    values = df.select(*cols(by), _judged(col(column)).alias("value")).where("value is not null")
    joined = _beside(values, quantiles.groupBy(*cols(by)).agg(asked), by)
    each = joined.select(*cols(by), "value", F.inline("asked"))
    counted = each.groupBy(*cols(by), "records", "probability", "quantile").agg(
        F.count_if(F.col("value") < F.col("quantile")).alias("below"),
        F.count_if(F.col("value") <= F.col("quantile")).alias("reached"),
    )
    wanted = F.col("probability") * F.col("records")
    error = F.greatest(F.lit(0.0), F.col("below") + 1 - wanted, wanted - F.col("reached"))
    return counted.select(*cols(by), "records", "probability", "quantile", error.alias("rank_error"))


def robust_spread(
    df: DataFrame, column: str, by: Sequence[str] = (), accuracy: int = ACCURACY, exact: bool = False
) -> DataFrame:
    """Per group ``records``, ``median`` and ``spread``, which a few wild values do not move.

    The spread is the median deviation from the median, or, where more than half of the values are
    equal, the mean deviation; both are scaled to a normal distribution's standard deviation.
    Medians are sketched (see :func:`group_quantiles`); ``exact`` counts all different values of a
    group in one place and is for columns that have few.
    """
    value = _judged(col(column))
    rows = df.select(*cols(by), value.alias("value")).where("value is not null")
    middle = rows.groupBy(*cols(by)).agg(
        F.count("*").alias("records"), _median(F.col("value"), accuracy, exact).alias("median")
    )
    off = F.abs(F.col("value") - F.col("median"))
    found = _beside(rows, middle, by).groupBy(*cols(by), "records", "median").agg(
        _median(off, accuracy, exact).alias("median_off"), F.avg(off).alias("mean_off")
    )
    spread = F.when(F.col("median_off") > 0, MEDIAN_SCALE * F.col("median_off"))
    return found.select(
        *cols(by), "records", "median", spread.otherwise(MEAN_SCALE * F.col("mean_off")).alias("spread")
    )


def _beside(df: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows with the figures of their group; NULL is a group of its own.

    Spark broadcasts the groups if they are few; if not, it joins by a shuffle, in which adaptive
    execution splits a group that holds much of the table.
    """
    figures = [c for c in groups.columns if c not in by]
    if not by:
        one = groups.select(F.struct(*cols(figures))).scalar()
        return df.withColumns({c: one[c] for c in figures})
    same = [F.col(f"r.{quoted(n)}").eqNullSafe(F.col(f"g.{quoted(n)}")) for n in by]
    joined = df.alias("r").join(groups.alias("g"), same, "left")
    return joined.select("r.*", *[F.col(f"g.{quoted(c)}").alias(c) for c in figures])


def label_anomalies(
    df: DataFrame,
    column: str,
    by: Sequence[str] = (),
    limit: float = LIMIT,
    accuracy: int = ACCURACY,
    exact: bool = False,
) -> DataFrame:
    """Add ``median``, ``distance`` and ``anomaly`` to every row.

    ``distance`` is that from the median of the row's group, in spreads (see
    :func:`robust_spread`); ``anomaly`` is ``low`` or ``high`` beyond ``limit`` spreads, else
    ``none``. A NULL or NaN has neither. In a group of equal values nothing is an anomaly.
    Three scans: medians, spreads, labels.
    """
    spread = robust_spread(df, column, by, accuracy, exact).select(*cols(by), "median", "spread")
    value = _judged(col(column))
    off = value - F.col("median")
    distance = F.when(F.col("spread") > 0, off / F.col("spread")).when(off.isNotNull(), F.lit(0.0))
    side = F.when(F.col("distance") > limit, "high").when(F.col("distance") < -limit, "low")
    labelled = _beside(df, spread, by).withColumn("distance", distance).drop("spread")
    return labelled.withColumn("anomaly", F.when(F.col("distance").isNotNull(), F.coalesce(side, F.lit("none"))))


def anomaly_summary(labelled: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per group: values judged, and how many of them are low and high."""
    return labelled.groupBy(*cols(by)).agg(
        F.count("anomaly").alias("judged"),
        F.count_if(F.col("anomaly") == "low").alias("low"),
        F.count_if(F.col("anomaly") == "high").alias("high"),
    )
