"""Day numbers counted from 1960-01-01, and the dates they stand for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The epoch, and the day numbers of 0001-01-01 and 9999-12-31.
EPOCH = "1960-01-01"
FIRST_DAY = -715509
LAST_DAY = 2936549
WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"


def day_number_to_date(days: Column, text: bool = False) -> Column:
    """Date of a day number, as a native expression (no UDF).

    Fractions are cut towards zero. NULL, NaN, infinities and numbers outside
    the years 1 to 9999 give NULL. Set ``text`` when the input is a string:
    text that is no whole number then gives NULL, and the literal ``'null'``
    stands for day 0.

    Unfit values are ruled out before the cast, since a failing ``try_cast``
    costs an exception per value.
    """
    if text:
        days = F.when(days == "null", F.lit(0)).when(
            days.rlike(WHOLE_NUMBER), days.try_cast("bigint")
        )
    in_range = (days > FIRST_DAY - 1) & (days < LAST_DAY + 1)
    return F.when(in_range, F.date_add(F.lit(EPOCH).cast("date"), days.cast("int")))


def date_to_day_number(date: Column) -> Column:
    """Day number (int) of a date: the inverse of :func:`day_number_to_date`.

    A date bound turned into a day number can be compared with the stored day
    column itself, so that the filter reaches the parquet scan.
    """
    return F.datediff(date, F.lit(EPOCH).cast("date"))


def arrival_features(date: Column) -> dict[str, Column]:
    """ISO week and day of week (1 = Sunday) of a date, for ``withColumns``."""
    return {
        "arrival_week": F.weekofyear(date),
        "arrival_day_of_week": F.dayofweek(date),
    }
