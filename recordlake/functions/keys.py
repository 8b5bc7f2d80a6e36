"""Composite text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_number_text(number: Column) -> Column:
    """Text of a whole number held as a double: ``2016.0`` gives ``'2016'``.

    The cast goes through bigint, so ids beyond the int range stay distinct.
    NaN and values beyond bigint give NULL instead of failing the job.
    """
    return number.try_cast("bigint").cast("string")


def composite_key(year: Column, month: Column, record_id: Column) -> Column:
    """``yyyy-mm-id`` key, e.g. ``2016-04-7``; NULL if any part is NULL.

    The month is padded to (and cut at) two characters, the id is not padded.
    """
    return F.concat(
        whole_number_text(year),
        F.lit("-"),
        F.lpad(whole_number_text(month), 2, "0"),
        F.lit("-"),
        whole_number_text(record_id),
    )
