"""Cleanup of ``code = label`` text lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    """Remove white space of every kind (tabs too) from both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def code_of_line(line: Column) -> Column:
    """The code: what stands before the first ``=``, without quotes and padding."""
    left = F.substring_index(line, "=", 1)
    return strip(F.replace(strip(left), F.lit("'"), F.lit("")))


def label_of_line(line: Column) -> Column:
    """The label: all after the first ``=``, without quotes, ``;`` and padding."""
    right = F.substr(line, F.instr(line, "=") + 1)
    return strip(F.regexp_replace(right, "[';\r\n]", ""))


def has_assignment(line: Column) -> Column:
    return F.instr(line, "=") > 0
