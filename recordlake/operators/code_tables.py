"""Lookup tables out of format text: sections of ``code = label`` lines.

A section begins after the first line that equals its start line, and ends
before the next line that equals its end line (or with the file).

The text is read in splits and never brought together per file. Two small
aggregations find where each section begins and ends; a join with those bounds
then picks the lines in between.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.functions.columns import literal_rows
from recordlake.functions.text import code_of_line, has_assignment, label_of_line
from recordlake.scratch import scratch_path
from recordlake.sources.readers import read_lines

# Up to this many sections, over all files, the bounds are broadcast.
MAX_BROADCAST_SECTIONS = 100_000


@dataclass(frozen=True)
class Section:
    """A lookup table's place in the text. Start and end are whole lines."""

    name: str
    start: str
    end: str


def _position() -> Column:
    return F.struct("block", "row_id")


def _sections_started_by(line: Column, sections: Sequence[Section]) -> Column:
    """Rows ``section, end_line``: the sections that begin with a line."""
    listed = F.array(
        *[
            F.struct(
                F.lit(s.name).alias("section"),
                F.lit(s.end).alias("end_line"),
                F.lit(s.start).alias("start_line"),
            )
            for s in sections
        ]
    )
    started = F.filter(listed, lambda s: s["start_line"] == line)
    return F.inline(
        F.transform(started, lambda s: F.struct(s["section"], s["end_line"]))
    )


def _attach(lines: DataFrame, bounds: DataFrame, few_bounds: bool) -> DataFrame:
    """Join lines with the bounds of the sections of their file.

    Many bounds are first spread over the splits their section covers, so that
    the join key is the split: no key has more lines than a split.
    """
    if few_bounds:
        return lines.join(F.broadcast(bounds), "file")
    reaches = F.col("block") >= F.col("first.block")
    if "last" in bounds.columns:
        reaches &= F.col("last").isNull() | (F.col("block") <= F.col("last.block"))
    splits = lines.select("file", "block").distinct()
    per_split = splits.join(bounds, "file").where(reaches)
    return lines.join(per_split, ["file", "block"])


def section_starts(lines: DataFrame, sections: Sequence[Section]) -> DataFrame:
    """``file, section, end_line, first``: where the sections of each file begin."""
    return (
        lines.where(F.col("line").isin([s.start for s in sections]))
        .select(
            "file",
            _position().alias("position"),
            _sections_started_by(F.col("line"), sections).alias("section", "end_line"),
        )
        .groupBy("file", "section", "end_line")
        .agg(F.min("position").alias("first"))
    )


def section_bounds(
    lines: DataFrame, sections: Sequence[Section], few_bounds: bool, starts: DataFrame | None = None
) -> DataFrame:
    """``file, section, first, last``: positions of the start and the end line.

    ``last`` is NULL where a section has no end line. A section that a file does
    not have gives no row. ``starts`` saves looking for them (see :func:`section_starts`).
    """
    if starts is None:
        starts = section_starts(lines, sections)
    ends = (
        _attach(
            lines.where(F.col("line").isin([s.end for s in sections])),
            starts,
            few_bounds,
        )
        .where((F.col("line") == F.col("end_line")) & (_position() > F.col("first")))
        .groupBy("file", "section")
        .agg(F.min(_position()).alias("last"))
    )
    return starts.join(ends, ["file", "section"], "left").select(
        "file", "section", "first", "last"
    )


def section_lines(
    spark: SparkSession,
    path,
    sections: Sequence[Section],
    max_broadcast_sections: int = MAX_BROADCAST_SECTIONS,
) -> DataFrame:
    """The lines within the sections of all files: ``file, section, block, row_id, line``.

    Where sections begin is stored first; how many begin decides whether bounds are broadcast.
    """
    lines = read_lines(spark, path)
    found, place = section_starts(lines, sections), scratch_path(spark, "section-starts")
    found.write.parquet(place)
    starts = spark.read.schema(found.schema).parquet(place)
    few_bounds = starts.count() <= max_broadcast_sections
    bounds = section_bounds(lines, sections, few_bounds, starts)
    inside = (_position() > F.col("first")) & (
        F.col("last").isNull() | (_position() < F.col("last"))
    )
    return (
        _attach(lines, bounds, few_bounds)
        .where(inside)
        .select("file", "section", "block", "row_id", "line")
    )


def extract_code_tables(
    spark: SparkSession,
    path,
    sections: Sequence[Section],
    numeric_key: bool = False,
    ordered: bool = True,
    max_broadcast_sections: int = MAX_BROADCAST_SECTIONS,
) -> DataFrame:
    """Lookup tables of all files: ``file, section, key, value``.

    Keys are text, ordered as text, unless ``numeric_key`` asks for ints. Lines
    without ``=`` are no code lines and are left out.
    """
    lines = section_lines(spark, path, sections, max_broadcast_sections)
    key = code_of_line(F.col("line"))
    tables = lines.where(has_assignment(F.col("line"))).select(
        "file",
        "section",
        (key.try_cast("int") if numeric_key else key).alias("key"),
        label_of_line(F.col("line")).alias("value"),
    )
    return tables.orderBy("file", "section", "key") if ordered else tables


def code_table(tables: DataFrame, section: str) -> DataFrame:
    """One lookup, ``key, value`` by key, out of :func:`extract_code_tables`."""
    return (
        tables.where(F.col("section") == section).select("key", "value").orderBy("key")
    )


def code_table_report(
    spark: SparkSession, path, sections: Sequence[Section]
) -> DataFrame:
    """Per wanted section: files that have it, its code lines, and its other lines.

    A section that no file has is reported with zeros.
    """
    found = (
        section_lines(spark, path, sections)
        .groupBy("section")
        .agg(
            F.count_distinct("file").alias("files"),
            F.count_if(has_assignment(F.col("line"))).alias("code_lines"),
            F.count_if(~has_assignment(F.col("line"))).alias("other_lines"),
        )
    )
    wanted = literal_rows(spark, [{"section": F.lit(s.name)} for s in sections])
    return wanted.join(found, "section", "left").fillna(0)
