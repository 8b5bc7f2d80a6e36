"""Readers: monthly files, partitioned lakes, delimited text and raw lines."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordlake.scratch import scratch_path
from recordlake.sources.layouts import file_layouts, has_header, read_layout, united

# Splits whose line counts are broadcast; each takes a path and a few numbers.
_FEW_SPLITS = 200_000

# Exported CSV: quotes are doubled, blanks at the ends stay, NULL is an empty field and an
# empty text a pair of quotes.
CSV_LAYOUT = dict(
    header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
)


def expand_paths(template: str, **lists) -> list[str]:
    """Fill a path template with every combination of the given values.

    ``expand_paths("in/visits_{mmm}{yy}", yy=["16"], mmm=["jan", "feb"])`` gives
    two paths. The first list varies slowest.
    """
    names = list(lists)
    return [
        template.format(**dict(zip(names, values)))
        for values in product(*(lists[n] for n in names))
    ]


def read_files(
    spark: SparkSession,
    paths: list[str],
    fmt: str = "parquet",
    options: dict | None = None,
    schema=None,
    same_schema: bool = False,
) -> DataFrame:
    """Read many files of any installed format as one frame, hence one job.

    Every file is read with its own columns; a column that a file lacks is NULL
    there. Parquet, ORC and JSON files are compared by Spark in one job. Of CSV files with
    a header one job reads the first lines, and files with equal headers share a scan, so
    the plan grows with the headers and not with the files. Paths of other formats are
    united by column name. ``same_schema=True`` promises that all files have the
    columns of the first and saves the comparison; other columns would be lost.

    A given schema holds for all files. CSV files with a header are read by the names in
    their headers, whatever their order; the schema's types go by name.
    """
    options = {k.lower(): v for k, v in (options or {}).items()}
    reader = spark.read.format(fmt).options(**options)
    if same_schema or not paths:
        return (reader if schema is None else reader.schema(schema)).load(paths)
    if has_header(fmt, options):
        layouts = file_layouts(spark, paths, fmt, options)
        frames = [read_layout(spark, layout, fmt, options, schema) for layout in layouts]
        if schema is not None:
            # The schema's columns in its order, also those that no file has.
            frames = [spark.createDataFrame([], schema), *frames]
        elif not frames:
            return reader.load(paths)
        return united(frames)
    if schema is not None:
        return reader.schema(schema).load(paths)
    if fmt in ("parquet", "orc"):
        return reader.option("mergeSchema", True).load(paths)
    if fmt in ("json", "text"):
        return reader.load(paths)
    return united([reader.load(path) for path in paths])


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """Read a partitioned parquet lake by its base directory.

    The partition columns come last and stay usable in filters, where they
    prune directories.
    """
    return spark.read.parquet(path)


def read_lake_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Read the lake files that match a glob below ``path``, e.g. ``*/*/*.parquet``.

    ``basePath`` keeps the partition columns, which a bare glob would lose.
    """
    base = path.rstrip("/")
    return spark.read.option("basePath", base).parquet(f"{base}/{pattern}")


def read_default(spark: SparkSession, path: str) -> DataFrame:
    """Read with the session's default source format (parquet unless changed)."""
    return spark.read.load(path)


def read_delimited(
    spark: SparkSession, path, sep: str = ",", header: bool = True, schema=None
) -> DataFrame:
    """Read delimited text. Without a schema every column is a string.

    A schema saves the look at the header; it is checked against it, by name.
    """
    return spark.read.csv(
        path, schema=schema, sep=sep, header=header, enforceSchema=schema is None
    )


def read_exported(spark: SparkSession, path, schema=None) -> DataFrame:
    """Read what the CSV sinks of this library wrote, value for value.

    Values may hold line ends, so a file is read by one task: exports are bounded
    listings and code tables. An empty field is NULL, a quoted empty one is an empty
    text; for that, the text of one NUL character stands for NULL in the reader.
    """
    return spark.read.csv(
        path, schema=schema, multiLine=True, nullValue="\0", enforceSchema=schema is None,
        **CSV_LAYOUT,
    )


def read_raw_rows(spark: SparkSession, path) -> DataFrame:
    """Read delimited text with the whole row in one column ``_c0``.

    Meant for choosing a delimiter. Blank lines are dropped.
    """
    return spark.read.schema("_c0 string").csv(path, sep="\n")


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Read text as lines that know their order: ``file, block, row_id, line``.

    Text files are read in splits. ``block`` is the byte at which the line's
    split begins and ``row_id`` grows within a split, so ``(block, row_id)``
    orders the lines of a file without a sort and without reading a whole file
    in one task. Line ends are LF, CR or CRLF; blank lines are kept.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row_id"),
        F.col("value").alias("line"),
    )


def number_lines(lines: DataFrame, keep_position: bool = False) -> DataFrame:
    """Add ``line_no`` (from 1, per file) to the result of :func:`read_lines`.

    Gives ``file, line_no, line``, with ``block`` and ``row_id`` if wanted.

    Lines are counted per split; a running sum over the splits of a file (one
    row per split) turns positions within a split into line numbers. These sums are
    stored. Unless there are very many splits they are broadcast, and no text is shuffled.
    """
    earlier = (
        Window.partitionBy("file")
        .orderBy("block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = (
        lines.groupBy("file", "block")
        .agg(F.min("row_id").alias("first_id"), F.count("*").alias("n"))
        .select(
            "file",
            "block",
            "first_id",
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        )
    )
    spark = lines.sparkSession
    path = scratch_path(spark, "line-counts")
    blocks.write.parquet(path)
    blocks = spark.read.schema(blocks.schema).parquet(path)
    if blocks.count() <= _FEW_SPLITS:
        blocks = F.broadcast(blocks)
    return lines.join(blocks, ["file", "block"]).select(
        "file",
        (F.col("row_id") - F.col("first_id") + F.col("before") + 1).alias("line_no"),
        "line",
        *(["block", "row_id"] if keep_position else []),
    )
