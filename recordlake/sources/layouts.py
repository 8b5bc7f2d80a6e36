"""Which columns each input file has, and files of one layout read as one scan."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.columns import cols

#: Paths whose columns are looked up at a time, where each takes a small job of its own.
LOOKUPS_AT_ONCE = 16
_GLOB_SIGNS = "\\{}[]*?"


@dataclass(frozen=True)
class Layout:
    """Paths whose files have the same columns, which stand here in the order of the files."""

    columns: tuple[str, ...]
    paths: tuple[str, ...]


def _is_true(value) -> bool:
    return str(value).lower() == "true"


def has_header(fmt: str, options: dict) -> bool:
    """Whether the first line of each file names its columns, and ends with them."""
    return fmt == "csv" and _is_true(options.get("header")) and not _is_true(options.get("multiline"))


def first_lines(spark: SparkSession, paths: Sequence[str], options: dict | None = None) -> DataFrame:
    """``file, line``: the first line of each file that is not blank, in one job.

    Each file begins a task of its own, which stops reading a little after that line, so a file's
    size does not matter. Blank files have no row. Lines that begin with the option ``comment`` are passed
    over. The session's settings stay as they are.
    """
    options = {k.lower(): v for k, v in (options or {}).items()}
    comment = options.get("comment") or None
    session = spark.newSession()
    size = session.conf.get("spark.sql.files.maxPartitionBytes")
    session.conf.set("spark.sql.files.openCostInBytes", size)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    reader = session.read
    if "linesep" in options:
        reader = reader.option("lineSep", options["linesep"])
    lines = reader.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    )

    def run(batches):
        found = False
        for batch in batches:
            if found:
                return  # only where there is more to read: a worker that stops early is used up
            for file, block, line in zip(*map(pa.Array.to_pylist, batch.columns)):
                if block != 0:
                    found = True
                elif line.strip() and not (comment and line.startswith(comment)):
                    found = True
                    yield pa.RecordBatch.from_pydict({"file": [file], "line": [line]})
                if found:
                    break

    return lines.mapInArrow(run, "file string, line string")


def _plain_path(uri: str) -> str:
    """A path to load out of a file's address, in which signs are encoded."""
    path = unquote(uri)
    return "".join("\\" + c if c in _GLOB_SIGNS else c for c in path)


def _header_layouts(spark: SparkSession, paths: Sequence[str], options: dict) -> list[Layout]:
    by_line: dict[str, list[str]] = {}
    # One short row per file; the caller's own list of paths is no shorter in kind.
    for row in first_lines(spark, paths, options).collect():
        by_line.setdefault(row["line"], []).append(_plain_path(row["file"]))
    named = {k: v for k, v in options.items() if k != "inferschema"}
    reader = spark.read.format("csv").options(**named)
    return [
        Layout(tuple(reader.load(sorted(files)[0]).columns), tuple(sorted(files)))
        for _, files in sorted(by_line.items())
    ]


def file_layouts(
    spark: SparkSession, paths: Sequence[str], fmt: str = "parquet", options: dict | None = None
) -> list[Layout]:
    """The layouts of input files, each with the paths that have it.

    For CSV with a header one job reads the first line of every file. For other formats each
    path's own columns are looked up, several paths at a time; a folder of files counts as one
    path. The result has as many layouts as there are different lists of columns.
    """
    options = {k.lower(): v for k, v in (options or {}).items()}
    if not paths:
        return []
    if has_header(fmt, options):
        return _header_layouts(spark, paths, options)
    reader = spark.read.format(fmt).options(**options)
    if fmt in ("parquet", "orc"):
        reader = reader.option("mergeSchema", True)
    with ThreadPoolExecutor(LOOKUPS_AT_ONCE) as pool:
        found = list(pool.map(lambda path: tuple(reader.load(path).columns), paths))
    by_columns: dict[tuple, list[str]] = {}
    for columns, path in zip(found, paths):
        by_columns.setdefault(columns, []).append(path)
    return [Layout(columns, tuple(files)) for columns, files in by_columns.items()]


def read_layout(
    spark: SparkSession, layout: Layout, fmt: str = "parquet", options: dict | None = None, schema=None
) -> DataFrame:
    """The files of one layout as one scan.

    A given schema types the columns by name, wherever they stand in the files. Columns that it
    does not name are left out, and those that the files lack are not there.
    """
    options = {k.lower(): v for k, v in (options or {}).items()}
    reader = spark.read.format(fmt).options(**options)
    paths = list(layout.paths)
    if schema is None:
        return reader.load(paths)
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    if not has_header(fmt, options):
        return reader.schema(wanted).load(paths)
    types = {field.name: field.dataType for field in wanted}
    fields = [T.StructField(c, types.get(c, T.StringType())) for c in layout.columns]
    frame = reader.option("enforceSchema", False).schema(T.StructType(fields)).load(paths)
    return frame.select(*cols(c for c in layout.columns if c in types))


def united(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames united by column name; a column that one lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
