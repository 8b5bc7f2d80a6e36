from recordlake.sources.layouts import Layout, file_layouts, first_lines, read_layout
from recordlake.sources.manifest import (
    column_counts,
    ingest_manifest,
    missing_columns,
    read_manifest,
    write_manifest,
)
from recordlake.sources.readers import (
    expand_paths,
    number_lines,
    read_default,
    read_delimited,
    read_exported,
    read_files,
    read_lake,
    read_lake_files,
    read_lines,
    read_raw_rows,
)
from recordlake.sources.writers import (
    replace_partitions,
    roundtrip,
    whole_partition_values,
    write_csv_tables,
    write_lake,
    write_value_counts_csv,
)

__all__ = [
    "Layout",
    "column_counts",
    "expand_paths",
    "file_layouts",
    "first_lines",
    "ingest_manifest",
    "missing_columns",
    "number_lines",
    "read_default",
    "read_delimited",
    "read_exported",
    "read_files",
    "read_lake",
    "read_lake_files",
    "read_layout",
    "read_lines",
    "read_manifest",
    "read_raw_rows",
    "replace_partitions",
    "roundtrip",
    "whole_partition_values",
    "write_csv_tables",
    "write_lake",
    "write_manifest",
    "write_value_counts_csv",
]
