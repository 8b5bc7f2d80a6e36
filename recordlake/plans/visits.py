"""The visit-record data model: columns, code tables and where labels go."""

from __future__ import annotations

from pyspark.sql import types as T

from recordlake.operators.code_tables import Section

# The raw record, in source order. All numbers arrive as doubles.
RAW_COLUMNS = (
    ("cicid", "double"), ("i94yr", "double"), ("i94mon", "double"), ("i94cit", "double"),
    ("i94res", "double"), ("i94port", "string"), ("arrdate", "double"), ("i94mode", "double"),
    ("i94addr", "string"), ("depdate", "double"), ("i94bir", "double"), ("i94visa", "double"),
    ("count", "double"), ("dtadfile", "string"), ("visapost", "string"), ("occup", "string"),
    ("entdepa", "string"), ("entdepd", "string"), ("entdepu", "string"), ("matflag", "string"),
    ("biryear", "double"), ("dtaddto", "string"), ("gender", "string"), ("insnum", "string"),
    ("airline", "string"), ("admnum", "double"), ("fltno", "string"), ("visatype", "string"),
)
NUMBER_COLUMNS = tuple(name for name, dtype in RAW_COLUMNS if dtype == "double")
TEXT_COLUMNS = tuple(name for name, dtype in RAW_COLUMNS if dtype == "string")
RAW_COLUMN_COUNT = len(RAW_COLUMNS)

# Partitioning, record id and ids that are near-unique.
PARTITION_BY = ("i94yr", "i94mon")
RECORD_ID = "cicid"
NEAR_UNIQUE_COLUMNS = ("cicid", "admnum")

# Monthly input files are named i94_<month><year>_sub.
MONTH_NAMES = (
    "jan", "feb", "mar", "apr", "may", "jun",
    "jul", "aug", "sep", "oct", "nov", "dec",
)
FILE_TEMPLATE = "{base}/i94_{mmm}{yy}_sub{suffix}"

# Where each code table stands in the format text.
CODE_TABLES = (
    Section("i94addr", "value i94addrl", ""),
    Section("i94cntyl", "  value i94cntyl", ""),
    Section("i94port", "  value $i94prtl", ";"),
    Section("i94mode", "value i94model", "\t"),
    Section("i94visa", "/* I94VISA - Visa codes collapsed into three categories:", "*/"),
)

# Code column, its code table, and whether the code is a number.
LABELLED_CODES = (
    ("i94addr", "i94addr", False),
    ("i94cit", "i94cntyl", True),
    ("i94res", "i94cntyl", True),
    ("i94mode", "i94mode", True),
    ("i94port", "i94port", False),
    ("i94visa", "i94visa", True),
)

# The enriched record, in output order.
ENRICHED_COLUMNS = (
    "guid", "i94yr", "i94mon", "cicid", "arrival_date", "departure_date",
    "i94addr", "i94addr_value", "i94cit", "i94cit_value", "i94res", "i94res_value",
    "i94mode", "i94mode_value", "i94port", "i94port_value", "i94visa",
    "i94visa_value", "visatype", "visapost", "gender", "biryear", "i94bir", "occup",
    "admnum", "insnum", "entdepa", "entdepd", "entdepu", "matflag", "dtadfile",
    "dtaddto", "airline", "fltno", "arrdate", "depdate",
)


def raw_schema() -> T.StructType:
    """Schema of a raw visit record in source order, for formats without types."""
    types = {"double": T.DoubleType(), "string": T.StringType()}
    return T.StructType([T.StructField(name, types[dtype]) for name, dtype in RAW_COLUMNS])
