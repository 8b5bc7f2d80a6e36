"""Text sources and sinks: lines, delimited rows, code tables, CSV exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlake.operators import (
    Section,
    code_table_report,
    extract_code_tables,
    section_bounds,
)
from recordlake.plans import (
    export_code_tables,
    export_column_profile,
    export_value_counts,
    read_code_tables,
)
from recordlake.scratch import scratch_path
from recordlake.sources import (
    number_lines,
    read_delimited,
    read_exported,
    read_lines,
    read_raw_rows,
    write_csv_tables,
)
from workload.lakes import raw_lake
from workload.profiles import profile_sql
from workload.registry import query
from workload.sql import DATED, LOOKUPS, VISITS
from workload.tables import (
    CODES_PER_FILE,
    dated_orders,
    table,
    write_code_text,
    write_customer_text,
)

_SECTIONS = (
    Section("custname", "value custname", ";"),
    Section("custsegment", "value custsegment", ""),
)


@query(f"""WITH files AS (
  SELECT c_custkey // {CODES_PER_FILE} AS file_no, * FROM customer),
lines AS (
  SELECT file_no, 1 AS part, c_custkey AS n,
         chr(9) || '''' || c_custkey || ''' = ''' || c_name || ' '' ' AS line FROM files
  UNION ALL SELECT file_no, 4, c_custkey, '  ' || c_custkey || '=' || c_mktsegment FROM files
  UNION ALL SELECT DISTINCT file_no, part, 0, text FROM files, (VALUES
    (0, 'value custname'), (2, ';'), (3, 'value custsegment'), (5, ''),
    (6, '/* a = b, outside */')) AS t(part, text))
SELECT CAST(file_no AS INTEGER) AS file_no,
       row_number() OVER (PARTITION BY file_no ORDER BY part, n) AS line_no, line FROM lines""")
def numbered_lines(spark, sf_dir):
    path = scratch_path(spark, "lines")
    write_customer_text(spark, sf_dir, path)
    lines = number_lines(read_lines(spark, path))
    file_no = F.regexp_extract("file", "file_no=([0-9]+)", 1).cast("int")
    return lines.select(file_no.alias("file_no"), "line_no", "line")


@query("""SELECT 'custname' AS section, CAST(c_custkey AS VARCHAR) AS key, c_name AS value
FROM customer
UNION ALL SELECT 'custsegment', CAST(c_custkey AS VARCHAR), c_mktsegment FROM customer""")
def code_tables_of_many_files(spark, sf_dir):
    path = scratch_path(spark, "formats")
    write_customer_text(spark, sf_dir, path)
    return extract_code_tables(spark, path, _SECTIONS).drop("file")


@query(f"""WITH files AS (SELECT c_custkey // {CODES_PER_FILE} AS file_no FROM customer),
n AS (SELECT file_no, count(*) AS n FROM files GROUP BY 1)
SELECT CAST(file_no AS INTEGER) AS file_no, 'custname' AS section,
       CAST(1 AS BIGINT) AS first_line, n + 2 AS last_line FROM n
UNION ALL SELECT CAST(file_no AS INTEGER), 'custsegment', n + 3, 2 * n + 4 FROM n""")
def section_line_numbers(spark, sf_dir):
    """At which lines of each file the sections begin and end."""
    path = scratch_path(spark, "formats")
    write_customer_text(spark, sf_dir, path)
    lines = read_lines(spark, path)
    bounds = section_bounds(lines, _SECTIONS, few_bounds=False)
    first = bounds.select("file", "section", F.lit("first").alias("edge"), "first.*")
    last = bounds.select("file", "section", F.lit("last").alias("edge"), "last.*")
    edges = number_lines(lines, keep_position=True).join(
        first.unionAll(last), ["file", "block", "row_id"]
    )
    file_no = F.regexp_extract("file", "file_no=([0-9]+)", 1).cast("int")
    return edges.groupBy(file_no.alias("file_no"), "section").agg(
        F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line")
    )


@query("""SELECT 'custname' AS section, CAST(c_custkey AS INTEGER) AS key, c_name AS value
FROM customer
UNION ALL SELECT 'custsegment', CAST(c_custkey AS INTEGER), c_mktsegment FROM customer""")
def code_tables_with_number_keys(spark, sf_dir):
    """The same code tables, with int keys, when sections are too many to broadcast."""
    path = scratch_path(spark, "formats")
    write_customer_text(spark, sf_dir, path)
    tables = extract_code_tables(
        spark, path, _SECTIONS, numeric_key=True, max_broadcast_sections=0
    )
    return tables.drop("file")


@query(f"""SELECT 'custname' AS section, count(DISTINCT c_custkey // {CODES_PER_FILE}) AS files,
       count(*) AS code_lines, CAST(0 AS BIGINT) AS other_lines FROM customer
UNION ALL SELECT 'custsegment', count(DISTINCT c_custkey // {CODES_PER_FILE}), count(*), 0
FROM customer
UNION ALL SELECT 'absent', 0, 0, 0""")
def code_table_section_report(spark, sf_dir):
    path = scratch_path(spark, "formats")
    write_customer_text(spark, sf_dir, path)
    sections = [*_SECTIONS, Section("absent", "value absent", ";")]
    return code_table_report(spark, path, sections)


@query(f"""WITH {LOOKUPS}
SELECT 'i94addr' AS lookup, key, value FROM addr
UNION ALL SELECT 'i94cntyl', key, value FROM cntyl
UNION ALL SELECT 'i94mode', key, value FROM mode
UNION ALL SELECT 'i94port', key, value FROM port
UNION ALL SELECT 'i94visa', key, value FROM visa""")
def code_table_export(spark, sf_dir):
    """Format text to code tables to CSV, and the CSV read back."""
    text, out = scratch_path(spark, "code-text"), scratch_path(spark, "code-csv")
    write_code_text(spark, sf_dir, text)
    export_code_tables(spark, text, out)
    tables = None
    for name, pairs in read_code_tables(spark, out).items():
        one = pairs.select(F.lit(name).alias("lookup"), "key", "value")
        tables = one if tables is None else tables.unionAll(one)
    return tables


def _delimited_orders(spark, sf_dir, header):
    path = scratch_path(spark, "delimited")
    orders = dated_orders(spark, sf_dir).select(
        "o_orderkey",
        "status",
        F.concat_ws(";", "o_orderpriority", "o_custkey").alias("note"),
        "o_totalprice",
    )
    orders.write.csv(path, sep=";", header=header)
    return path


@query(f"""WITH {DATED}
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, status,
       o_orderpriority || ';' || o_custkey AS note,
       CAST(o_totalprice AS VARCHAR) AS o_totalprice
FROM dated""")
def delimited_read(spark, sf_dir):
    return read_delimited(spark, _delimited_orders(spark, sf_dir, True), sep=";")


@query(f"""WITH {DATED}
SELECT o_orderkey || ';' || coalesce(status, '') || ';"' || o_orderpriority || ';' || o_custkey
       || '";' || CAST(o_totalprice AS VARCHAR) AS _c0
FROM dated""")
def raw_row_read(spark, sf_dir):
    return read_raw_rows(spark, _delimited_orders(spark, sf_dir, False))


@query("""SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(count(*) AS VARCHAR) AS "count"
FROM orders GROUP BY orders.o_custkey ORDER BY orders.o_custkey NULLS FIRST LIMIT 1000""")
def value_counts_csv(spark, sf_dir):
    path = scratch_path(spark, "counts")
    export_value_counts(dated_orders(spark, sf_dir), "o_custkey", path, n=1000)
    return read_exported(spark, path)


#: Texts that CSV may lose: blanks at the ends, quotes, line ends, backslashes, nothing at all.
_AWKWARD = """SELECT 'all' AS export, CASE l_linenumber
         WHEN 1 THEN ' ' || l_returnflag || ' ' WHEN 2 THEN '"' || l_returnflag || '",'
         WHEN 3 THEN l_returnflag || {line_end} || 'x' WHEN 4 THEN l_returnflag || {backslash}
         WHEN 5 THEN '' WHEN 6 THEN NULL ELSE l_returnflag END AS value
  FROM lineitem"""


@query(f"""SELECT value, CAST(count(*) AS VARCHAR) AS records
FROM ({_AWKWARD.format(line_end="chr(10)", backslash="chr(92)")}) GROUP BY value""")
def csv_of_awkward_values(spark, sf_dir):
    """Groups of texts that are hard to write, exported and read again."""
    lines = table(spark, sf_dir, "lineitem")
    sql = _AWKWARD.format(line_end="char(10)", backslash="char(92)").replace("lineitem", "{lines}")
    counts = spark.sql(sql, lines=lines).groupBy("export", "value").agg(F.count("*").alias("records"))
    path = scratch_path(spark, "awkward")
    write_csv_tables(counts, path, "export")
    return read_exported(spark, path).select("value", "records")


_RAW_LAKE_COLUMNS = (
    "cicid", "i94cit", "i94res", "arrdate", "i94mode", "depdate", "i94bir", "i94visa",
    "count", "biryear", "admnum", "i94port", "i94addr", "dtadfile", "visapost", "occup",
    "entdepa", "entdepd", "entdepu", "matflag", "dtaddto", "gender", "insnum", "airline",
    "fltno", "visatype", "i94yr", "i94mon",
)


@query(
    f"WITH {VISITS}, profile AS ("
    + " UNION ALL ".join(
        f"SELECT * FROM ({profile_sql('visits', c)})" for c in _RAW_LAKE_COLUMNS
    )
    + """) SELECT column_name, CAST(position AS VARCHAR) AS position,
       TRY_CAST(value AS DOUBLE) AS number,
       CASE WHEN TRY_CAST(value AS DOUBLE) IS NULL THEN value END AS text,
       CAST(records AS VARCHAR) AS records FROM profile"""
)
def column_profile_export(spark, sf_dir):
    """The value counts of all 28 columns of a lake, by CSV."""
    out = scratch_path(spark, "profile")
    export_column_profile(spark, raw_lake(spark, sf_dir), out, n=1000)
    number = F.col("value").try_cast("double")
    return read_exported(spark, out).select(
        "column_name",
        "position",
        number.alias("number"),
        F.when(number.isNull(), F.col("value")).alias("text"),
        "records",
    )
