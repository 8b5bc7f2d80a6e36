"""Column profiles, overviews and type recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlake.operators import (
    apply_numeric_types,
    first_value_counts,
    near_unique_columns,
    profile_value_counts,
    recommend_numeric_types,
    table_overview,
    table_preview,
)
from recordlake.plans import visits
from workload.registry import query
from workload.sql import DATED, VISITS
from workload.tables import dated_orders, table, visit_records


def profile_sql(source: str, column: str, n: int = 1000) -> str:
    return f"""SELECT '{column}' AS column_name,
  CAST(row_number() OVER (ORDER BY v ASC NULLS FIRST) AS INTEGER) AS position,
  CAST(v AS VARCHAR) AS value, records
FROM (SELECT "{column}" AS v, count(*) AS records FROM {source} GROUP BY 1)
QUALIFY position <= {n}"""


_PROFILED = (
    "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "status", "y", "m",
    "order_date", "days",
)


@query(
    f"WITH {DATED} "
    + " UNION ALL ".join(f"SELECT * FROM ({profile_sql('dated', c)})" for c in _PROFILED)
)
def profile_all_columns(spark, sf_dir):
    return profile_value_counts(
        dated_orders(spark, sf_dir), n=1000, near_unique=["o_orderkey", "o_totalprice"]
    )


@query("""SELECT l_extendedprice, count(*) AS records FROM lineitem
GROUP BY 1 ORDER BY 1 NULLS FIRST LIMIT 500""")
def profile_near_unique_column(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    return first_value_counts(items, "l_extendedprice", 500, sample_fraction=0.05)


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation LIMIT 100")
def preview_of_a_short_table(spark, sf_dir):
    """A preview of more rows than there are is the whole table."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return table_preview(nation, 100)


@query("""SELECT column_name, n >= 100 AS near_unique FROM (
  SELECT 'o_orderkey' AS column_name, count(DISTINCT o_orderkey) AS n FROM orders
  UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) FROM orders
  UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM orders)""")
def near_unique_flags(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    columns = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    return near_unique_columns(orders, columns, min_values=100).drop("approx_values")


@query(f"""WITH {DATED}, n AS (SELECT count(*) AS n_rows FROM dated)
SELECT 'dated_orders' AS table_name, CAST(position AS INTEGER) AS position, column_name,
       data_type, true AS nullable, n_rows, 9 AS n_columns
FROM n, (VALUES (1, 'o_orderkey', 'bigint'), (2, 'o_custkey', 'bigint'),
  (3, 'o_totalprice', 'double'), (4, 'o_orderpriority', 'string'), (5, 'status', 'string'),
  (6, 'y', 'double'), (7, 'm', 'double'), (8, 'order_date', 'date'), (9, 'days', 'double')
) AS t(position, column_name, data_type)""")
def overview(spark, sf_dir):
    return table_overview(dated_orders(spark, sf_dir), "dated_orders")


def _with_odd_numbers(visits_frame):
    """Columns that no integer type holds, one just at the int limit, one all NULL."""
    return visits_frame.withColumns(
        {
            "half": F.col("i94bir") / 2,
            "nan": F.when(F.col("gender") == "F", F.lit(float("nan"))),
            "huge": F.col("cicid") * 1e30,
            "int_limit": F.when(F.col("gender") == "F", F.lit(2147483647.0)),
            "nothing": F.lit(None).cast("double"),
        }
    )


_ODD = """odd AS (SELECT *, i94bir / 2 AS half,
  CASE WHEN gender = 'F' THEN CAST('nan' AS DOUBLE) END AS nan,
  cicid * 1e30 AS huge,
  CASE WHEN gender = 'F' THEN CAST(2147483647 AS DOUBLE) END AS int_limit,
  CAST(NULL AS DOUBLE) AS nothing FROM visits)"""


def _type_sql(column: str) -> str:
    return f"""SELECT '{column}' AS column_name,
  CASE WHEN coalesce(bool_or("{column}" IS NOT NULL AND (isnan("{column}")
         OR abs("{column}") >= 9223372036854775807 OR "{column}" <> trunc("{column}"))), false)
       THEN 'double'
       WHEN max(abs("{column}")) < 2147483647 THEN 'IntegerType'
       ELSE 'LongType' END AS proposed FROM odd"""


@query(
    f"WITH {VISITS}, {_ODD} "
    + " UNION ALL ".join(
        _type_sql(c)
        for c in (*visits.NUMBER_COLUMNS, "half", "nan", "huge", "int_limit", "nothing")
    )
)
def recommended_numeric_types(spark, sf_dir):
    return recommend_numeric_types(_with_odd_numbers(visit_records(spark, sf_dir)))


@query(f"""WITH {VISITS}
SELECT CAST(cicid AS INTEGER) AS cicid, CAST(i94yr AS INTEGER) AS i94yr,
       CAST(i94mode AS INTEGER) AS i94mode, CAST(depdate AS INTEGER) AS depdate,
       CAST(admnum AS BIGINT) AS admnum, i94bir / 2 AS half, gender
FROM visits""")
def applied_numeric_types(spark, sf_dir):
    records = visit_records(spark, sf_dir).select(
        "cicid", "i94yr", "i94mode", "depdate", "admnum",
        (F.col("i94bir") / 2).alias("half"), "gender",
    )
    return apply_numeric_types(records, recommend_numeric_types(records).collect())
