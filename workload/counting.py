"""Counts, duplicates, ranges and ordered first rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlake.operators import (
    date_part_counts,
    distinct_count,
    first_by_key,
    group_min_max_count,
    key_counts,
    last_by_key,
    min_max,
    non_null_count,
    presence_counts,
    records_per_key_range,
    repeat_key_records,
    repeat_keys,
    row_count,
    share_of_total,
    value_counts,
)
from recordlake.plans import query as run_sql
from recordlake.plans import register
from workload.registry import query
from workload.sql import DATED
from workload.tables import dated_orders, table


@query(f"WITH {DATED} SELECT status, count(*) AS records FROM dated GROUP BY 1")
def value_counts_with_null(spark, sf_dir):
    return value_counts(dated_orders(spark, sf_dir), "status")


@query("SELECT o_orderpriority, count(*) AS records FROM orders GROUP BY 1")
def value_counts_text(spark, sf_dir):
    return value_counts(table(spark, sf_dir, "orders"), "o_orderpriority")


@query("SELECT l_quantity, count(*) AS records FROM lineitem GROUP BY 1")
def value_counts_number(spark, sf_dir):
    return value_counts(table(spark, sf_dir, "lineitem"), "l_quantity")


@query("SELECT l_orderkey, count(*) AS records FROM lineitem GROUP BY 1")
def value_counts_unordered(spark, sf_dir):
    return value_counts(table(spark, sf_dir, "lineitem"), "l_orderkey", ordered=False)


@query(f"""WITH {DATED}
SELECT y, m, count(*) AS records FROM dated WHERE m IN (6, 7, 8) GROUP BY 1, 2""")
def month_counts(spark, sf_dir):
    orders = dated_orders(spark, sf_dir).where(F.col("m").isin(6, 7, 8))
    return key_counts(orders, ["y", "m"])


@query(f"""WITH {DATED}
SELECT y, m, count(*) AS records,
       CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100 AS percent
FROM dated GROUP BY 1, 2""")
def month_share_pct(spark, sf_dir):
    return share_of_total(dated_orders(spark, sf_dir), ["y", "m"])


@query("""SELECT l_returnflag, l_linestatus, l_linenumber, l_tax, count(*) AS records
FROM lineitem GROUP BY 1, 2, 3, 4""")
def multi_key_counts(spark, sf_dir):
    keys = ["l_returnflag", "l_linestatus", "l_linenumber", "l_tax"]
    return key_counts(table(spark, sf_dir, "lineitem"), keys)


@query(f"""WITH {DATED}
SELECT o_orderpriority, status, count(*) AS records FROM dated GROUP BY 1, 2""")
def contingency(spark, sf_dir):
    return key_counts(dated_orders(spark, sf_dir), ["o_orderpriority", "status"])


@query(f"""WITH {DATED}
SELECT o_orderpriority, CASE WHEN status IS NOT NULL THEN 'Y' ELSE 'N' END AS has_status,
       count(*) AS records
FROM dated GROUP BY 1, 2""")
def case_flag_counts(spark, sf_dir):
    return presence_counts(dated_orders(spark, sf_dir), ["o_orderpriority"], "status")


@query("""SELECT l_orderkey, l_linenumber, count(*) AS records
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dup_composite_keys(spark, sf_dir):
    return repeat_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT o_custkey, count(*) AS records FROM orders GROUP BY 1 HAVING count(*) > 1")
def dup_single_keys(spark, sf_dir):
    return repeat_keys(table(spark, sf_dir, "orders"), ["o_custkey"])


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)""")
def repeat_keys_detail(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return repeat_key_records(
        orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["o_custkey"]
    )


@query("""SELECT min(records) AS min_records, max(records) AS max_records
FROM (SELECT count(*) AS records FROM lineitem GROUP BY l_orderkey)""")
def records_per_key(spark, sf_dir):
    return records_per_key_range(table(spark, sf_dir, "lineitem"), ["l_orderkey"])


@query(f"""WITH {DATED}
SELECT y, m, min(o_orderkey) AS min_value, max(o_orderkey) AS max_value,
       count(*) AS records
FROM dated GROUP BY 1, 2""")
def group_min_max_counts(spark, sf_dir):
    return group_min_max_count(dated_orders(spark, sf_dir), ["y", "m"], "o_orderkey")


@query("SELECT min(l_shipdate) AS min_value, max(l_shipdate) AS max_value FROM lineitem")
def global_min_max(spark, sf_dir):
    return min_max(table(spark, sf_dir, "lineitem"), "l_shipdate")


@query("SELECT count(*) AS records FROM lineitem")
def global_row_count(spark, sf_dir):
    return row_count(table(spark, sf_dir, "lineitem"))


@query(f"WITH {DATED} SELECT count(*) AS records FROM dated WHERE y = 1998 AND m = 4")
def filtered_count(spark, sf_dir):
    return row_count(dated_orders(spark, sf_dir), "y = 1998 and m = 4")


@query(f"""WITH {DATED}
SELECT count(status) AS records FROM dated
WHERE o_totalprice IS NOT NULL AND abs(o_totalprice - trunc(o_totalprice)) > 0""")
def non_null_filtered_count(spark, sf_dir):
    price = F.col("o_totalprice")
    has_fraction = F.abs(price - price.try_cast("bigint")) > 0
    return non_null_count(
        dated_orders(spark, sf_dir), "status", price.isNotNull() & has_fraction
    )


@query(f"""WITH {DATED}
SELECT count(*) AS distinct_values FROM (SELECT DISTINCT status FROM dated)""")
def distinct_count_nulls(spark, sf_dir):
    return distinct_count(dated_orders(spark, sf_dir), "status")


@query(f"""WITH {DATED}
SELECT y, m, CAST(year(order_date) AS INTEGER) AS date_year,
       CAST(month(order_date) AS INTEGER) AS date_month, count(*) AS records
FROM dated GROUP BY 1, 2, 3, 4""")
def date_parts_counts(spark, sf_dir):
    return date_part_counts(dated_orders(spark, sf_dir), "order_date", ["y", "m"])


@query("""SELECT o_totalprice, o_orderkey FROM orders
ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 20""")
def top_desc(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_totalprice", "o_orderkey")
    return last_by_key(orders, ["o_totalprice", "o_orderkey"], 20)


@query(f"""WITH {DATED}
SELECT status, o_orderkey FROM dated
ORDER BY status ASC NULLS FIRST, o_orderkey ASC NULLS FIRST LIMIT 20""")
def first_n_by_key(spark, sf_dir):
    orders = dated_orders(spark, sf_dir).select("status", "o_orderkey")
    return first_by_key(orders, ["status", "o_orderkey"], 20)


@query("""SELECT o_totalprice, count(*) AS records FROM orders
GROUP BY 1 ORDER BY 1 DESC NULLS LAST LIMIT 30""")
def largest_values(spark, sf_dir):
    """The greatest values of a column with their counts, where anomalies show."""
    counts = value_counts(table(spark, sf_dir, "orders"), "o_totalprice", ordered=False)
    return last_by_key(counts, ["o_totalprice"], 30)


@query(f"""WITH {DATED}
SELECT status, o_orderpriority, min(o_totalprice) AS least, count(*) AS records
FROM dated WHERE y = 1997 GROUP BY 1, 2 HAVING count(*) > 1""")
def sql_over_a_named_view(spark, sf_dir):
    register({"dated_orders": dated_orders(spark, sf_dir)})
    return spark.sql(
        """select status, o_orderpriority, min(o_totalprice) as least, count(*) as records
           from dated_orders where y = 1997
           group by 1, 2 having records > 1 order by 1, 2"""
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
FROM lineitem WHERE l_orderkey = 5979
ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 10""")
def point_lookup(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").where(F.col("l_orderkey") == 5979)
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return first_by_key(items.select(columns), columns[1:], 10)


@query(f"""WITH {DATED}
SELECT CAST(y AS INTEGER) AS y, status, o_orderpriority, count(*) AS records
FROM dated GROUP BY 1, 2, 3""")
def sql_surface(spark, sf_dir):
    return run_sql(
        spark,
        """select cast(y as int) as y, status, o_orderpriority, count(*) as records
           from {records} group by 1, 2, 3 order by 1, 2, 3""",
        records=dated_orders(spark, sf_dir),
    )
