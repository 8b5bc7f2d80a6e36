"""Data-quality checks as frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlake.operators import (
    append_check_results,
    date_agreement,
    failed_checks,
    join_preserves_rows,
    key_checks,
    lake_checks,
    read_check_history,
    same_table_checks,
    sequence_completeness,
    unique_in_partition,
)
from recordlake.plans import enriched_records, visits
from recordlake.scratch import scratch_path
from recordlake.sources import roundtrip
from workload.registry import query
from workload.sql import DATED, LOOKUPS, VISITS
from workload.tables import code_tables, dated_orders, table, visit_records

_MONTHS = """months AS (
  SELECT 'i94yr=' || CAST(i94yr AS VARCHAR) || '/i94mon=' || CAST(i94mon AS VARCHAR) AS subject,
         count(*) AS n_rows, count(DISTINCT cicid) AS n_ids
  FROM visits GROUP BY i94yr, i94mon)"""


@query(f"""WITH {VISITS}, {_MONTHS}
SELECT 'column_count' AS "check", subject, CAST(28 AS BIGINT) AS observed,
       CAST(28 AS BIGINT) AS expected, true AS passed FROM months
UNION ALL SELECT 'not_empty', subject, n_rows, n_rows, true FROM months
UNION ALL SELECT 'unique_cicid', subject, n_ids, n_rows, n_ids = n_rows FROM months""")
def dq_lake(spark, sf_dir):
    return lake_checks(
        visit_records(spark, sf_dir),
        visits.PARTITION_BY,
        visits.RECORD_ID,
        visits.RAW_COLUMN_COUNT,
    )


@query(f"""WITH {DATED},
wanted AS (SELECT * FROM (VALUES ('F'), ('O'), ('X')) AS t(status)),
stats AS (
  SELECT 'status=' || coalesce(w.status, d.status, 'null') AS subject, count(d.o_custkey) AS n_rows,
         count(DISTINCT d.o_custkey) AS n_ids, count(w.status) > 0 AS listed
  FROM wanted w FULL JOIN dated d ON w.status = d.status GROUP BY 1)
SELECT 'column_count' AS "check", subject, CAST(9 AS BIGINT) AS observed,
       CAST(10 AS BIGINT) AS expected, false AS passed FROM stats
UNION ALL SELECT 'not_empty', subject, n_rows, CASE WHEN listed THEN greatest(n_rows, 1) ELSE 0 END,
       listed AND n_rows > 0 FROM stats
UNION ALL SELECT 'unique_o_custkey', subject, n_ids, n_rows, n_ids = n_rows FROM stats""")
def dq_expected_partitions(spark, sf_dir):
    """A listed status that no record has, and records whose status is not listed: NULL."""
    expected = [{"status": s} for s in ("F", "O", "X")]
    return lake_checks(dated_orders(spark, sf_dir), ["status"], "o_custkey", 10, expected)


@query(f"""WITH {DATED}
SELECT 'unique_status' AS "check", 'y=' || CAST(y AS VARCHAR) AS subject,
       count(DISTINCT status) + CASE WHEN bool_or(status IS NULL) THEN 1 ELSE 0 END AS observed,
       count(*) AS expected, observed = expected AS passed
FROM dated GROUP BY y""")
def dq_unique_in_partition(spark, sf_dir):
    return unique_in_partition(dated_orders(spark, sf_dir), ["y"], "status")


@query(f"""WITH {VISITS}, {_MONTHS}
SELECT 'rows_preserved' AS "check", subject, n_rows AS observed, n_rows AS expected,
       true AS passed FROM months""")
def dq_join_preserves_rows(spark, sf_dir):
    records = visit_records(spark, sf_dir)
    enriched = enriched_records(records, code_tables(spark, sf_dir))
    return join_preserves_rows(records, enriched, visits.PARTITION_BY)


_KEYS = f"""keys AS (
  SELECT 'i94addr' AS subject, key FROM addr UNION ALL SELECT 'i94cntyl', key FROM cntyl
  UNION ALL SELECT 'i94mode', key FROM mode UNION ALL SELECT 'i94port', key FROM port
  UNION ALL SELECT 'i94visa', key FROM visa
  UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR) FROM customer
  UNION ALL SELECT 'status', status FROM dated),
stats AS (
  SELECT subject, count(*) AS n_rows,
         count(DISTINCT key) + CASE WHEN bool_or(key IS NULL) THEN 1 ELSE 0 END AS n_values,
         count(*) - count(key) AS n_null
  FROM keys GROUP BY 1)"""


def _keyed_tables(spark, sf_dir):
    return {
        **code_tables(spark, sf_dir),
        "customer": table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")),
        "status": dated_orders(spark, sf_dir).select(F.col("status").alias("key")),
    }


@query(f"""WITH {DATED}, {LOOKUPS}, {_KEYS}
SELECT 'unique' AS "check", subject, n_values AS observed, n_rows AS expected,
       n_values = n_rows AS passed FROM stats
UNION ALL SELECT 'non_null', subject, n_null, 0, n_null = 0 FROM stats""")
def dq_unique_nonnull(spark, sf_dir):
    return key_checks(_keyed_tables(spark, sf_dir))


@query(f"""WITH {DATED}, {LOOKUPS}, {_KEYS}, checks AS (
SELECT 'unique' AS "check", subject, n_values AS observed, n_rows AS expected,
       n_values = n_rows AS passed FROM stats
UNION ALL SELECT 'non_null', subject, n_null, 0, n_null = 0 FROM stats)
SELECT run_id, checks.* FROM checks, (VALUES ('first'), ('second')) AS r(run_id)
WHERE NOT passed""")
def dq_check_history(spark, sf_dir):
    path = scratch_path(spark, "checks")
    checks = key_checks(_keyed_tables(spark, sf_dir))
    for run_id in ("first", "second"):
        append_check_results(checks, path, run_id)
    return failed_checks(read_check_history(spark, path)).drop("run_time")


@query(f"""WITH {DATED}, n AS (SELECT count(*) AS n_rows FROM dated)
SELECT 'same_column_set' AS "check", 'dated_orders' AS subject, CAST(9 AS BIGINT) AS observed,
       CAST(9 AS BIGINT) AS expected, true AS passed
UNION ALL SELECT 'same_column_order', 'dated_orders', 9, 9, true
UNION ALL SELECT 'same_column_count', 'dated_orders', 9, 9, true
UNION ALL SELECT 'same_row_count', 'dated_orders', n_rows, n_rows, true FROM n""")
def dq_roundtrip(spark, sf_dir):
    orders = dated_orders(spark, sf_dir)
    copy = roundtrip(spark, orders, scratch_path(spark, "roundtrip"))
    return same_table_checks(orders, copy, "dated_orders")


@query("""SELECT 'same_column_set' AS "check", 'lines' AS subject, CAST(2 AS BIGINT) AS observed,
       CAST(4 AS BIGINT) AS expected, false AS passed
UNION ALL SELECT 'same_column_order', 'lines', 1, 3, false
UNION ALL SELECT 'same_column_count', 'lines', 3, 3, true
UNION ALL SELECT 'same_row_count', 'lines', count(DISTINCT l_orderkey), count(*),
       count(DISTINCT l_orderkey) = count(*) FROM lineitem""")
def dq_schema_match(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    before = items.select("l_orderkey", "l_partkey", "l_suppkey")
    per_order = items.groupBy("l_orderkey").agg(
        F.max("l_tax").alias("l_tax"), F.max("l_partkey").alias("l_partkey")
    )
    return same_table_checks(before, per_order, "lines")


@query(f"""WITH {DATED}
SELECT 'date_agreement' AS "check", 'order_date' AS subject,
       count(*) FILTER (WHERE year(order_date) <> y OR month(order_date) <> m) AS observed,
       CAST(0 AS BIGINT) AS expected, observed = 0 AS passed FROM dated""")
def partition_date_agreement(spark, sf_dir):
    return date_agreement(dated_orders(spark, sf_dir), "y", "m", "order_date")


@query(f"""WITH {DATED}
SELECT 'date_agreement' AS "check", 'shipped' AS subject,
       count(*) FILTER (WHERE status IS NULL OR year(order_date + 5) <> y
                        OR month(order_date + 5) <> m) AS observed,
       CAST(0 AS BIGINT) AS expected, observed = 0 AS passed FROM dated""")
def partition_date_disagreement(spark, sf_dir):
    orders = dated_orders(spark, sf_dir)
    later = F.when(F.col("status").isNotNull(), F.date_add("order_date", 5))
    return date_agreement(orders.withColumn("shipped", later), "y", "m", "shipped")


@query(f"""WITH {VISITS}
SELECT i94yr, i94mon, min(cicid) AS min_id, max(cicid) AS max_id, count(*) AS records,
       min(cicid) = 1 AS starts_at_one, max(cicid) = count(*) AS ends_at_count
FROM visits GROUP BY 1, 2""")
def dq_sequence(spark, sf_dir):
    return sequence_completeness(
        visit_records(spark, sf_dir), visits.PARTITION_BY, visits.RECORD_ID
    )
