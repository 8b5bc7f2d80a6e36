"""Dates, keys, lookups and the enriched record."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlake.functions import (
    arrival_features,
    composite_key,
    date_to_day_number,
    day_number_to_date,
)
from recordlake.operators import (
    LookupSpec,
    date_part_counts,
    enrich_with_lookups,
    key_counts,
    split_abnormal,
    unmatched_codes,
)
from recordlake.plans import enriched_records
from workload.registry import query
from workload.sql import DATED, LOOKUPS, VISITS, enriched
from workload.tables import code_tables, dated_orders, table, visit_records


def _labelled_orders(spark, sf_dir):
    """Orders with the name of their customer's nation."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("value")
    )
    customer = table(spark, sf_dir, "customer")
    return enrich_with_lookups(
        dated_orders(spark, sf_dir),
        [
            LookupSpec("o_custkey", customer, "nation", key="c_custkey", value="c_nationkey"),
            LookupSpec("nation", nation, "label", numeric=True),
        ],
    )


@query(f"""WITH {DATED}
SELECT y, m, n_name AS label, status, count(*) AS records
FROM dated LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
WHERE m IN (6, 7, 8) GROUP BY 1, 2, 3, 4""")
def flagship_label_month_counts(spark, sf_dir):
    orders = _labelled_orders(spark, sf_dir).where(F.col("m").isin(6, 7, 8))
    return key_counts(orders, ["y", "m", "label", "status"])


@query(f"""WITH {DATED}
SELECT o_orderkey,
       DATE '1960-01-01' + CAST(days AS INTEGER) AS plain,
       DATE '1960-01-01' + CAST(trunc(-days - 0.5) AS INTEGER) AS negative,
       CASE WHEN trunc(o_totalprice * 10) <= 2936549
            THEN DATE '1960-01-01' + CAST(trunc(o_totalprice * 10) AS INTEGER) END AS large,
       CAST(NULL AS DATE) AS beyond,
       CASE WHEN status = 'F' THEN DATE '1960-01-01' + CAST(days AS INTEGER)
            WHEN status = 'O' THEN DATE '1960-01-01' END AS from_text
FROM dated""")
def epoch_days_to_date(spark, sf_dir):
    days = F.col("days")
    text = (
        F.when(F.col("status") == "F", F.concat(F.lit(" "), days.cast("int").cast("string")))
        .when(F.col("status") == "O", "null")
        .otherwise(days.cast("string"))
    )
    beyond = F.when(F.col("status") == "F", F.lit(float("nan"))).otherwise(days * 1e9)
    return dated_orders(spark, sf_dir).select(
        "o_orderkey",
        day_number_to_date(days).alias("plain"),
        day_number_to_date(-days - 0.5).alias("negative"),
        day_number_to_date(F.col("o_totalprice") * 10).alias("large"),
        day_number_to_date(beyond).alias("beyond"),
        day_number_to_date(text, text=True).alias("from_text"),
    )


@query(f"""WITH {VISITS}, replaced AS (
  SELECT DATE '1960-01-01' + CAST(arrdate AS INTEGER) AS arrdate,
         DATE '1960-01-01' + CAST(depdate AS INTEGER) AS depdate, gender
  FROM visits)
SELECT gender, CAST(year(depdate) AS INTEGER) AS date_year,
       CAST(month(depdate) AS INTEGER) AS date_month, count(*) AS records
FROM replaced GROUP BY 1, 2, 3""")
def replaced_date_columns(spark, sf_dir):
    """Day numbers replaced in place by dates, then counted by date parts."""
    records = visit_records(spark, sf_dir)
    dated = records.withColumns(
        {c: day_number_to_date(F.col(c)) for c in ("arrdate", "depdate")}
    )
    return date_part_counts(dated, "depdate", ["gender"])


@query("""SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(date_diff('day', DATE '1960-01-01', CAST(l_shipdate AS DATE)) AS INTEGER) AS ship_day
FROM lineitem""")
def date_to_epoch_days(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        date_to_day_number(F.col("l_shipdate").cast("date")).alias("ship_day"),
    )


@query(f"""WITH {DATED}
SELECT o_orderkey, CAST(week(order_date) AS INTEGER) AS arrival_week,
       CAST(dayofweek(order_date) + 1 AS INTEGER) AS arrival_day_of_week
FROM dated""")
def arrival_week_and_day(spark, sf_dir):
    orders = dated_orders(spark, sf_dir).select("o_orderkey", "order_date")
    return orders.withColumns(arrival_features(F.col("order_date"))).drop("order_date")


@query(f"""WITH {DATED}
SELECT o_orderkey,
       CAST(CAST(y AS INTEGER) AS VARCHAR) || '-' || lpad(CAST(CAST(m AS INTEGER) AS VARCHAR), 2, '0')
         || '-' || CAST(o_orderkey AS VARCHAR) AS guid,
       CASE WHEN status = 'F' THEN CAST(CAST(y AS INTEGER) AS VARCHAR) || '-12-7' END AS partial
FROM dated""")
def composite_keys(spark, sf_dir):
    month = F.when(F.col("status") == "F", 123.0)
    return dated_orders(spark, sf_dir).select(
        "o_orderkey",
        composite_key(F.col("y"), F.col("m"), F.col("o_orderkey").cast("double")).alias(
            "guid"
        ),
        composite_key(F.col("y"), month, F.lit(7.9)).alias("partial"),
    )


@query(f"""WITH {VISITS}, {LOOKUPS}
SELECT cicid, i94addr, addr.value AS i94addr_value, i94port, port.value AS i94port_value
FROM visits LEFT JOIN addr ON i94addr = addr.key LEFT JOIN port ON i94port = port.key""")
def join_string_key(spark, sf_dir):
    tables = code_tables(spark, sf_dir)
    labelled = enrich_with_lookups(
        visit_records(spark, sf_dir),
        [
            LookupSpec("i94addr", tables["i94addr"]),
            LookupSpec("i94port", tables["i94port"]),
        ],
    )
    return labelled.select("cicid", "i94addr", "i94addr_value", "i94port", "i94port_value")


@query(f"""WITH {VISITS}, {LOOKUPS}
SELECT cicid, i94cit, cntyl.value AS i94cit_value
FROM visits LEFT JOIN cntyl ON i94cit = TRY_CAST(cntyl.key AS DOUBLE)""")
def join_numeric_text_key(spark, sf_dir):
    lookup = code_tables(spark, sf_dir)["i94cntyl"]
    labelled = enrich_with_lookups(
        visit_records(spark, sf_dir), [LookupSpec("i94cit", lookup, numeric=True)]
    )
    return labelled.select("cicid", "i94cit", "i94cit_value")


@query(f"""WITH {DATED}
SELECT o_orderkey, o_custkey, status, c_nationkey AS nation, n_name AS label
FROM dated LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey""")
def large_lookup_join(spark, sf_dir):
    """The same labels when no lookup may be broadcast whole."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("value")
    )
    customer = table(spark, sf_dir, "customer")
    labelled = enrich_with_lookups(
        dated_orders(spark, sf_dir),
        [
            LookupSpec("o_custkey", customer, "nation", key="c_custkey", value="c_nationkey"),
            LookupSpec("nation", nation, "label", numeric=True),
        ],
        max_broadcast_bytes=0,
        hot_rows=12,
    )
    return labelled.select("o_orderkey", "o_custkey", "status", "nation", "label")


@query("""SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, count(*) AS records
FROM lineitem
LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
GROUP BY 1, 2""")
def role_playing_lookup(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    names = {"key": "n_nationkey", "value": "n_name"}
    labelled = enrich_with_lookups(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey"),
        [
            LookupSpec("l_orderkey", table(spark, sf_dir, "orders"), "buyer",
                       key="o_orderkey", value="o_custkey"),
            LookupSpec("buyer", table(spark, sf_dir, "customer"), "buyer_nation",
                       key="c_custkey", value="c_nationkey"),
            LookupSpec("l_suppkey", table(spark, sf_dir, "supplier"), "seller_nation",
                       key="s_suppkey", value="s_nationkey"),
            LookupSpec("buyer_nation", nation, "customer_nation", **names),
            LookupSpec("seller_nation", nation, "supplier_nation", **names),
        ],
    )
    return key_counts(labelled, ["customer_nation", "supplier_nation"])


@query(f"""WITH {VISITS}, {LOOKUPS}
SELECT i94cit, count(*) AS records FROM visits
LEFT JOIN cntyl ON i94cit = TRY_CAST(cntyl.key AS DOUBLE)
WHERE cntyl.key IS NULL AND i94cit IS NOT NULL GROUP BY 1""")
def unmatched_code_counts(spark, sf_dir):
    lookup = code_tables(spark, sf_dir)["i94cntyl"]
    return unmatched_codes(
        visit_records(spark, sf_dir), LookupSpec("i94cit", lookup, numeric=True)
    )


@query(f"WITH {enriched('DOUBLE')} SELECT * FROM enriched")
def enriched_projection(spark, sf_dir):
    return enriched_records(visit_records(spark, sf_dir), code_tables(spark, sf_dir))


@query(f"""WITH {VISITS}
SELECT cicid, i94bir, gender,
       CASE WHEN i94bir > 90 AND gender IS NULL THEN 'old,no_gender'
            WHEN i94bir > 90 THEN 'old' ELSE 'no_gender' END AS rules
FROM visits WHERE i94bir > 90 OR gender IS NULL""")
def quarantined_records(spark, sf_dir):
    rules = {"old": F.col("i94bir") > 90, "no_gender": F.col("gender").isNull()}
    _, abnormal = split_abnormal(visit_records(spark, sf_dir), rules)
    return abnormal.select(
        "cicid", "i94bir", "gender", F.concat_ws(",", "broken_rules").alias("rules")
    )


@query(f"""WITH {VISITS}
SELECT cicid, i94bir, gender FROM visits
WHERE NOT coalesce(i94bir > 90, false) AND gender IS NOT NULL""")
def clean_records(spark, sf_dir):
    rules = {"old": F.col("i94bir") > 90, "no_gender": F.col("gender").isNull()}
    clean, _ = split_abnormal(visit_records(spark, sf_dir), rules)
    return clean.select("cicid", "i94bir", "gender")
