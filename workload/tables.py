"""Visit records and code tables, derived from the test tables.

Each order stands for one visit record with all 28 raw columns; nations, customer
segments, order states and priorities are its coded attributes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.functions import cols, date_to_day_number
from recordlake.operators import LookupSpec, enrich_with_lookups
from recordlake.plans import read_code_tables, visits
from recordlake.scratch import scratch_path
from recordlake.sources import write_csv_tables

# Plain-text names of the code tables, as sections of a format text.
LOOKUP_NAMES = ("i94addr", "i94cntyl", "i94mode", "i94port", "i94visa")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with year, month and day number as doubles, and a state that may be NULL."""
    date = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        "o_orderpriority",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.year(date).cast("double").alias("y"),
        F.month(date).cast("double").alias("m"),
        date.alias("order_date"),
        date_to_day_number(date).cast("double").alias("days"),
    )


def visit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw visit record per order: 28 columns, numbers as doubles.

    The customer gives the nation and the segment of a record, in one lookup join
    that copes with a customer table of any size.
    """
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"),
        F.struct("c_nationkey", "c_mktsegment").alias("value"),
    )
    orders = enrich_with_lookups(
        table(spark, sf_dir, "orders"), [LookupSpec("o_custkey", customer, "buyer")]
    )
    date = F.col("o_orderdate").cast("date")
    day = date_to_day_number(date)
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    urgency = F.substring(priority, 1, 1)
    open_order = status == "O"
    numbers = {
        "cicid": F.col("o_orderkey"),
        "i94yr": F.year(date),
        "i94mon": F.month(date),
        "i94cit": F.col("buyer.c_nationkey"),
        "i94res": F.pmod("o_custkey", F.lit(30)),
        "arrdate": day,
        "i94mode": F.nullif(urgency, F.lit("5")),
        "depdate": F.when(~open_order, day + F.length(priority)),
        "i94bir": F.floor(F.col("o_totalprice") / 5000),
        "i94visa": F.when(status == "F", 1).when(open_order, 2).otherwise(3),
        "count": F.lit(1),
        "biryear": F.year(date) - F.floor(F.col("o_totalprice") / 5000),
        "admnum": F.round(F.col("o_totalprice") * 100) * 1000,
    }
    texts = {
        "i94port": F.substring("buyer.c_mktsegment", 1, 3),
        "i94addr": F.nullif(F.substring(priority, 3, 2), F.lit("LO")),
        "dtadfile": F.date_format(date, "yyyyMMdd"),
        "visapost": F.substring("buyer.c_mktsegment", 1, 3),
        "occup": F.lit(None),
        "entdepa": status,
        "entdepd": F.nullif(status, F.lit("O")),
        "entdepu": F.lit(None),
        "matflag": F.when(~open_order, "M"),
        "dtaddto": F.date_format(F.date_add(date, 180), "MMddyyyy"),
        "gender": F.when(status == "F", "F").when(status == "P", "M"),
        "insnum": F.lit(None),
        "airline": F.substring("buyer.c_mktsegment", 1, 2),
        "fltno": F.lpad(F.col("o_custkey").cast("string"), 5, "0"),
        "visatype": F.concat(status, urgency),
    }
    return orders.select(
        *[numbers[c].cast("double").alias(c) for c in visits.NUMBER_COLUMNS],
        *[texts[c].cast("string").alias(c) for c in visits.TEXT_COLUMNS],
    )


def code_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five lookups as stored CSV: derived once, read as often as needed."""
    path = scratch_path(spark, "lookups")
    derived = [
        pairs.select(F.lit(name).alias("lookup"), "key", "value")
        for name, pairs in derived_code_tables(spark, sf_dir).items()
    ]
    write_csv_tables(reduce(DataFrame.unionAll, derived), path, "lookup")
    return read_code_tables(spark, path, LOOKUP_NAMES)


def derived_code_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Five ``key, value`` lookups. Some codes of the records have no label, and
    one nation has a key that is no number."""
    nation = table(spark, sf_dir, "nation")
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    priority = F.col("o_orderpriority")
    key = F.col("n_nationkey").cast("string")
    pairs = {
        "i94addr": orders.select(F.substring(priority, 3, 2), F.substring(priority, 3, 99))
        .where(F.substring(priority, 1, 1) != "2")
        .distinct(),
        "i94cntyl": nation.where("n_regionkey <> 2").select(
            F.when(F.col("n_nationkey") == 24, F.concat(key, F.lit("x"))).otherwise(key),
            F.col("n_name"),
        ),
        "i94mode": orders.select(F.substring(priority, 1, 1), F.substring(priority, 3, 99))
        .where(F.substring(priority, 1, 1) != "3")
        .distinct(),
        "i94port": customer.select(
            F.substring("c_mktsegment", 1, 3), F.col("c_mktsegment")
        ).distinct(),
        "i94visa": orders.select(
            F.when(F.col("o_orderstatus") == "F", "1")
            .when(F.col("o_orderstatus") == "O", "2")
            .otherwise("3"),
            F.concat(F.lit("STATE "), F.col("o_orderstatus")),
        ).distinct(),
    }
    return {name: pairs[name].toDF("key", "value") for name in LOOKUP_NAMES}


def write_code_text(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the code tables as one format text with the sections' own layouts.

    A single file on purpose: a handful of codes, whose lines need an order.
    """
    ends = {s.name: s for s in visits.CODE_TABLES}
    parts = None
    for i, (name, pairs) in enumerate(derived_code_tables(spark, sf_dir).items()):
        body = pairs.select(
            F.lit(i).alias("section"),
            F.lit(1).alias("part"),
            "key",
            F.format_string(" '%s' \t=\t'%s   ' ", "key", "value").alias("line"),
        )
        frame = spark.range(1).select(
            F.lit(i).alias("section"),
            F.inline(
                F.array(
                    F.struct(F.lit(0), F.lit(""), F.lit(ends[name].start)),
                    F.struct(F.lit(2), F.lit(""), F.lit(ends[name].end)),
                    F.struct(F.lit(3), F.lit(""), F.lit("/* no code here */")),
                )
            ).alias("part", "key", "line"),
        )
        part = body.unionByName(frame)
        parts = part if parts is None else parts.unionAll(part)
    ordered = parts.coalesce(1).sortWithinPartitions("section", "part", "key")
    ordered.select("line").write.option("lineSep", "\r\n").text(path)


CODES_PER_FILE = 5000


def write_customer_text(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the customers as format texts with two sections each.

    Every file holds up to 5,000 customers, so the files grow in number with the
    table and not in size.
    """
    file_no = F.floor(F.col("c_custkey") / CODES_PER_FILE)
    customer = table(spark, sf_dir, "customer").withColumn("file_no", file_no)
    names = customer.select(
        "file_no",
        F.lit(1).alias("part"),
        F.col("c_custkey").alias("n"),
        F.format_string("\t'%s' = '%s ' ", F.col("c_custkey"), "c_name").alias("line"),
    )
    segments = customer.select(
        "file_no",
        F.lit(4),
        F.col("c_custkey"),
        F.format_string("  %s=%s", F.col("c_custkey"), "c_mktsegment"),
    )
    frame = customer.select("file_no").distinct().select(
        "file_no",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(part), F.lit(0).cast("bigint"), F.lit(line))
                    for part, line in (
                        (0, "value custname"),
                        (2, ";"),
                        (3, "value custsegment"),
                        (5, ""),
                        (6, "/* a = b, outside */"),
                    )
                ]
            )
        ),
    )
    lines = names.unionAll(segments).unionAll(frame)
    (
        lines.repartition(*cols(["file_no"]))
        .sortWithinPartitions("file_no", "part", "n")
        .select("file_no", "line")
        .write.partitionBy("file_no")
        .text(path)
    )
