"""Lakes: written, re-read, filtered by partition, rebuilt and queried."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from recordlake.functions import cols
from recordlake.operators import key_counts, repeat_keys
from recordlake.plans import (
    analyst,
    build_enriched_lake,
    build_raw_lake,
    enriched_lake_checks,
    ingest_files,
    raw_lake_checks,
    visits,
)
from recordlake.plans.studies import key_study, mode_port_counts, port_presence_by_mode
from recordlake.scratch import scratch_path
from recordlake.sources import (
    expand_paths,
    read_default,
    read_lake,
    read_lake_files,
    replace_partitions,
    whole_partition_values,
    write_lake,
)
from workload.registry import query
from workload.sql import VISITS, enriched
from workload.tables import code_tables, table, visit_records

_KEPT = """SELECT cicid, CAST(i94yr AS INTEGER) AS i94yr, CAST(i94mon AS INTEGER) AS i94mon,
       arrdate, visatype FROM visits"""

# Checks per month, named as the month is in a lake's directories.
_INT_MONTHS = """months AS (
  SELECT 'i94yr=' || CAST(CAST(i94yr AS INTEGER) AS VARCHAR) || '/i94mon='
           || CAST(CAST(i94mon AS INTEGER) AS VARCHAR) AS subject,
         count(*) AS n_rows, count(DISTINCT cicid) AS n_ids
  FROM visits GROUP BY i94yr, i94mon)"""


def raw_lake(spark, sf_dir) -> str:
    """Write the visit records as a lake by year and month; return its path."""
    path = scratch_path(spark, "raw")
    records = whole_partition_values(visit_records(spark, sf_dir), visits.PARTITION_BY)
    write_lake(records, path, visits.PARTITION_BY, rebalance=True)
    return path


def enriched_lake(spark, sf_dir) -> tuple[str, str]:
    """Build the enriched lake on a raw lake; return both paths."""
    raw, out = raw_lake(spark, sf_dir), scratch_path(spark, "enriched")
    build_enriched_lake(spark, raw, code_tables(spark, sf_dir), out)
    return raw, out


# Lakes that queries only read: written once per application and table folder.
_SHARED: dict[tuple, object] = {}


def shared(build, spark, sf_dir):
    """The result of ``build(spark, sf_dir)``, which is built at the first call only."""
    key = spark.conf.get("spark.app.id"), sf_dir, build.__name__
    if key not in _SHARED:
        _SHARED[key] = build(spark, sf_dir)
    return _SHARED[key]


def _kept(lake):
    return lake.select("cicid", "i94yr", "i94mon", "arrdate", "visatype")


@query(f"WITH {VISITS} {_KEPT} WHERE i94yr = 1998 AND i94mon = 4")
def partition_filter_eq(spark, sf_dir):
    lake = read_lake(spark, shared(raw_lake, spark, sf_dir))
    return _kept(lake.where("i94yr = 1998 and i94mon = 4"))


@query(f"WITH {VISITS} {_KEPT} WHERE i94yr = 1998 AND i94mon IN (6, 7, 8)")
def partition_filter_in(spark, sf_dir):
    lake = read_lake(spark, shared(raw_lake, spark, sf_dir))
    return _kept(analyst.months_of_year(lake, 1998, [6, 7, 8]))


@query(f"WITH {VISITS} {_KEPT} WHERE i94yr = 1998 AND i94mon BETWEEN 3 AND 6")
def partition_filter_between(spark, sf_dir):
    lake = read_lake(spark, shared(raw_lake, spark, sf_dir))
    return _kept(lake.where((F.col("i94yr") == 1998) & F.col("i94mon").between(3, 6)))


@query(f"WITH {VISITS} {_KEPT}")
def glob_basepath(spark, sf_dir):
    path = shared(raw_lake, spark, sf_dir)
    return _kept(read_lake_files(spark, path, "*/*/*.parquet"))


@query(f"WITH {VISITS} {_KEPT}")
def default_format_read(spark, sf_dir):
    return _kept(read_default(spark, shared(raw_lake, spark, sf_dir)))


@query(f"""WITH {VISITS}
SELECT layout, CAST(i94yr AS INTEGER) AS i94yr, CAST(i94mon AS INTEGER) AS i94mon,
       count(*) AS records
FROM visits, (VALUES ('none'), ('month'), ('year_month')) AS l(layout) GROUP BY 1, 2, 3""")
def ingest_layouts(spark, sf_dir):
    records = whole_partition_values(visit_records(spark, sf_dir), visits.PARTITION_BY)
    layouts = {"none": (), "month": ("i94mon",), "year_month": visits.PARTITION_BY}
    counted = None
    for name, partition_by in layouts.items():
        path = scratch_path(spark, f"layout-{name}")
        write_lake(records, path, partition_by, mode="append", rebalance=True)
        counts = key_counts(read_lake(spark, path), visits.PARTITION_BY, ordered=False)
        one = counts.select(F.lit(name).alias("layout"), "i94yr", "i94mon", "records")
        counted = one if counted is None else counted.unionAll(one)
    return counted


@query(f"""WITH {VISITS}, {_INT_MONTHS}
SELECT 'column_count' AS "check", subject, CAST(28 AS BIGINT) AS observed,
       CAST(28 AS BIGINT) AS expected, true AS passed FROM months
UNION ALL SELECT 'not_empty', subject, n_rows, n_rows, true FROM months
UNION ALL SELECT 'unique_cicid', subject, n_ids, n_rows, n_ids = n_rows FROM months""")
def ingest_monthly_files(spark, sf_dir):
    """Monthly files into one lake by year and month, and the lake's checks."""
    base, out = scratch_path(spark, "monthly"), scratch_path(spark, "ingested")
    records = visit_records(spark, sf_dir).withColumns(
        {
            "file_year": F.col("i94yr").cast("int"),
            "file_month": F.col("i94mon").cast("int"),
        }
    )
    write_lake(records, base, ["file_year", "file_month"], rebalance=True)
    # Calendar months of the data: a short list.
    found = records.select("file_year", "file_month").distinct().collect()
    months = {}
    for row in found:
        months.setdefault(row["file_year"], []).append(row["file_month"])
    paths = [
        path
        for year, numbers in sorted(months.items())
        for path in expand_paths(
            "{base}/file_year={yy}/file_month={mmm}",
            base=[base], yy=[year], mmm=sorted(numbers),
        )
    ]
    ingest_files(spark, paths, out, partition_by=visits.PARTITION_BY, mode="overwrite")
    expected = [{"i94yr": r["file_year"], "i94mon": r["file_month"]} for r in found]
    return raw_lake_checks(read_lake(spark, out), expected)


@query(f"""WITH {VISITS}
SELECT mode, CAST(i94yr AS INTEGER) AS i94yr, CAST(i94mon AS INTEGER) AS i94mon,
       count(*) * times AS records
FROM visits,
     (VALUES ('append', 2), ('replace_partitions', 1), ('overwrite', 1)) AS t(mode, times)
GROUP BY mode, times, i94yr, i94mon""")
def overwrite_idempotent(spark, sf_dir):
    """What two runs of one write leave behind."""
    records = whole_partition_values(visit_records(spark, sf_dir), visits.PARTITION_BY)
    counted = None
    for mode in ("append", "replace_partitions", "overwrite"):
        path = scratch_path(spark, mode)
        for _ in range(2):
            write_lake(records, path, visits.PARTITION_BY, mode, rebalance=True)
        counts = key_counts(read_lake(spark, path), visits.PARTITION_BY, ordered=False)
        one = counts.select(F.lit(mode).alias("mode"), "i94yr", "i94mon", "records")
        counted = one if counted is None else counted.unionAll(one)
    return counted


@query(f"""WITH {VISITS}
SELECT CAST(i94yr AS INTEGER) AS i94yr, CAST(i94mon AS INTEGER) AS i94mon,
       count(*) * max(CASE WHEN i94yr = 1998 AND i94mon = 1 THEN 2 ELSE 1 END) AS records
FROM visits WHERE NOT (i94yr = 1998 AND i94mon = 2) GROUP BY i94yr, i94mon""")
def replaced_partitions(spark, sf_dir):
    """Replace two months: one gets twice the rows, the other none."""
    path = raw_lake(spark, sf_dir)
    records = whole_partition_values(visit_records(spark, sf_dir), visits.PARTITION_BY)
    january = records.where("i94yr = 1998 and i94mon = 1")
    months = [{"i94yr": 1998, "i94mon": 1}, {"i94yr": 1998, "i94mon": 2}]
    replace_partitions(january.unionAll(january), path, months)
    return key_counts(read_lake(spark, path), visits.PARTITION_BY)


@query(f"""WITH {VISITS}
SELECT CAST(i94yr AS INTEGER) AS i94yr, CAST(i94mon AS INTEGER) AS i94mon, count(*) AS records,
       true AS refused
FROM visits GROUP BY i94yr, i94mon""")
def second_write_refused(spark, sf_dir):
    """By default a write to a lake that exists fails and leaves it as it is."""
    path = raw_lake(spark, sf_dir)
    records = whole_partition_values(visit_records(spark, sf_dir), visits.PARTITION_BY)
    try:
        write_lake(records, path, visits.PARTITION_BY)
        refused = False
    except AnalysisException as error:
        refused = error.getCondition() == "PATH_ALREADY_EXISTS"
    counts = key_counts(read_lake(spark, path), visits.PARTITION_BY, ordered=False)
    return counts.withColumn("refused", F.lit(refused))


@query(f"""WITH {VISITS}
SELECT CAST(i94yr AS INTEGER) AS i94yr, CAST(i94mon AS INTEGER) AS i94mon, count(*) AS records,
       count(CASE WHEN i94mon % 2 = 1 THEN visatype END) AS with_extra_column
FROM visits GROUP BY i94yr, i94mon""")
def ingest_uneven_files(spark, sf_dir):
    """Files of odd months have a column more, which the lake keeps."""
    records, paths = visit_records(spark, sf_dir), []
    for odd in (0, 1):
        part = records.where(F.col("i94mon") % 2 == odd)
        paths.append(scratch_path(spark, "uneven"))
        write_lake(part.withColumn("validres", F.col("visatype")) if odd else part, paths[-1])
    out = scratch_path(spark, "ingested")
    ingest_files(spark, paths, out, partition_by=visits.PARTITION_BY)
    return read_lake(spark, out).groupBy(*visits.PARTITION_BY).agg(
        F.count("*").alias("records"), F.count("validres").alias("with_extra_column")
    )


def months_of_all_years(records) -> dict:
    """The records of each month by its name, all years taken as 2016.

    The records are derived once and stored by month: a month is read from its directory.
    """
    spark, path = records.sparkSession, scratch_path(records.sparkSession, "by-month")
    records = records.withColumn("i94yr", F.lit(2016.0))
    keyed = records.withColumn("file_month", F.col("i94mon").cast("int"))
    write_lake(keyed, path, ["file_month"])
    stored = spark.read.schema(keyed.schema).parquet(path)
    return {
        name: stored.where(F.col("file_month") == number).drop("file_month")
        for number, name in enumerate(visits.MONTH_NAMES, start=1)
    }


@query(f"""WITH {VISITS}
SELECT CAST(2016 AS INTEGER) AS i94yr, CAST(i94mon AS INTEGER) AS i94mon,
       count(*) * CASE WHEN i94mon = 2 THEN 2 ELSE 1 END AS records
FROM visits GROUP BY i94mon""")
def rebuild_one_month(spark, sf_dir):
    """Twelve monthly files, all years taken as one; then February alone, with its rows twice."""
    base, out = scratch_path(spark, "monthly"), scratch_path(spark, "ingested")
    months = months_of_all_years(visit_records(spark, sf_dir))
    for name, month in months.items():
        month.write.parquet(f"{base}/i94_{name}16_sub.parquet")
    build_raw_lake(spark, base, out, ["16"])
    months["feb"].write.mode("append").parquet(f"{base}/i94_feb16_sub.parquet")
    build_raw_lake(spark, base, out, ["16"], ["feb"])
    return key_counts(read_lake(spark, out), visits.PARTITION_BY)


@query(f"WITH {enriched()} SELECT * FROM enriched")
def ingest_csv_files(spark, sf_dir):
    """CSV with a header, its columns in source order, into the raw and the enriched lake."""
    csv, raw = scratch_path(spark, "csv"), scratch_path(spark, "ingested")
    names = [name for name, _ in visits.RAW_COLUMNS]
    visit_records(spark, sf_dir).select(*cols(names)).write.csv(csv, header=True)
    ingest_files(
        spark, [csv], raw, "csv", visits.PARTITION_BY,
        options={"header": True}, schema=visits.raw_schema(), rebalance=True,
    )
    out = scratch_path(spark, "enriched")
    build_enriched_lake(spark, raw, code_tables(spark, sf_dir), out)
    return read_lake(spark, out).select(*cols(visits.ENRICHED_COLUMNS))


_NARROW = ", ".join(
    f"CAST({c} AS {'BIGINT' if c == 'admnum' else 'INTEGER'}) AS {c}"
    for c in visits.ENRICHED_COLUMNS
    if c in visits.NUMBER_COLUMNS and c not in visits.PARTITION_BY
)


@query(f"WITH {enriched()} SELECT * REPLACE ({_NARROW}) FROM enriched")
def enriched_lake_narrow(spark, sf_dir):
    """The enriched lake with whole numbers stored as such, two months of it built again."""
    raw, out = shared(raw_lake, spark, sf_dir), scratch_path(spark, "enriched")
    tables = code_tables(spark, sf_dir)
    build_enriched_lake(spark, raw, tables, out, narrow=True)
    months = [{"i94yr": 1998, "i94mon": m} for m in (6, 7)]
    build_enriched_lake(spark, raw, tables, out, partitions=months, narrow=True)
    return read_lake(spark, out).select(*cols(visits.ENRICHED_COLUMNS))


@query(f"WITH {enriched()} SELECT * FROM enriched")
def enriched_lake_build(spark, sf_dir):
    _, out = enriched_lake(spark, sf_dir)
    return read_lake(spark, out).select(*cols(visits.ENRICHED_COLUMNS))


@query(f"WITH {enriched()} SELECT * FROM enriched")
def enriched_lake_rebuild(spark, sf_dir):
    """Some months built again: the lake stays as it was."""
    raw, out = enriched_lake(spark, sf_dir)
    months = [{"i94yr": 1998, "i94mon": m} for m in (6, 7)]
    build_enriched_lake(spark, raw, code_tables(spark, sf_dir), out, partitions=months)
    return read_lake(spark, out).select(*cols(visits.ENRICHED_COLUMNS))


@query(f"""WITH {VISITS}, {_INT_MONTHS}
SELECT 'rows_preserved' AS "check", subject, n_rows AS observed, n_rows AS expected,
       true AS passed FROM months
UNION ALL SELECT 'unique_cicid', subject, n_ids, n_rows, n_ids = n_rows FROM months""")
def enriched_lake_check_rows(spark, sf_dir):
    raw, out = shared(enriched_lake, spark, sf_dir)
    return enriched_lake_checks(read_lake(spark, raw), read_lake(spark, out))


def _summer(spark, sf_dir):
    _, out = shared(enriched_lake, spark, sf_dir)
    return analyst.months_of_year(read_lake(spark, out), 1998, [6, 7, 8])


_SUMMER = "FROM enriched WHERE i94yr = 1998 AND i94mon IN (6, 7, 8)"


@query(f"""WITH {enriched()}
SELECT i94yr, i94mon, i94visa_value, visatype, count(*) AS records
{_SUMMER} GROUP BY 1, 2, 3, 4""")
def analyst_label_type_counts(spark, sf_dir):
    return analyst.label_type_counts(_summer(spark, sf_dir))


@query(f"WITH {enriched()} SELECT i94yr, i94mon, count(*) AS records {_SUMMER} GROUP BY 1, 2")
def analyst_month_counts(spark, sf_dir):
    return analyst.month_counts(_summer(spark, sf_dir))


@query(f"""WITH {enriched()}
SELECT i94yr, i94mon, i94visa_value, count(*) AS records {_SUMMER} GROUP BY 1, 2, 3""")
def analyst_label_counts(spark, sf_dir):
    return analyst.label_counts(_summer(spark, sf_dir))


@query(f"""WITH {enriched()}
SELECT i94yr, i94mon, visatype, count(*) AS records {_SUMMER} GROUP BY 1, 2, 3""")
def analyst_type_counts(spark, sf_dir):
    return analyst.type_counts(_summer(spark, sf_dir))


@query(f"""WITH {VISITS}
SELECT CAST(i94yr AS INTEGER) AS i94yr, CAST(i94mon AS INTEGER) AS i94mon, count(*) AS records,
       CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100 AS percent
FROM visits GROUP BY 1, 2""")
def analyst_month_shares(spark, sf_dir):
    return analyst.month_shares(read_lake(spark, shared(raw_lake, spark, sf_dir)))


_LINES = "SELECT CAST(l_orderkey AS DOUBLE) AS id, l_returnflag AS flag FROM lineitem"


@query(f"""WITH lines AS ({_LINES}),
repeated AS (SELECT id FROM lines GROUP BY 1 HAVING count(*) > 1)
SELECT 'repeated_in_partition' AS answer, count(*) AS records
FROM (SELECT id FROM lines GROUP BY id, flag HAVING count(*) > 1)
UNION ALL SELECT 'repeated', count(*) FROM repeated
UNION ALL SELECT 'repeated_records', count(*) FROM lines WHERE id IN (SELECT id FROM repeated)
UNION ALL SELECT 'most_records', max(n) FROM (SELECT count(*) AS n FROM lines GROUP BY id)
UNION ALL SELECT 'full_sequences', count(*) FROM (
  SELECT flag FROM lines GROUP BY 1 HAVING min(id) = 1 AND max(id) = count(*))""")
def key_uniqueness_study(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("double").alias("id"), F.col("l_returnflag").alias("flag")
    )
    study = key_study(lines, "id", ["flag"])
    full = study.sequences.where("starts_at_one and ends_at_count")
    answers = {
        "repeated_in_partition": study.repeated_in_partition.agg(F.count("*")),
        "repeated": study.repeated.agg(F.count("*")),
        "repeated_records": study.repeated_records.agg(F.count("*")),
        "most_records": study.records_per_id.select("max_records"),
        "full_sequences": full.agg(F.count("*")),
    }
    rows = None
    for name, frame in answers.items():
        one = frame.toDF("records").select(F.lit(name).alias("answer"), "records")
        rows = one if rows is None else rows.unionAll(one)
    return rows


@query(f"""WITH {VISITS}
SELECT i94mode, CASE WHEN i94addr IS NOT NULL THEN 'Y' ELSE 'N' END AS has_i94addr,
       count(*) AS records FROM visits GROUP BY 1, 2""")
def mode_address_presence(spark, sf_dir):
    return port_presence_by_mode(visit_records(spark, sf_dir), port="i94addr")


@query(f"""WITH {VISITS}
SELECT i94mode, i94port, count(*) AS records FROM visits GROUP BY 1, 2""")
def mode_port_contingency(spark, sf_dir):
    return mode_port_counts(visit_records(spark, sf_dir))


@query(f"""WITH {enriched()}
SELECT guid, 2 * count(*) AS records FROM enriched WHERE i94mon IN (6, 7) GROUP BY 1""")
def enriched_guid_repeats(spark, sf_dir):
    """The records of two months of every year were ingested twice."""
    raw, out = raw_lake(spark, sf_dir), scratch_path(spark, "enriched")
    again = whole_partition_values(visit_records(spark, sf_dir), visits.PARTITION_BY)
    again = again.where("i94mon in (6, 7)")
    write_lake(again, raw, visits.PARTITION_BY, "append", rebalance=True)
    build_enriched_lake(spark, raw, code_tables(spark, sf_dir), out)
    return repeat_keys(read_lake(spark, out), ["guid"])
