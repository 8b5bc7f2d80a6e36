"""Upkeep of lakes: manifests, backfills, uneven files, anomalies, sketches, runs compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlake.functions import cols
from recordlake.operators import (
    append_check_results,
    compare_check_runs,
    distinct_sketches,
    group_quantiles,
    key_checks,
    label_anomalies,
    merged_distinct_counts,
    profile_value_counts,
    rank_errors,
    read_abnormal,
    read_check_history,
    read_clean,
    read_sketches,
    store_sketches,
    write_judged,
)
from recordlake.operators.quality import distinct_with_null
from recordlake.plans import (
    CARRIED_COLUMNS,
    build_enriched_lake,
    build_raw_lake,
    enriched_backfill_plan,
    heal_enriched_lake,
    ingest_files,
    visits,
)
from recordlake.scratch import scratch_path
from recordlake.sources import read_lake, read_manifest, replace_partitions, write_lake
from workload.lakes import months_of_all_years, raw_lake, shared
from workload.profiles import _PROFILED, profile_sql
from workload.registry import query
from workload.sql import DATED, VISITS, enriched
from workload.tables import code_tables, dated_orders, table, visit_records


def _monthly_files(spark, sf_dir) -> str:
    """Twelve monthly files, all years taken as one; that of May has no ``occup`` column."""
    base = scratch_path(spark, "monthly")
    for name, month in months_of_all_years(visit_records(spark, sf_dir)).items():
        if name == "may":
            month = month.drop("occup")
        month.write.parquet(f"{base}/i94_{name}16_sub.parquet")
    return base


@query(f"""WITH {VISITS}, months AS (
  SELECT 'i94yr=2016/i94mon=' || CAST(CAST(i94mon AS INTEGER) AS VARCHAR) AS subject,
         CAST(CASE WHEN i94mon = 5 THEN 27 ELSE 28 END AS BIGINT) AS n_columns,
         count(*) AS n_rows, count(DISTINCT cicid) AS n_ids
  FROM visits GROUP BY i94mon)
SELECT 'column_count' AS "check", subject, n_columns AS observed, CAST(28 AS BIGINT) AS expected,
       n_columns = 28 AS passed FROM months
UNION ALL SELECT 'not_empty', subject, n_rows, n_rows, true FROM months
UNION ALL SELECT 'unique_cicid', subject, n_ids, n_rows, n_ids = n_rows FROM months""")
def manifest_column_count(spark, sf_dir):
    """One of twelve files lacks a column: its month fails, and no other."""
    out = scratch_path(spark, "ingested")
    return build_raw_lake(spark, _monthly_files(spark, sf_dir), out, ["16"])


@query(f"""WITH {VISITS}
SELECT CAST(2016 AS INTEGER) AS i94yr, CAST(i94mon AS INTEGER) AS i94mon,
       CASE WHEN i94mon = 5 THEN 27 ELSE 28 END AS n_columns,
       count(*) * CASE WHEN i94mon = 2 THEN 2 ELSE 1 END AS records
FROM visits GROUP BY i94mon""")
def manifest_after_a_rebuild(spark, sf_dir):
    """February comes again with its rows twice: its part of the manifest is replaced."""
    base, out = _monthly_files(spark, sf_dir), scratch_path(spark, "ingested")
    build_raw_lake(spark, base, out, ["16"])
    february = f"{base}/i94_feb16_sub.parquet"
    again = spark.read.parquet(february)
    again.unionAll(again).write.parquet(f"{base}/twice")
    again = spark.read.parquet(f"{base}/twice")
    again.write.mode("overwrite").parquet(february)
    build_raw_lake(spark, base, out, ["16"], ["feb"])
    return read_manifest(spark, out).groupBy(*visits.PARTITION_BY, "n_columns").agg(
        F.sum("records").alias("records")
    )


@query(f"""WITH {VISITS}
SELECT CAST(i94yr AS INTEGER) AS i94yr, CAST(i94mon AS INTEGER) AS i94mon, count(*) AS records,
       CAST(sum(cicid) AS DOUBLE) AS ids, count(CASE WHEN i94mon % 2 = 1 THEN gender END) AS with_gender,
       min(fltno) AS first_flight
FROM visits GROUP BY 1, 2""")
def ingest_csv_by_header(spark, sf_dir):
    """Many CSV files with two headers: another order of columns, and one column less."""
    records, paths = visit_records(spark, sf_dir), []
    names = [name for name, _ in visits.RAW_COLUMNS]
    for odd in (0, 1):
        order = names if odd else [n for n in reversed(names) if n != "gender"]
        paths.append(scratch_path(spark, "csv"))
        part = records.where(F.col("i94mon") % 2 == odd).select(*cols(order))
        part.repartition(12, "i94yr").write.csv(paths[-1], header=True)
    out = scratch_path(spark, "ingested")
    ingest_files(
        spark, paths, out, "csv", visits.PARTITION_BY, options={"header": True},
        schema=visits.raw_schema(), rebalance=True, manifest=True,
    )
    return read_lake(spark, out).groupBy(*visits.PARTITION_BY).agg(
        F.count("*").alias("records"), F.sum("cicid").alias("ids"),
        F.count("gender").alias("with_gender"), F.min("fltno").alias("first_flight"),
    )


def damaged_lake(spark, sf_dir) -> tuple[str, str]:
    """A raw lake, and an enriched one in which some months of 1998 and one of 1990 are wrong."""
    raw, out = shared(raw_lake, spark, sf_dir), scratch_path(spark, "damaged")
    build_enriched_lake(spark, raw, code_tables(spark, sf_dir), out)
    kept = scratch_path(spark, "kept")
    months = read_lake(spark, out).where("i94yr = 1998 and i94mon between 2 and 6")
    write_lake(months, kept, visits.PARTITION_BY)
    lake = spark.read.schema(months.schema).parquet(kept)

    def replace(year, month, rows):
        one = {"i94yr": year, "i94mon": month}
        replace_partitions(rows.withColumns({k: F.lit(v) for k, v in one.items()}), out, [one])

    months = {m: lake.where(f"i94yr = 1998 and i94mon = {m}") for m in (2, 3, 4, 5, 6)}
    replace(1998, 2, months[2].where("false"))
    replace(1998, 3, months[3].where("cicid % 2 = 0"))
    replace(1998, 4, months[4].withColumn("cicid", F.col("cicid") + 0.5))
    replace(1998, 5, months[5].unionAll(months[5]))
    replace(1998, 6, months[6].withColumn("visatype", F.lit("?")))
    replace(1990, 1, months[6])
    return raw, out


_DAMAGED = f"""{VISITS}, months AS (
  SELECT CAST(i94yr AS INTEGER) AS i94yr, CAST(i94mon AS INTEGER) AS i94mon, count(*) AS source_records,
         CASE WHEN i94yr <> 1998 THEN count(*) WHEN i94mon = 2 THEN 0
              WHEN i94mon = 3 THEN count(*) FILTER (WHERE cicid % 2 = 0)
              WHEN i94mon = 5 THEN 2 * count(*) ELSE count(*) END AS derived_records
  FROM visits GROUP BY visits.i94yr, visits.i94mon
  UNION ALL SELECT 1990, 1, 0, count(*) FROM visits WHERE i94yr = 1998 AND i94mon = 6),
counted AS (SELECT *,
  CASE WHEN source_records = 0 THEN 'orphaned' WHEN derived_records = 0 THEN 'missing'
       WHEN derived_records < source_records THEN 'short'
       WHEN derived_records > source_records THEN 'surplus'
       WHEN i94yr = 1998 AND i94mon IN ({{stale}}) THEN 'stale' ELSE 'complete' END AS state FROM months)
SELECT * FROM counted WHERE source_records + derived_records > 0"""


@query("WITH " + _DAMAGED.format(stale="4"))
def backfill_states(spark, sf_dir):
    """Which months an enriched lake has to build again, told by counts and ids."""
    return enriched_backfill_plan(spark, *damaged_lake(spark, sf_dir))


@query("WITH " + _DAMAGED.format(stale="4, 6"))
def backfill_states_by_values(spark, sf_dir):
    """The same by all values that both lakes hold: a changed visa type is found too."""
    return enriched_backfill_plan(spark, *damaged_lake(spark, sf_dir), CARRIED_COLUMNS)


@query(f"WITH {enriched()} SELECT * FROM enriched")
def backfilled_enriched_lake(spark, sf_dir):
    """After the backfill the lake is as it was, and nothing is left to be done."""
    raw, out = damaged_lake(spark, sf_dir)
    tables = code_tables(spark, sf_dir)
    healed = heal_enriched_lake(spark, raw, tables, out, columns=CARRIED_COLUMNS)
    again = heal_enriched_lake(spark, raw, tables, out, columns=CARRIED_COLUMNS)
    if not healed or again:
        raise AssertionError(f"healed {healed}, then {again}")
    return read_lake(spark, out).select(*cols(visits.ENRICHED_COLUMNS))


@query(
    f"WITH {DATED} "
    + " UNION ALL ".join(
        f"SELECT * REPLACE (CAST(position AS BIGINT) AS position) FROM ({profile_sql('dated', c, 1 << 31)})"
        for c in _PROFILED
    )
)
def profile_every_value(spark, sf_dir):
    """All values of all columns: no first n, and no column in one task."""
    return profile_value_counts(dated_orders(spark, sf_dir))


@query(f"""WITH {VISITS},
middle AS (SELECT gender, median(i94bir) AS med FROM visits WHERE i94bir IS NOT NULL GROUP BY 1),
spread AS (
  SELECT m.gender, med, median(abs(i94bir - med)) AS median_off, avg(abs(i94bir - med)) AS mean_off
  FROM visits v JOIN middle m ON v.gender IS NOT DISTINCT FROM m.gender GROUP BY 1, 2),
far AS (
  SELECT cicid, v.gender, i94bir, med AS median,
         (i94bir - med) / (CASE WHEN median_off > 0 THEN CAST(1.4826 AS DOUBLE) * median_off
                                ELSE CAST(1.2533 AS DOUBLE) * mean_off END) AS distance
  FROM visits v JOIN spread s ON v.gender IS NOT DISTINCT FROM s.gender)
SELECT *, CASE WHEN distance > 1.2 THEN 'high' WHEN distance < -1.2 THEN 'low' ELSE 'none' END AS anomaly
FROM far""")
def labelled_anomalies(spark, sf_dir):
    """Every value judged by the exact median and spread of its group, NULL being a group."""
    records = visit_records(spark, sf_dir).select("cicid", "gender", "i94bir")
    return label_anomalies(records, "i94bir", ["gender"], limit=1.2, exact=True)


_PROBABILITIES = (0.01, 0.25, 0.5, 0.75, 0.99)


@query(f"""WITH {DATED}, asked AS (SELECT unnest([{", ".join(map(str, _PROBABILITIES))}]) AS p)
SELECT status, CAST(p AS DOUBLE) AS probability, count(*) AS records, true AS within_bound
FROM dated, asked GROUP BY 1, 2""")
def sketched_quantiles(spark, sf_dir):
    """Quantiles out of small sketches, and whether their ranks keep the stated bound."""
    orders = dated_orders(spark, sf_dir)
    found = group_quantiles(orders, "o_totalprice", ["status"], _PROBABILITIES, accuracy=50)
    errors = rank_errors(orders, found, "o_totalprice", ["status"])
    within = F.col("rank_error") <= F.col("records") / 50 + 1
    return errors.select("status", "probability", "records", within.alias("within_bound"))


_SKETCHED = ("cicid", "fltno", "gender", "occup")


@query(f"""WITH {VISITS} """ + " UNION ALL ".join(
    f"""SELECT CAST(i94yr AS INTEGER) AS i94yr, '{c}' AS column_name, count(*) AS records,
  count(DISTINCT {c}) + CASE WHEN bool_or({c} IS NULL) THEN 1 ELSE 0 END AS exact, true AS within_bound
FROM visits GROUP BY visits.i94yr"""
    for c in _SKETCHED
))
def sketched_distinct_counts(spark, sf_dir):
    """A year's distinct values out of the stored sketches of its months, beside the exact way."""
    records, path = visit_records(spark, sf_dir), scratch_path(spark, "sketches")
    records = records.withColumns({c: F.col(c).cast("int") for c in visits.PARTITION_BY})
    store_sketches(distinct_sketches(records, visits.PARTITION_BY, _SKETCHED), path, visits.PARTITION_BY)
    counts = merged_distinct_counts(read_sketches(spark, path), ["i94yr"])
    exact = records.groupBy("i94yr").agg(*[distinct_with_null(F.col(c)).alias(c) for c in _SKETCHED])
    exact = exact.unpivot(["i94yr"], list(_SKETCHED), "column_name", "exact")
    within = F.col("exact").between(F.col("at_least"), F.col("at_most"))
    return counts.join(exact, ["i94yr", "column_name"]).select(
        "i94yr", "column_name", "records", "exact", within.alias("within_bound")
    )


@query(f"""WITH {DATED},
runs AS (SELECT * FROM (VALUES ('first', DATE '2016-01-01', 1), ('late', DATE '2016-01-02', 2),
                               ('last', DATE '2016-01-03', 1)) AS r(run_id, day, copies)),
stats AS (
  SELECT 'customer' AS subject, copies, count(*) * copies AS n_rows, count(DISTINCT c_custkey) AS n_values,
         0 AS n_null FROM customer, (VALUES (1), (2)) AS c(copies) GROUP BY copies
  UNION ALL
  SELECT 'status', copies, count(*) * copies, count(DISTINCT status) + max(CASE WHEN status IS NULL THEN 1 ELSE 0 END),
         (count(*) - count(status)) * copies FROM dated, (VALUES (1), (2)) AS c(copies) GROUP BY copies),
checks AS (
  SELECT run_id, day, 'unique' AS "check", subject, n_values AS observed, n_rows AS expected
  FROM runs JOIN stats USING (copies)
  UNION ALL SELECT run_id, day, 'non_null', subject, n_null, 0 FROM runs JOIN stats USING (copies)),
beside AS (
  SELECT *, observed = expected AS passed, lag(run_id) OVER w AS previous_run,
         observed - lag(observed) OVER w AS change, lag(observed = expected) OVER w AS passed_before,
         count(*) FILTER (WHERE observed = expected) OVER w AS passes
  FROM checks WINDOW w AS (PARTITION BY "check", subject ORDER BY day)),
since AS (
  SELECT *, min(CASE WHEN NOT passed THEN day END) OVER (PARTITION BY "check", subject, passes) AS first_day
  FROM beside)
SELECT run_id, "check", subject, CAST(observed AS BIGINT) AS observed, previous_run,
       CAST(change AS BIGINT) AS change,
       CASE WHEN passed AND passed_before = false THEN 'recovered' WHEN passed THEN 'passed'
            WHEN passed_before = false THEN 'still failing' ELSE 'failed' END AS status,
       CASE WHEN NOT passed THEN first_day END AS failing_since
FROM since""")
def dq_runs_compared(spark, sf_dir):
    """Three runs, the second of which is appended last and finds every record twice."""
    path = scratch_path(spark, "checks")
    tables = {
        "customer": table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")),
        "status": dated_orders(spark, sf_dir).select(F.col("status").alias("key")),
    }
    twice = {name: df.unionAll(df) for name, df in tables.items()}
    for run_id, day, checked in (("first", 1, tables), ("last", 3, tables), ("late", 2, twice)):
        when = F.lit(f"2016-01-0{day} 00:00:00").cast("timestamp")
        append_check_results(key_checks(checked), path, run_id, when)
    compared = compare_check_runs(read_check_history(spark, path))
    return compared.select(
        "run_id", "check", "subject", "observed", "previous_run", "change", "status",
        F.col("failing_since").cast("date").alias("failing_since"),
    )


@query(f"""WITH {VISITS}
SELECT CAST(i94yr AS INTEGER) AS i94yr,
       concat_ws(',', CASE WHEN i94bir > 90 THEN 'old' END, CASE WHEN gender IS NULL THEN 'no_gender' END) AS rules,
       count(*) AS records, CAST(sum(cicid) AS DOUBLE) AS ids
FROM visits GROUP BY 1, 2""")
def judged_records(spark, sf_dir):
    """Clean and abnormal records out of one evaluation, each read without the other."""
    path = scratch_path(spark, "judged")
    records = visit_records(spark, sf_dir).withColumn("i94yr", F.col("i94yr").cast("int"))
    rules = {"old": F.col("i94bir") > 90, "no_gender": F.col("gender").isNull()}
    write_judged(records, rules, path, ["i94yr"])
    clean = read_clean(spark, path).select("i94yr", F.lit("").alias("rules"), "cicid")
    abnormal = read_abnormal(spark, path)
    abnormal = abnormal.select("i94yr", F.concat_ws(",", "broken_rules").alias("rules"), "cicid")
    return clean.unionAll(abnormal).groupBy("i94yr", "rules").agg(
        F.count("*").alias("records"), F.sum("cicid").alias("ids")
    )
