"""Backfills, anomalies, stored sketches, runs compared, records judged once."""

from __future__ import annotations

import os
import random
from statistics import median

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from recordlake.operators import (
    anomaly_summary,
    append_check_results,
    backfill_plan,
    compare_check_runs,
    distinct_sketches,
    group_quantiles,
    label_anomalies,
    merged_distinct_counts,
    new_failures,
    rank_errors,
    read_abnormal,
    read_check_history,
    read_clean,
    read_sketches,
    robust_spread,
    store_sketches,
    surely_repeated,
    to_rebuild,
    write_judged,
)
from recordlake.operators.backfill import partition_digests
from recordlake.plans import build_enriched_lake, enriched_backfill_plan, heal_enriched_lake, visits
from recordlake.sources import read_lake, write_lake
from tests.helpers import plan, row_set, rows
from workload import lakes, upkeep


def states(plan_frame):
    return {(r["y"], r["m"]): (r["source_records"], r["derived_records"], r["state"]) for r in plan_frame.collect()}


def test_states_of_partitions(spark):
    source = [(2016, m, float(i), "v") for m in (1, 2, 3, 4, 5, 7) for i in range(4)] + [(2016, None, 1.0, "v")]
    derived = [r for r in source if r[1] != 2 and not (r[1] == 3 and r[2] > 1)]
    derived += [r for r in source if r[1] == 4] + [(2015, 1, 1.0, "v")]
    derived = [(y, m, 9.0 if m == 5 and i == 0 else i, "w" if m == 7 and i == 0 else v) for y, m, i, v in derived]
    before = spark.createDataFrame(source, "y int, m int, id double, v string")
    after = spark.createDataFrame(derived, "y int, m int, id double, v string").withColumn("id", F.col("id").cast("int"))
    found = backfill_plan(before, after, ["y", "m"], ["id"])
    assert states(found) == {
        (2016, 1): (4, 4, "complete"), (2016, 2): (4, 0, "missing"), (2016, 3): (4, 2, "short"),
        (2016, 4): (4, 8, "surplus"), (2016, 5): (4, 4, "stale"), (2016, 7): (4, 4, "complete"),
        (2016, None): (1, 1, "complete"), (2015, 1): (0, 1, "orphaned"),
    }
    by_values = states(backfill_plan(before, after, ["y", "m"], ["id", "v"]))
    assert by_values[2016, 7] == (4, 4, "stale") and by_values[2016, 1][2] == "complete"
    assert to_rebuild(found).count() == 5
    none_built = backfill_plan(before, None, ["y", "m"], ["id"])
    assert set(v[2] for v in states(none_built).values()) == {"missing"}


def test_swapped_and_repeated_records_are_told(spark):
    def one(values):
        return spark.createDataFrame([(1, v, w) for v, w in values], "p int, a int, b int")

    source = one([(1, 2), (3, 4), (None, 5)])
    for other in ([(1, 4), (3, 2), (None, 5)], [(1, 2), (1, 2), (None, 5)], [(1, 2), (3, 4), (5, None)]):
        assert to_rebuild(backfill_plan(source, one(other), ["p"], ["a", "b"])).count() == 1
    assert to_rebuild(backfill_plan(source, one([(None, 5), (3, 4), (1, 2)]), ["p"], ["a", "b"])).count() == 0


def test_a_lake_is_scanned_once_by_its_columns(spark, out):
    write_lake(spark.range(50).selectExpr("id % 5 as p", "id", "id as other"), out, ["p"])
    text = plan(backfill_plan(read_lake(spark, out), read_lake(spark, out), ["p"], ["id"]))
    assert text.count("FileScan") == 2 and text.count("ReadSchema: struct<id:bigint>") == 2


def raw_records(spark, months, per_month=5):
    nulls = [F.lit(None).cast(t).alias(n) for n, t in visits.RAW_COLUMNS if n not in ("cicid", "i94yr", "i94mon")]
    return spark.range(per_month * len(months)).select(
        (F.col("id") / 1).alias("cicid"), F.lit(2016).alias("i94yr"),
        F.element_at(F.array(*map(F.lit, months)), (F.col("id") % len(months) + 1).cast("int")).alias("i94mon"), *nulls,
    )


def test_only_damaged_months_are_built_again(spark, out):
    raw, enriched = os.path.join(out, "raw"), os.path.join(out, "enriched")
    write_lake(raw_records(spark, [1, 2, 3, 4]), raw, visits.PARTITION_BY)
    names = {table for _, table, _ in visits.LABELLED_CODES}
    tables = {name: spark.createDataFrame([("1", "one")], "key string, value string") for name in names}
    healed = heal_enriched_lake(spark, raw, tables, enriched)
    assert [(h["i94mon"], h["state"]) for h in healed] == [(m, "missing") for m in (1, 2, 3, 4)]
    whole = row_set(read_lake(spark, enriched).select("guid", "i94mon"))
    more = raw_records(spark, [3], 2).withColumn("cicid", F.col("cicid") + 100)
    write_lake(more, raw, visits.PARTITION_BY, "append")
    write_lake(raw_records(spark, [9]), raw, visits.PARTITION_BY, "append")

    def files(month):
        folder = os.path.join(enriched, "i94yr=2016", f"i94mon={month}")
        return sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))

    before = {m: files(m) for m in (1, 2, 4)}
    assert row_set(enriched_backfill_plan(spark, raw, enriched).where("state <> 'complete'").select("i94mon", "state")) == [
        (3, "short"), (9, "missing"),
    ]
    healed = heal_enriched_lake(spark, raw, tables, enriched)
    assert [h["i94mon"] for h in healed] == [3, 9]
    assert before == {m: files(m) for m in (1, 2, 4)}
    found = row_set(read_lake(spark, enriched).select("guid", "i94mon"))
    assert set(whole) < set(found) and len(found) == 20 + 2 + 5
    assert heal_enriched_lake(spark, raw, tables, enriched) == []
    build_enriched_lake(spark, raw, tables, enriched + "2")
    assert row_set(read_lake(spark, enriched + "2").select("guid", "i94mon")) == found


def test_records_without_a_month_stop_the_backfill(spark, out):
    records = raw_records(spark, [1]).withColumn("i94mon", F.lit(None).cast("int"))
    write_lake(records, out, visits.PARTITION_BY)
    with pytest.raises(ValueError, match="without a year or month"):
        heal_enriched_lake(spark, out, {}, out + "-enriched")


def values_of(spark, groups):
    data = [(g, v) for g, vs in groups.items() for v in vs]
    return spark.createDataFrame(data, "g string, v double").repartition(3)


def test_anomalies_against_plain_medians(spark):
    rng = random.Random(3)
    groups = {"a": [rng.gauss(0, 1) for _ in range(201)] + [50.0, -40.0], "b": [7.0] * 20 + [9.0], None: [3.0, 3.0, 3.0],
              "c": [1.0, 2.0, 3.0, None, float("nan"), 1000.0], "d": [None]}
    df = values_of(spark, groups)
    spread = {r["g"]: r for r in robust_spread(df, "v", ["g"], exact=True).collect()}
    for g in ("a", "c"):
        kept = [v for v in groups[g] if v is not None and v == v]
        middle = median(kept)
        assert spread[g]["median"] == pytest.approx(middle)
        assert spread[g]["spread"] == pytest.approx(1.4826 * median(abs(v - middle) for v in kept))
    assert spread["b"]["spread"] == pytest.approx(1.2533 * 2 / 21) and spread[None]["spread"] == 0
    assert "d" not in spread
    labelled = label_anomalies(df, "v", ["g"], exact=True)
    assert set(labelled.columns) == {"g", "v", "median", "distance", "anomaly"}
    found = {(r["g"], r["v"]): r["anomaly"] for r in labelled.collect() if r["v"] == r["v"]}
    assert found["a", 50.0] == "high" and found["a", -40.0] == "low" and found["c", 1000.0] == "high"
    assert found["b", 9.0] == "high" and found["b", 7.0] == "none" and found[None, 3.0] == "none"
    assert found["d", None] is None
    counts = {r["g"]: (r["judged"], r["low"], r["high"]) for r in anomaly_summary(labelled, ["g"]).collect()}
    assert counts["c"] == (4, 0, 1) and counts["d"] == (0, 0, 0) and counts[None] == (3, 0, 0)


def test_anomalies_of_a_whole_table(spark):
    df = spark.range(1000).selectExpr("cast(id as double) as v").unionAll(spark.sql("select 1e6D as v"))
    labelled = label_anomalies(df, "v")
    assert rows(labelled.where("anomaly <> 'none'").select("v", "anomaly")) == [(1e6, "high")]
    assert label_anomalies(df.limit(0), "v").count() == 0
    assert "CartesianProduct" not in plan(labelled) and "NestedLoop" not in plan(labelled)


@pytest.mark.parametrize("accuracy", [20, 200])
def test_sketched_quantiles_keep_their_bound(spark, accuracy):
    rng = random.Random(accuracy)
    df = values_of(spark, {"a": [rng.random() for _ in range(4000)], "b": [float(rng.randrange(6)) for _ in range(900)], None: [1.0]})
    found = group_quantiles(df, "v", ["g"], (0.0, 0.1, 0.5, 0.9, 1.0), accuracy)
    errors = rank_errors(df, found, "v", ["g"]).collect()
    assert len(errors) == 15
    assert all(0 <= r["rank_error"] <= r["records"] / accuracy + 1 for r in errors)
    whole = rank_errors(df, group_quantiles(df, "v"), "v").collect()
    assert len(whole) == 3 and all(r["rank_error"] <= 2 for r in whole)


def test_sketches_of_months_merge_to_a_year(spark, out):
    df = spark.range(40000).selectExpr(
        "2015 + id % 2 as y", "id % 12 as m", "id", "id % 500 as some", "if(id % 3 = 0, null, 'x') as flag",
        "cast(id % 7000 as double) as d", "cast(null as string) as nothing",
    )
    columns = ["id", "some", "flag", "d", "nothing"]
    store_sketches(distinct_sketches(df, ["y", "m"], columns), out, ["y", "m"])
    counts = merged_distinct_counts(read_sketches(spark, out), ["y"])
    exact = {"id": 20000, "some": 250, "flag": 2, "d": 3500, "nothing": 1}
    for r in counts.collect():
        assert r["records"] == 20000 and r["at_least"] <= exact[r["column_name"]] <= r["at_most"]
        assert r["at_least"] <= r["estimate"] <= r["at_most"]
    assert {r["column_name"] for r in surely_repeated(counts).collect()} == set(exact) - {"id"}
    text = plan(merged_distinct_counts(read_sketches(spark, out)))
    assert text.count("FileScan") == 1 and "Range" not in text
    # A month counted again takes the place of the old one.
    again = df.where("y = 2015 and m = 2").unionAll(df.where("y = 2015 and m = 2"))
    store_sketches(distinct_sketches(again, ["y", "m"], columns), out, ["y", "m"])
    total = merged_distinct_counts(read_sketches(spark, out)).where("column_name = 'some'").first()
    assert total["records"] > 40000 and total["at_least"] <= 500 <= total["at_most"]


def test_runs_are_compared_by_time(spark, out):
    def run(name, day, results):
        data = [("unique", s, o, 5, o == 5) for s, o in results.items()]
        checks = spark.createDataFrame(data, "check string, subject string, observed long, expected long, passed boolean")
        append_check_results(checks, out, name, F.lit(f"2016-01-{day:02}").cast("timestamp"))

    run("r1", 1, {"a": 5, "b": 4})
    run("r4", 4, {"a": 5, "b": 5})
    run("r2", 2, {"a": 3, "c": 1})  # appended late
    run("r3", 3, {"a": 4, "b": 4})
    run("r5", 5, {"a": 2})
    run("r5", 5, {"a": 2})  # appended twice
    history = read_check_history(spark, out)
    found = {
        (r["subject"], r["run_id"]): (r["previous_run"], r["change"], r["status"], r["failing_since"] and r["failing_since"].day)
        for r in compare_check_runs(history).collect()
    }
    assert found == {
        ("a", "r1"): (None, None, "passed", None), ("a", "r2"): ("r1", -2, "failed", 2),
        ("a", "r3"): ("r2", 1, "still failing", 2), ("a", "r4"): ("r3", 1, "recovered", None),
        ("a", "r5"): ("r4", -3, "fails again", 5), ("b", "r1"): (None, None, "failed", 1),
        ("b", "r3"): ("r1", 0, "still failing", 1), ("b", "r4"): ("r3", 1, "recovered", None),
        ("c", "r2"): (None, None, "failed", 2),
    }
    assert row_set(new_failures(history).select("subject", "run_id")) == [("a", "r2"), ("a", "r5"), ("b", "r1"), ("c", "r2")]


def test_records_are_judged_once(spark, out):
    seen = Observation()
    df = spark.range(1000).selectExpr("id", "id % 4 as p", "if(id % 10 = 0, null, id) as v").observe(seen, F.count("*").alias("n"))
    rules = {"no_value": F.col("v").isNull(), "small": F.col("id") < 5}
    write_judged(df, rules, out, ["p"])
    assert seen.get["n"] == 1000
    clean, abnormal = read_clean(spark, out), read_abnormal(spark, out)
    assert clean.columns == ["id", "v", "p"] and clean.count() == 896
    assert abnormal.count() == 104 and row_set(abnormal.where("id = 0").select("broken_rules")) == [(["no_value", "small"],)]
    assert "PartitionFilters: [isnotnull(verdict" in plan(clean)
    with pytest.raises(ValueError, match="verdict"):
        write_judged(df.withColumn("verdict", F.lit(1)), rules, out + "2")
    with pytest.raises(ValueError, match="rule"):
        write_judged(df, {}, out + "3")


@pytest.mark.parametrize(
    "module, name", [(lakes, "rebuild_one_month"), (upkeep, "manifest_column_count"), (upkeep, "manifest_after_a_rebuild")]
)
def test_monthly_files_come_from_one_pass_over_the_records(spark, monkeypatch, module, name):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(month):
        seen.add(1)
        return None if month == 13 else float(month)

    records = raw_records(spark, [*range(1, 13), 13], 4).select(
        *[counted(c).alias(c) if c == "i94mon" else F.col(c).cast(t).alias(c) for c, t in visits.RAW_COLUMNS]
    )
    monkeypatch.setattr(module, "visit_records", lambda *_: records)
    found = getattr(module, name)(spark, "").collect()
    assert seen.value == 13 * 4
    if name == "manifest_column_count":
        assert {r["subject"] for r in found if not r["passed"]} == {"i94yr=2016/i94mon=5"}
        assert [r["observed"] for r in found if r["check"] == "not_empty"] == [4] * 12
    else:
        assert {r["i94mon"]: r["records"] for r in found} == {m: 8 if m == 2 else 4 for m in range(1, 13)}


def test_lake_is_damaged_in_place_and_healed(spark, monkeypatch, tmp_path):
    raw = str(tmp_path / "raw")
    write_lake(raw_records(spark, [1, 2, 3, 4, 5, 6, 9], 6).withColumn("i94yr", F.lit(1998)), raw, visits.PARTITION_BY)
    names = {table for _, table, _ in visits.LABELLED_CODES}
    tables = {name: spark.createDataFrame([("1", "one")], "key string, value string") for name in names}
    copied = []
    monkeypatch.setattr(upkeep, "shared", lambda *_: raw)
    monkeypatch.setattr(upkeep, "code_tables", lambda *_: tables)
    monkeypatch.setattr(upkeep, "write_lake", lambda df, *args: (copied.append(df.count()), write_lake(df, *args)))
    found = states(upkeep.backfill_states_by_values(spark, "").withColumnsRenamed({"i94yr": "y", "i94mon": "m"}))
    assert {k: v[2] for k, v in found.items()} == {
        (1998, 1): "complete", (1998, 2): "missing", (1998, 3): "short", (1998, 4): "stale",
        (1998, 5): "surplus", (1998, 6): "stale", (1998, 9): "complete", (1990, 1): "orphaned",
    }
    assert copied == [5 * 6]
    lake = upkeep.backfilled_enriched_lake(spark, "")
    assert row_set(lake.select("i94yr", "i94mon", "cicid")) == row_set(read_lake(spark, raw).select("i94yr", "i94mon", "cicid"))


def test_digests_are_sums_of_whole_numbers(spark):
    frame = spark.range(1000).selectExpr("id % 3 as p", "nullif(id % 10, 4) as v")
    digests = partition_digests(frame, ["p"], ["v"])
    assert "decimal" not in digests.schema.simpleString()
    reverse = partition_digests(frame.orderBy(F.desc("v")).repartition(7), ["p"], ["v"])
    assert row_set(digests) == row_set(reverse)
