from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from recordlake.operators import (
    LookupSpec,
    enrich_with_lookups,
    lookup_sizes,
    unmatched_codes,
)
from tests.helpers import plan, row_set, rows


@pytest.fixture
def records(spark):
    data = [
        (1, 582.0, "060"), (2, 101.0, "**"), (3, None, None), (4, 60.0, "60"),
        (5, float("nan"), "ALC"), (6, 582.0, "ALC"),
    ]
    return spark.createDataFrame(data, "id int, num double, txt string")


@pytest.fixture
def countries(spark):
    data = [("582", "MEXICO, Air"), ("60", "SIXTY"), ("060x", "BAD"), (None, "NONE")]
    return spark.createDataFrame(data, "key string, value string")


@pytest.fixture
def ports(spark):
    return spark.createDataFrame(
        [("060", "No PORT Code (60)"), ("ALC", "ALCAN, AK")], "key string, value string"
    )


EXPECTED = [
    (1, 582.0, "060", "MEXICO, Air", "No PORT Code (60)"),
    (2, 101.0, "**", None, None),
    (3, None, None, None, None),
    (4, 60.0, "60", "SIXTY", None),
    (6, 582.0, "ALC", "MEXICO, Air", "ALCAN, AK"),
]


@pytest.mark.parametrize("limit", [1 << 20, 0])
@pytest.mark.parametrize("hot_rows", [0, 1, 100])
def test_labels(records, countries, ports, limit, hot_rows, settings):
    if limit == 0:
        settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    specs = [LookupSpec("num", countries, numeric=True), LookupSpec("txt", ports)]
    got = enrich_with_lookups(records, specs, max_broadcast_bytes=limit, hot_rows=hot_rows)
    assert got.columns == ["id", "num", "txt", "num_value", "txt_value"]
    assert row_set(got.where("id <> 5")) == EXPECTED
    assert rows(got.where("id = 5").select("num_value", "txt_value")) == [(None, "ALCAN, AK")]


def test_small_lookups_need_no_shuffle(records, countries, ports):
    specs = [
        LookupSpec("num", countries, "cit", numeric=True),
        LookupSpec("num", countries, "res", numeric=True),
        LookupSpec("txt", ports),
    ]
    text = plan(enrich_with_lookups(records, specs))
    assert text.count("BroadcastHashJoin") == 3
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_large_lookup_with_a_third_of_the_rows_on_one_code(spark, settings):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    data = [(7, "copy")] * 1000 + [(None, "none")] * 1000 + [(i, "x") for i in range(1000)]
    records = spark.createDataFrame(data, "code int, t string")
    lookup = spark.range(0, 1000, 2).selectExpr("cast(id as int) as key", "concat('L', id) as value")
    spec = LookupSpec("code", lookup, "label")
    got = enrich_with_lookups(records, [spec], max_broadcast_bytes=0, hot_rows=100)
    want = records.join(lookup, F.col("code") == F.col("key"), "left").select(
        "code", "t", F.col("value").alias("label")
    )
    assert row_set(got) == row_set(want)
    # Settled rows are set apart and not shuffled; the others meet the lookup by code.
    text = plan(got)
    assert "Union" in text and "SortMergeJoin" in text and "LeftAnti" in text
    # With two large lookups rows are read once: settled ones pass the shuffle spread out.
    more = enrich_with_lookups(
        records, [spec, LookupSpec("code", lookup, "again")], max_broadcast_bytes=0, hot_rows=100
    )
    assert row_set(more) == row_set(want.withColumn("again", F.col("label")))
    assert "hashpartitioning(_recordlake_shuffle_key" in plan(more)


@pytest.mark.parametrize("hot_rows", [None, 0, 3])
def test_chain_of_large_lookups_reads_the_rows_twice_at_most(spark, settings, out, hot_rows):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.range(200).selectExpr("id", "case when id % 5 > 0 then id % 50 end as c0").write.parquet(out)
    records = want = spark.read.parquet(out)
    specs = []
    for k in range(4):
        # Every other code has a label; the labels have ever fewer values.
        pairs = [(i, i // 2) for i in range(0, 50 >> k, 1 + k % 2)]
        table = spark.createDataFrame(pairs, "key bigint, value bigint")
        specs.append(LookupSpec(f"c{k}", table, f"c{k + 1}"))
        want = want.join(
            table.select(F.col("key").alias(f"c{k}"), F.col("value").alias(f"c{k + 1}")),
            f"c{k}", "left",
        )
    got = enrich_with_lookups(records, specs, max_broadcast_bytes=0, hot_rows=hot_rows)
    scans = [line for line in plan(got).splitlines() if "FileScan" in line and out in line]
    assert 1 <= len(scans) <= 2
    assert got.columns == ["id", "c0", "c1", "c2", "c3", "c4"]
    assert row_set(got) == row_set(want.select(got.columns))


def test_heavy_codes_do_not_fill_one_task(spark, settings):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    settings("spark.sql.shuffle.partitions", "64")
    settings("spark.sql.adaptive.coalescePartitions.enabled", "false")
    records = spark.range(0, 30000, 1, 32).selectExpr(
        "case when id % 3 = 0 then 7 when id % 3 = 1 then null else cast(id as int) end as code",
        "'copy' as t",
    )
    lookup = spark.range(0, 30000).selectExpr("cast(id as int) as key", "concat('L', id) as value")
    spec = LookupSpec("code", lookup, "label")
    got = enrich_with_lookups(records, [spec], max_broadcast_bytes=0, hot_rows=100)
    per_task = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    # 10,000 copies of one row and 10,000 without a code, over 64 tasks.
    assert per_task < 3000
    plain = records.join(lookup, F.col("code") == F.col("key"), "left")
    per_task = plain.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task >= 10000
    assert got.count() == 30000 and got.where("label = 'L7'").count() == 10000


def test_sizes_are_measured_once_per_table(records, countries, ports):
    specs = [
        LookupSpec("num", countries, "a", numeric=True),
        LookupSpec("num", countries, "b", numeric=True),
        LookupSpec("txt", ports),
    ]
    sizes = lookup_sizes(specs)
    assert len(sizes) == 2
    assert all(s > 0 for s in sizes.values())


def test_empty_lookup(records, ports):
    got = enrich_with_lookups(records, [LookupSpec("txt", ports.where("false"))])
    assert got.where("txt_value is not null").count() == 0 and got.count() == 6


def test_unmatched_codes(records, countries):
    spec = LookupSpec("num", countries, numeric=True)
    got = rows(unmatched_codes(records.where("id <> 5"), spec))
    assert got == [(101.0, 1)]


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_whole_numbers_beyond_doubles_and_clashing_columns(spark, limit):
    records = spark.createDataFrame(
        [(9007199254740993, {"a": 1}, "x"), (None, None, "y")],
        "code bigint, m map<string,int>, lookup_key string",
    )
    keys = [("9007199254740992", "even"), ("9007199254740993", "odd"), ("no number", "z")]
    lookup = spark.createDataFrame(keys, "key string, value string")
    spec = LookupSpec("code", lookup, "label", numeric=True)
    got = enrich_with_lookups(records, [spec], max_broadcast_bytes=limit)
    assert sorted((r["lookup_key"], r["label"]) for r in got.collect()) == [("x", "odd"), ("y", None)]
    with pytest.raises(ValueError):
        enrich_with_lookups(records, [LookupSpec("code", lookup, "m")])
