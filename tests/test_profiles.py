from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from recordlake.operators import (
    apply_numeric_types,
    first_value_counts,
    near_unique_columns,
    profile_value_counts,
    recommend_numeric_types,
    split_abnormal,
    table_overview,
    table_preview,
)
from tests.helpers import plan, row_set, rows


@pytest.fixture
def mixed(spark):
    data = [
        (9, 10.5, "b", True, date(2016, 1, 2)),
        (10, -1.0, None, False, date(2015, 1, 2)),
        (-3, float("nan"), "B", None, None),
        (9, None, "b", True, date(2016, 1, 2)),
        (None, 1e10, "", True, date(999, 1, 2)),
    ]
    return spark.createDataFrame(data, "i int, d double, s string, b boolean, t date")


def values(profile, name):
    chosen = profile.where(F.col("column_name") == name).orderBy("position")
    return rows(chosen.select("position", "value", "records"))


@pytest.mark.parametrize("near_unique", [(), ("i", "d", "s", "b", "t")])
def test_profile_orders_values_by_type(mixed, near_unique):
    profile = profile_value_counts(mixed, n=10, near_unique=near_unique, sample_fraction=0.5)
    assert values(profile, "i") == [(1, None, 1), (2, "-3", 1), (3, "9", 2), (4, "10", 1)]
    assert [v[1] for v in values(profile, "d")] == [None, "-1.0", "10.5", "1.0E10", "NaN"]
    assert [v[1] for v in values(profile, "s")] == [None, "", "B", "b"]
    assert [v[1] for v in values(profile, "b")] == [None, "false", "true"]
    assert [v[1] for v in values(profile, "t")] == [None, "0999-01-02", "2015-01-02", "2016-01-02"]


def test_profile_keeps_the_first_n_values(mixed):
    profile = profile_value_counts(mixed, ["i", "s"], n=2)
    assert values(profile, "i") == [(1, None, 1), (2, "-3", 1)]
    assert profile.count() == 4


def test_profile_of_many_values_is_cut_before_the_shuffle(mixed):
    # All columns are one scan, whose rows are cut per task and then per column.
    assert plan(profile_value_counts(mixed, n=2)).count("WindowGroupLimit") == 2


def test_all_columns_are_one_scan(spark, out):
    spark.range(5000).selectExpr(
        "id", "cast(id as double) as d", "cast(id as decimal(20,3)) as m", "sha2(string(id), 256) as s", "id % 3 as low",
        "cast(id as timestamp) as ts", "date_from_unix_date(int(id)) as t", "id % 2 = 0 as b", "cast(id / 7 as float) as f",
    ).write.parquet(out)
    df = spark.read.parquet(out)
    first = profile_value_counts(df, n=20, sample_fraction=0.1)
    text = plan(first)
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 2
    for name in df.columns:
        wanted = rows(df.groupBy(name).count().orderBy(name).limit(20).select(F.col(name).cast("string"), "count"))
        assert [v[1:] for v in values(first, name)] == wanted, name
        assert [v[0] for v in values(first, name)] == list(range(1, len(wanted) + 1))


@pytest.mark.parametrize("fraction", [0.0, 0.02, 1.0])
def test_first_values_do_not_depend_on_the_sample(spark, fraction):
    df = spark.range(3000).selectExpr(
        "if(id % 50 = 0, null, 3000 - id) as v", "if(id % 7 = 0, double('nan'), double(id % 60)) as d", "string(id) as s"
    )
    df = df.unionAll(df)
    profile = profile_value_counts(df, n=30, sample_fraction=fraction)
    for name in df.columns:
        wanted = rows(df.groupBy(name).count().orderBy(name).limit(30).select(F.col(name).cast("string"), "count"))
        assert [v[1:] for v in values(profile, name)] == wanted, (name, fraction)


def test_all_values_are_numbered_without_one_task(spark, settings):
    settings("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(4000).selectExpr("(id * 7919) % 4001 as v", "if(id % 5 = 0, null, string(id % 90)) as s", "array(id % 2) as a")
    profile = profile_value_counts(df)
    for name in df.columns:
        wanted = rows(df.groupBy(name).count().orderBy(name).select(F.col(name).cast("string"), "count"))
        assert values(profile, name) == [(i, *w) for i, w in enumerate(wanted, 1)], name
    assert profile_value_counts(df.limit(0)).count() == 0


def test_profile_of_other_types(spark):
    df = spark.sql(
        "select explode(array(9.5, 10.25, null)) as m, timestamp_ntz'2016-01-01 10:00:00' as ts"
    )
    profile = profile_value_counts(df, n=5)
    assert [v[1] for v in values(profile, "m")] == [None, "9.50", "10.25"]
    assert values(profile, "ts") == [(1, "2016-01-01 10:00:00", 3)]


@pytest.mark.parametrize("fraction", [None, 0.0, 0.01, 0.2, 1.0])
def test_first_values_are_exact_for_any_sample(spark, fraction):
    df = spark.range(20000).select(
        F.when(F.col("id") % 100 > 0, 20000 - F.col("id")).cast("double").alias("v")
    )
    got = rows(first_value_counts(df.unionAll(df), "v", 50, fraction))
    want = [(None, 400)] + [(float(i), 2) for i in range(1, 60) if i % 100][:49]
    assert got == want


def test_near_unique(spark):
    df = spark.range(5000).selectExpr("id", "id % 3 as low")
    assert [r[2] for r in rows(near_unique_columns(df, min_values=1000))] == [True, False]


def test_overview(mixed):
    got = rows(table_overview(mixed, "mixed"))
    assert got[1] == ("mixed", 2, "d", "double", True, 5, 5) and len(got) == 5
    assert table_preview(mixed, 3).count() == 3 and table_preview(mixed, 99).count() == 5


NUMBERS = {
    "whole": ([1.0, -5.0, None], "IntegerType"),
    "half": ([1.0, 0.5, None], "double"),
    "below": ([2147483646.0, None, None], "IntegerType"),
    "limit": ([2147483647.0, None, 1.0], "LongType"),
    "negative": ([-2147483647.0, None, 1.0], "LongType"),
    "long": ([5e9, 1.0, 2.0], "LongType"),
    "beyond": ([1e30, 1.0, 2.0], "double"),
    "nan": ([float("nan"), 1.0, 2.0], "double"),
    "nothing": ([None, None, None], "LongType"),
}


def test_numeric_types(spark):
    schema = ", ".join(f"`{n}` double" for n in NUMBERS) + ", other string"
    data = [tuple(v[0][i] for v in NUMBERS.values()) + ("x",) for i in range(3)]
    df = spark.createDataFrame(data, schema)
    proposals = recommend_numeric_types(df)
    assert rows(proposals) == [(n, v[1]) for n, v in NUMBERS.items()]
    typed = apply_numeric_types(df, proposals.collect())
    types = {"IntegerType": "int", "LongType": "bigint", "double": "double"}
    assert typed.dtypes[:-1] == [(n, types[v[1]]) for n, v in NUMBERS.items()]
    assert rows(typed.select("whole", "long"))[0] == (1, 5000000000)


def test_numeric_types_is_one_aggregation(mixed):
    text = plan(recommend_numeric_types(mixed.select("d", (F.col("d") * 2).alias("e"))))
    assert text.count("Exchange") == 1


def test_numeric_types_of_no_double_and_no_row(spark, mixed):
    assert recommend_numeric_types(mixed.select("s")).count() == 0
    empty = recommend_numeric_types(mixed.where("false"))
    assert rows(empty) == [("d", "LongType")]


def test_quarantine(mixed):
    rules = {"small": F.col("i") < 0, "no_text": F.col("s").isNull()}
    clean, abnormal = split_abnormal(mixed, rules)
    assert clean.columns == mixed.columns and clean.count() == 3
    assert row_set(abnormal.select("i", "broken_rules")) == [(-3, ["small"]), (10, ["no_text"])]
    with pytest.raises(ValueError):
        split_abnormal(mixed, {})
