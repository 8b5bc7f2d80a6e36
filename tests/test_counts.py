from __future__ import annotations

import pytest
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
from tests.helpers import plan, row_set, rows


@pytest.fixture
def codes(spark):
    data = [(None, 1), ("b", 2), ("a", 3), ("b", None), (None, 5), ("*", 1), ("9", 1)]
    return spark.createDataFrame(data, "code string, n int")


def test_value_counts_order(codes):
    got = rows(value_counts(codes, "code"))
    assert got == [(None, 2), ("*", 1), ("9", 1), ("a", 1), ("b", 2)]


def test_value_counts_of_odd_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, count int")
    assert rows(value_counts(df, "a.b")) == [(1, 1)]
    assert rows(value_counts(df, "count")) == [(2, 1)]


def test_shares(codes, spark):
    got = rows(share_of_total(codes, ["code"]))
    assert got[0] == (None, 2, 2 / 7 * 100)
    assert sum(r[2] for r in got) == pytest.approx(100)
    empty = codes.where("false")
    assert rows(share_of_total(empty, ["code"])) == []
    assert "SinglePartition" not in plan(share_of_total(codes, ["code"], ordered=False)).split(
        "Subquery"
    )[0]


def test_repeats(codes):
    assert row_set(repeat_keys(codes, ["code"])) == [(None, 2), ("b", 2)]
    assert row_set(repeat_key_records(codes, ["code"])) == [("b", None), ("b", 2)]
    assert rows(records_per_key_range(codes, ["code"])) == [(1, 2)]


def test_repeat_key_records_with_hot_keys(spark, settings):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    # A third of the rows, all alike, hold one key.
    data = [(1, "x")] * 500 + [(k, "y") for k in range(2, 900)] + [(7, "z"), (None, "n")] * 2
    df = spark.createDataFrame(data, "k int, t string")
    expected = [(1, "x")] * 500 + [(7, "y"), (7, "z"), (7, "z")]
    for hot_rows, max_hot in ((100, 10), (1, 1), (1000, 10), (1, 0)):
        got = repeat_key_records(df, ["k"], hot_rows=hot_rows, max_hot=max_hot)
        assert row_set(got) == sorted(expected, key=lambda r: [(True, str(v)) for v in r])
    # The heavy key's rows do not reach the shuffled join.
    assert "BroadcastHashJoin" in plan(repeat_key_records(df, ["k"], hot_rows=100))


def test_min_max(codes):
    assert rows(min_max(codes, "n")) == [(1, 5)]
    assert rows(group_min_max_count(codes, ["code"], "n"))[0] == (None, 1, 5, 2)


def test_row_counts(codes):
    assert rows(row_count(codes)) == [(7,)]
    assert rows(row_count(codes, "n > 1")) == [(3,)]
    assert rows(non_null_count(codes, "n", F.col("code") == "b")) == [(1,)]


def test_distinct_count_takes_null_as_a_value(codes):
    assert rows(distinct_count(codes, "code")) == [(5,)]


def test_date_parts(spark):
    df = spark.sql("select explode(array(date'2016-01-31', date'2016-02-01', null)) as d")
    assert rows(date_part_counts(df, "d")) == [(None, None, 1), (2016, 1, 1), (2016, 2, 1)]


def test_presence(codes):
    got = rows(presence_counts(codes, ["code"], "n"))
    assert ("b", "N", 1) in got and ("b", "Y", 1) in got


def test_first_and_last(codes):
    assert rows(first_by_key(codes, ["code", "n"], 3)) == [(None, 1), (None, 5), ("*", 1)]
    assert rows(last_by_key(codes, ["code", "n"], 2)) == [("b", 2), ("b", None)]
    assert "TakeOrderedAndProject" in plan(first_by_key(codes, ["code"], 3))


def test_counting_combines_before_the_shuffle(codes):
    text = plan(key_counts(codes, ["code", "n"], ordered=False))
    assert text.count("Exchange") == 1 and "partial_count" in text
