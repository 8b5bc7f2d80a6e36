from __future__ import annotations

import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from recordlake.functions import (
    arrival_features,
    code_of_line,
    col,
    columns_with_dtype,
    composite_key,
    date_to_day_number,
    day_number_to_date,
    label_of_line,
    partition_condition,
)
from tests.helpers import plan, rows


def expected_date(number):
    """The date rule, by the standard library."""
    if number is None or math.isnan(number) or math.isinf(number):
        return None
    try:
        return date(1960, 1, 1) + timedelta(days=int(number))
    except OverflowError:
        return None


def test_day_numbers_as_doubles(spark):
    generator = random.Random(7)
    numbers = [
        None, 0.0, 20484.0, 20454.0, 20819.0, -14388.0, 0.9, -0.9, -715509.0, -715510.0,
        2936549.0, 2936550.0, 2936549.9, 1e30, -1e30, 2147483647.0, 2147483648.0,
        float("nan"), float("inf"), float("-inf"),
    ] + [generator.uniform(-800000, 3000000) for _ in range(300)]
    df = spark.createDataFrame([(n,) for n in numbers], "n double")
    got = [r[0] for r in rows(df.select(day_number_to_date(F.col("n"))))]
    assert got == [expected_date(n) for n in numbers]
    assert got[2] == date(2016, 1, 31)


def test_day_numbers_as_text(spark):
    cases = {
        "20484": date(2016, 1, 31),
        " 20484 ": date(2016, 1, 31),
        "-14388": date(1920, 8, 10),
        "null": date(1960, 1, 1),
        "20484.0": None,
        "": None,
        "x": None,
        "99999999999": None,
        None: None,
    }
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = rows(df.select(day_number_to_date(F.col("t"), text=True)))
    assert [r[0] for r in got] == list(cases.values())


def test_dates_stay_in_the_jvm(spark):
    df = spark.range(3).select(day_number_to_date(F.col("id").cast("double")))
    assert "Python" not in plan(df)


def test_day_number_inverse(spark):
    df = spark.range(-700000, 2900000, 37111).select("id")
    back = date_to_day_number(day_number_to_date(F.col("id").cast("double")))
    assert df.where(back != F.col("id")).count() == 0


def test_arrival_features(spark):
    df = spark.createDataFrame([(date(2016, 1, 3),)], "d date")
    assert rows(df.withColumns(arrival_features(F.col("d")))) == [(date(2016, 1, 3), 53, 1)]


def test_composite_key(spark):
    data = [
        (2016.0, 4.0, 7.0, "2016-04-7"),
        (2016.0, 12.0, 5748517.0, "2016-12-5748517"),
        (2016.0, 123.0, 1.0, "2016-12-1"),
        (2016.0, 1.0, 5e9, "2016-01-5000000000"),
        (None, 4.0, 7.0, None),
        (2016.0, 4.0, float("nan"), None),
    ]
    df = spark.createDataFrame(data, "y double, m double, i double, want string")
    key = composite_key(F.col("y"), F.col("m"), F.col("i"))
    assert df.where(~key.eqNullSafe(F.col("want"))).count() == 0


@pytest.mark.parametrize(
    "line, code, label",
    [
        ("   582 =  'MEXICO Air Sea, and Not Reported (I-94, no land arrivals)'", "582",
         "MEXICO Air Sea, and Not Reported (I-94, no land arrivals)"),
        ("\t'ALC'\t=\t'ALCAN, AK             '", "ALC", "ALCAN, AK"),
        ("   'CP '\t=\t'No PORT Code (CP)'\r", "CP", "No PORT Code (CP)"),
        ("\t9 = 'Not reported' ;", "9", "Not reported"),
        ("   1 = Business", "1", "Business"),
        ("'A'='x = y'", "A", "x = y"),
        ("'NIL'=", "NIL", ""),
    ],
)
def test_code_lines(spark, line, code, label):
    df = spark.createDataFrame([(line,)], "line string")
    got = df.select(code_of_line(F.col("line")), label_of_line(F.col("line")))
    assert rows(got) == [(code, label)]


def test_column_names(spark):
    df = spark.createDataFrame([(1.0, 2, "x")], "`a.b` double, `odd ``one` int, c string")
    assert columns_with_dtype(df, "double") == ["a.b"]
    assert columns_with_dtype(df, "int") == ["odd `one"]
    assert rows(df.select(col("a.b"), col("odd `one"))) == [(1.0, 2)]


def test_partition_condition(spark):
    df = spark.createDataFrame([(y, m) for y in (1, 2) for m in (1, 2, 3)], "y int, m int")
    wanted = [{"y": 1, "m": 2}, {"y": 2, "m": 3}]
    assert rows(df.where(partition_condition(wanted))) == [(1, 2), (2, 3)]
    assert df.where(partition_condition([{"m": 1}, {"m": 3}])).count() == 4
    with pytest.raises(ValueError):
        partition_condition([])
    with pytest.raises(ValueError):
        partition_condition([{"y": 1}, {"m": 1}])


def test_thousands_of_partitions_stay_a_shallow_condition(spark):
    from recordlake.functions.columns import partition_condition

    partitions = [{"a": k, "y": k % 50, "m": k % 7} for k in range(5000)]
    condition = partition_condition(partitions)
    rows = spark.range(10000).selectExpr("int(id) as a", "int(id % 50) as y", "int(id % 7) as m")
    assert rows.where(condition).count() == 5000
