from __future__ import annotations

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameWriter

from recordlake.scratch import scratch_path
from recordlake.sources import (
    expand_paths,
    read_default,
    read_delimited,
    read_exported,
    read_files,
    read_lake,
    read_lake_files,
    read_raw_rows,
    replace_partitions,
    roundtrip,
    whole_partition_values,
    write_csv_tables,
    write_lake,
    write_value_counts_csv,
)
from tests.helpers import plan, row_set, rows


@pytest.fixture
def records(spark):
    data = [(float(y), float(m), float(i)) for y in (2015, 2016) for m in (1, 2, 12) for i in range(5)]
    return spark.createDataFrame(data, "y double, m double, id double")


@pytest.fixture
def whole(records):
    return whole_partition_values(records, ["y", "m"])


def test_expand_paths():
    got = expand_paths("{base}/i_{mmm}{yy}", base=["d"], yy=["15", "16"], mmm=["jan", "feb"])
    assert got == ["d/i_jan15", "d/i_feb15", "d/i_jan16", "d/i_feb16"]


def test_partitions_are_whole_numbers_and_prune(spark, whole, out):
    write_lake(whole, out, ["y", "m"])
    assert sorted(d for d in os.listdir(out) if d.startswith("y")) == ["y=2015", "y=2016"]
    lake = read_lake(spark, out)
    assert lake.columns == ["id", "y", "m"]
    for condition in ("y=2016 and m=2", "y=2016.0 and m in (1, 2)", "y=2016 and m between 1 and 2"):
        pruned = lake.where(condition)
        assert pruned.select("y").distinct().count() == 1
        text = plan(pruned)
        assert "PartitionFilters: [isnotnull(" in text and "DataFilters: []" in text


def test_filters_and_columns_reach_the_scan(spark, whole, out):
    write_lake(whole, out, ["y", "m"])
    text = plan(read_lake(spark, out).where("id = 3").select("id"))
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,3.0)]" in text
    assert "ReadSchema: struct<id:double>" in text


def test_glob_keeps_partition_columns(spark, whole, out):
    write_lake(whole, out, ["y", "m"])
    lake = read_lake_files(spark, out, "*/*/*.parquet")
    assert lake.columns == ["id", "y", "m"] and lake.count() == 30
    assert read_lake_files(spark, out, "y=2016/m=2/*.parquet").count() == 5


def test_default_format(spark, whole, out):
    write_lake(whole, out)
    assert read_default(spark, out).count() == 30


def test_write_modes(spark, whole, out):
    write_lake(whole, out, ["y", "m"])
    with pytest.raises(AnalysisException):
        write_lake(whole, out, ["y", "m"])
    assert read_lake(spark, out).count() == 30
    write_lake(whole, out, ["y", "m"], "append")
    assert read_lake(spark, out).count() == 60
    write_lake(whole.where("y = 2016"), out, ["y", "m"], "replace_partitions")
    assert read_lake(spark, out).count() == 45
    write_lake(whole.where("y = 2016"), out, ["y", "m"], "overwrite")
    assert read_lake(spark, out).count() == 15
    with pytest.raises(ValueError):
        write_lake(whole, out, mode="replace_partitions")
    with pytest.raises(ValueError):
        write_lake(whole, out, mode="ignore")


def test_replace_partitions(spark, whole, out):
    months = [{"y": 2016, "m": 1}, {"y": 2016, "m": 2}, {"y": 2017, "m": 3}]
    # A first build, where the target does not exist yet.
    replace_partitions(whole, out, months)
    assert read_lake(spark, out).count() == 10
    write_lake(whole, out, ["y", "m"], "overwrite")
    half = whole.where("id < 3 and not (y = 2016 and m = 2)")
    for _ in range(2):
        replace_partitions(half, out, months)
        counts = rows(read_lake(spark, out).groupBy("y", "m").count().orderBy("y", "m"))
        assert counts == [(2015, 1, 5), (2015, 2, 5), (2015, 12, 5), (2016, 1, 3), (2016, 12, 5)]
    assert not os.path.exists(os.path.join(out, "y=2017"))


def test_replace_partitions_by_text(spark, out):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    write_lake(df, out, ["k"])
    replace_partitions(df.where("false"), out, [{"k": "a"}])
    assert rows(read_lake(spark, out)) == [(2, "b")]
    write_lake(spark.createDataFrame([("a/b", 1)], "k string, n int"), out, ["k"], "append")
    with pytest.raises(ValueError):
        replace_partitions(df.where("false"), out, [{"k": "a/b"}])


def test_rebalanced_write_makes_few_files(spark, whole, out):
    write_lake(whole.repartition(8), out, ["y", "m"], rebalance=True)
    files = [f for _, _, names in os.walk(out) for f in names if f.endswith(".parquet")]
    assert len(files) == 6 and read_lake(spark, out).count() == 30


def test_rebalanced_write_splits_a_large_partition(spark, settings, out):
    settings("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    settings("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "100k")
    rows_of = spark.range(0, 300000, 1, 16).selectExpr(
        "case when id % 3 = 0 then -1 else cast(id % 64 as int) end as k", "sha2(string(id), 256) as t"
    )
    write_lake(rows_of, out, ["k"], rebalance=True)
    assert len([f for f in os.listdir(f"{out}/k=-1") if f.endswith(".parquet")]) > 3
    assert read_lake(spark, out).count() == 300000


def test_partitioned_write_does_not_hold_its_input_in_a_sort(spark, settings, monkeypatch, out):
    key, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    parquet = DataFrameWriter.parquet

    def watched(writer, path, *args, **kwargs):
        seen.append(int(spark.conf.get(key, "0")))
        return parquet(writer, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    # One task, partitions in turn, also more of them than it keeps open.
    mixed = spark.range(0, 500, 1, 1).selectExpr("cast(id % 50 as int) as k", "id", "nullif(id % 7, 3) as n")
    write_lake(mixed, out, ["k", "n"])
    write_lake(mixed, out + "-again", ["k", "n"])
    write_lake(mixed, out + "-again", ["k", "n"], "replace_partitions")
    assert seen == [32] * 3 and spark.conf.get(key, "0") == "0"
    for path in (out, out + "-again"):
        assert row_set(read_lake(spark, path).select("k", "id", "n")) == row_set(mixed)
    settings(key, "4")
    with pytest.raises(AnalysisException):
        write_lake(mixed, out, ["k", "n"])
    assert seen[-1] == 4 and spark.conf.get(key) == "4"


def test_read_files_with_different_columns(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.sql("select 1 as x, 'p' as y").write.parquet(a)
    spark.sql("select 'q' as y, 2 as x, 3 as z").write.parquet(b)
    got = read_files(spark, [a, b], same_schema=False)
    assert row_set(got) == [(1, "p", None), (2, "q", 3)]
    csv = str(tmp_path / "c")
    spark.sql("select 1 as x, 'p' as y").write.csv(csv, header=True)
    got = read_files(spark, [csv], "csv", {"header": True}, schema="x int, y string")
    assert rows(got) == [(1, "p")]


def test_delimited(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text('id;name;note\n1;"a;b";\n\n2;c;"say ""hi"""\n')
    df = read_delimited(spark, str(path), sep=";")
    assert df.dtypes == [("id", "string"), ("name", "string"), ("note", "string")]
    assert rows(df)[0] == ("1", "a;b", None) and df.count() == 2
    assert read_delimited(spark, str(path), sep=";", header=False).columns[0] == "_c0"
    raw = read_raw_rows(spark, str(path))
    assert rows(raw)[:2] == [("id;name;note",), ('1;"a;b";',)] and raw.count() == 3


def test_value_counts_csv(spark, out):
    counts = spark.createDataFrame(
        [(10.0, 2), (None, 1), (9.0, 3), (11.0, 4)], "c double, records long"
    )
    write_value_counts_csv(counts, "c", out, n=3)
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) == 1
    with open(os.path.join(out, files[0])) as f:
        assert f.readline() == "c,count\n"
    assert rows(read_delimited(spark, out)) == [(None, "1"), ("9.0", "3"), ("10.0", "2")]


def test_awkward_values_survive_csv(spark, out):
    values = [" x", "x", "x ", "a\nb", "a\r\nb", "", None, '"', 'a"b', "\\", "a\\", '\\"', "a,b", "\\N", "#c"]
    counts = spark.createDataFrame([("t", v, 1) for v in values], "t string, value string, records long")
    write_csv_tables(counts, f"{out}/tables", "t")
    found = rows(read_exported(spark, f"{out}/tables").select("value"))
    assert sorted(found, key=str) == sorted([(v,) for v in values], key=str)
    write_value_counts_csv(counts, "value", f"{out}/counts")
    found = rows(read_exported(spark, f"{out}/counts").select("value"))
    assert sorted(found, key=str) == sorted([(v,) for v in values], key=str)


def test_partition_values_with_a_fraction_fail(spark):
    for value in (4.7, 1e12, float("nan")):
        df = spark.createDataFrame([(value,)], "m double")
        with pytest.raises(Exception, match="no whole number"):
            whole_partition_values(df, ["m"]).collect()
    df = spark.createDataFrame([(4.0,), (None,)], "m double")
    assert rows(whole_partition_values(df, ["m"])) == [(4,), (None,)]


def test_csv_tables(spark, out):
    df = spark.createDataFrame([("a", "060", "x, y"), ("b", "1", "z")], "t string, key string, value string")
    write_csv_tables(df, out, "t")
    assert rows(read_delimited(spark, f"{out}/t=a")) == [("060", "x, y")]


def test_roundtrip(spark, records, out):
    assert row_set(roundtrip(spark, records, out)) == row_set(records)


def test_scratch_lies_in_the_session_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert first.startswith(base) and first != second
