"""Input files of different columns: layouts, scans by header, the ingest manifest."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from recordlake.operators import failed_checks
from recordlake.plans import build_raw_lake, visits
from recordlake.sources import (
    column_counts,
    file_layouts,
    first_lines,
    ingest_manifest,
    missing_columns,
    read_files,
    read_lake,
    read_manifest,
    write_manifest,
)
from tests.helpers import plan, row_set, rows

HEADER = {"header": True}


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def test_as_many_scans_as_headers(spark, tmp_path):
    headers = ["a,b,c", "c,a", "b"]
    for i in range(2000):
        header = headers[i % 3]
        write(tmp_path, f"{i}.csv", header + "\n" + ",".join(f"{c}{i}" for c in header.split(",")) + "\n")
    began = time.perf_counter()
    got = read_files(spark, [str(tmp_path)], "csv", HEADER)
    assert plan(got).count("FileScan csv") == 3
    assert sorted(got.columns) == ["a", "b", "c"] and got.count() == 2000
    assert got.where("a is null").count() == 666 and got.where("b is null").count() == 667
    assert rows(got.where("a = 'a0'").select("a", "b", "c")) == [("a0", "b0", "c0")]
    assert time.perf_counter() - began < 120


def test_a_large_file_is_not_read_for_its_header(spark, tmp_path, settings):
    settings("spark.sql.files.maxPartitionBytes", "200k")
    large = "x,y\n" + "".join(f"{i},{'z' * 90}\n" for i in range(30_000))
    paths = [write(tmp_path, "large.csv", large), write(tmp_path, "small.csv", "\n \ny,x\n1,2\n")]
    found = {os.path.basename(r["file"]): r["line"] for r in first_lines(spark, paths).collect()}
    assert found == {"large.csv": "x,y", "small.csv": "y,x"}
    assert spark.conf.get("spark.sql.files.openCostInBytes") != "200k"
    got = read_files(spark, paths, "csv", HEADER)
    assert got.count() == 30_001 and rows(got.where("x = '2'").select("y"))[0][0] in ("1", "z" * 90)


def test_odd_names_and_blank_files(spark, tmp_path):
    names = ["with blank.csv", "100%.csv", "a[1].csv", "{b}.csv", "c*.csv", "é.csv"]
    paths = [write(tmp_path, name, f"n,i\n{i},x\n") for i, name in enumerate(names)]
    write(tmp_path, "blank.csv", "")
    write(tmp_path, "lines.csv", "\n\n")
    got = read_files(spark, [str(tmp_path)], "csv", HEADER)
    assert sorted(r["n"] for r in got.collect()) == [str(i) for i in range(len(paths))]
    only_blank = read_files(spark, [str(tmp_path / "blank.csv")], "csv", HEADER)
    assert only_blank.count() == 0


def test_a_schema_goes_by_name(spark, tmp_path):
    paths = [
        write(tmp_path, "a.csv", "i,s,d\n1,x,2.5\n"), write(tmp_path, "b.csv", "d,i\n3.5,2\n"),
        write(tmp_path, "c.csv", "extra,s\nq,y\n"),
    ]
    got = read_files(spark, paths, "csv", HEADER, schema="s string, i int, d double, none date")
    assert got.dtypes == [("s", "string"), ("i", "int"), ("d", "double"), ("none", "date")]
    assert row_set(got) == sorted(
        [("x", 1, 2.5, None), (None, 2, 3.5, None), ("y", None, None, None)], key=lambda r: [(v is not None, str(v)) for v in r]
    )


def test_comments_before_a_header(spark, tmp_path):
    path = write(tmp_path, "a.csv", "# made by hand\na;b\n1;2\n")
    options = {"header": True, "comment": "#", "sep": ";"}
    assert rows(read_files(spark, [path], "csv", options)) == [("1", "2")]


def test_json_files_are_one_scan(spark, tmp_path):
    paths = [write(tmp_path, "a.json", '{"x": 1}\n'), write(tmp_path, "b.json", '{"y": "p", "x": 2}\n')]
    got = read_files(spark, paths, "json")
    assert plan(got).count("FileScan json") == 1 and row_set(got) == [(1, None), (2, "p")]


def test_layouts_of_parquet_files(spark, tmp_path):
    paths = [str(tmp_path / n) for n in "abcd"]
    for i, path in enumerate(paths):
        spark.range(3).selectExpr("id", *(["id as more"] if i % 2 else [])).write.parquet(path)
    found = file_layouts(spark, paths)
    assert [(x.columns, x.paths) for x in found] == [
        (("id",), (paths[0], paths[2])), (("id", "more"), (paths[1], paths[3])),
    ]
    assert file_layouts(spark, []) == []


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_the_manifest_tells_each_files_columns(spark, tmp_path, out, fmt):
    schema, options = "y int, m int, v string", dict(HEADER) if fmt == "csv" else {}
    parts = [
        spark.sql("select 2016 as y, 1 as m, 'a' as v").coalesce(1),
        spark.sql("select 2016 as y, explode(array(1, 2, 2)) as m").coalesce(1),
        spark.sql("select 2016 as y, 2 as m, 'a' as v").where("false"),
    ]
    paths = [str(tmp_path / f"in{i}") for i in range(3)]
    for part, path in zip(parts, paths):
        part.write.format(fmt).options(**options).save(path)
    manifest = ingest_manifest(spark, paths, fmt, ["y", "m"], options, schema if fmt == "csv" else None)
    assert plan(manifest).count("FileScan") == 2
    found = [(r["columns"], r["n_columns"], r["records"], r["y"], r["m"]) for r in manifest.collect()]
    assert sorted(found) == [
        (["y", "m"], 2, 1, 2016, 1), (["y", "m"], 2, 2, 2016, 2), (["y", "m", "v"], 3, 1, 2016, 1),
    ]
    assert row_set(column_counts(manifest, ["y", "m"], 3)) == [(2016, 1, 2), (2016, 2, 2)]
    assert row_set(column_counts(manifest, ["y", "m"], 2)) == [(2016, 1, 3), (2016, 2, 2)]
    odd = missing_columns(manifest, ["y", "m", "v"]).collect()
    assert [(r["missing"], r["unexpected"]) for r in odd] == [(["v"], [])]
    spark.range(1).selectExpr("id", "2016 as y", "1 as m").write.partitionBy("y", "m").parquet(out)
    write_manifest(manifest, out, ["y", "m"])
    assert read_lake(spark, out).count() == 1 and read_manifest(spark, out).count() == 3


def test_a_file_that_lacks_a_column_fails_its_month(spark, out):
    base = os.path.join(out, "files")
    nulls = [F.lit(None).cast(t).alias(n) for n, t in visits.RAW_COLUMNS if n not in ("cicid", "i94yr", "i94mon")]
    for number in (1, 2, 3):
        month = spark.range(4).select(
            F.col("id").cast("double").alias("cicid"), F.lit(2016.0).alias("i94yr"),
            F.lit(float(number)).alias("i94mon"), *nulls,
        )
        month = month.drop("gender", "occup") if number == 2 else month
        month.write.parquet(f"{base}/i94_{visits.MONTH_NAMES[number - 1]}16_sub.parquet")
    raw = os.path.join(out, "raw")
    failed = failed_checks(build_raw_lake(spark, base, raw, ["16"], ["jan", "feb", "mar"]))
    assert rows(failed.select("check", "subject", "observed", "expected")) == [
        ("column_count", "i94yr=2016/i94mon=2", 26, 28)
    ]
    lacking = missing_columns(read_manifest(spark, raw), [n for n, _ in visits.RAW_COLUMNS])
    assert {tuple(sorted(r["missing"])) for r in lacking.collect()} == {("gender", "occup")}
    assert failed_checks(build_raw_lake(spark, base, raw, ["16"], ["jan"])).where("subject like '%=1'").count() == 0
