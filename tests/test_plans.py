"""The composed jobs, end to end, on small hand-made visit records."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from recordlake.functions import cols
from recordlake.plans import (
    analyst,
    build_enriched_lake,
    build_raw_lake,
    code_table_checks,
    enriched_lake_checks,
    enriched_records,
    export_code_tables,
    export_column_profile,
    export_value_counts,
    key_study,
    mode_port_counts,
    port_presence_by_mode,
    read_code_tables,
    visits,
)
from recordlake.operators import failed_checks, require_all_passed
from recordlake.sources import read_delimited, read_lake
from tests.helpers import plan, row_set, rows

LABELS = "\r\n".join(
    [
        "/* I94CIT & I94RES */", "  value i94cntyl", "   582 =  'MEXICO Air Sea (I-94, no land)'",
        "   101 =  'ALBANIA'", "   996 =  'No Country Code (996)' ;", "",
        "  value $i94prtl", "   'ALC'\t=\t'ALCAN, AK             '", "   '060'\t=\t'No PORT Code (60)'",
        "   'NK' \t=\t'No PORT Code (NK)'", ";", "",
        "value i94model", "\t1 = 'Air'", "\t2 = 'Sea'", "\t9 = 'Not reported' ;", "\t", "",
        "value i94addrl", "\t'AL'='ALABAMA'", "\t'99'='All Other Codes' ;", "",
        "/* I94VISA - Visa codes collapsed into three categories:", "   1 = Business",
        "   2 = Pleasure", "   3 = Student", "*/", "", "",
    ]
)


def record(month, cicid, **values):
    base = dict.fromkeys([name for name, _ in visits.RAW_COLUMNS])
    base.update(
        i94yr=2016.0, i94mon=float(month), cicid=float(cicid), count=1.0,
        arrdate=20454.0 + 31 * (month - 1), i94visa=2.0, visatype="B2", i94port="ALC",
        i94addr="AL", i94cit=582.0, i94res=101.0, i94mode=1.0, admnum=5e9 + cicid,
    )
    base.update(values)
    return tuple(base[c] for c in [name for name, _ in visits.RAW_COLUMNS])


RECORDS = [
    record(1, 1, depdate=None, i94mode=None, i94bir=-3.0),
    record(1, 2, depdate=-14388.0, i94mode=0.0, i94addr="**", i94bir=1812.0),
    record(1, 3, depdate=20484.0, i94cit=999.0, i94addr=None, insnum="'2868"),
    record(6, 1, i94visa=1.0, visatype="B1", biryear=204.0, i94port="060"),
    record(6, 2, i94visa=3.0, visatype="F1", dtaddto="-00-0000"),
    record(7, 1, i94visa=None, visatype="F1", dtaddto="/   183D"),
]


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """Monthly files, a raw lake, code tables and an enriched lake."""
    base = tmp_path_factory.mktemp("world")
    files, raw, codes, enriched = (str(base / n) for n in ("files", "raw", "codes", "i94e"))
    frame = spark.createDataFrame(RECORDS, visits.raw_schema())
    for number in (1, 6, 7):
        name = visits.MONTH_NAMES[number - 1]
        frame.where(F.col("i94mon") == number).write.parquet(f"{files}/i94_{name}16_sub.parquet")
    checks = build_raw_lake(spark, files, raw, ["16"], ["jan", "jun", "jul"])
    text = base / "labels.txt"
    text.write_bytes(LABELS.encode())
    export_code_tables(spark, str(text), codes)
    tables = read_code_tables(spark, codes)
    build_enriched_lake(spark, raw, tables, enriched)
    return {"raw": raw, "codes": codes, "enriched": enriched, "tables": tables, "checks": checks,
            "frame": frame, "files": files}


def test_raw_lake(spark, world):
    require_all_passed(world["checks"])
    assert world["checks"].count() == 9
    lake = read_lake(spark, world["raw"])
    assert len(lake.columns) == visits.RAW_COLUMN_COUNT
    assert lake.columns[-2:] == ["i94yr", "i94mon"]
    assert os.path.isdir(os.path.join(world["raw"], "i94yr=2016", "i94mon=1"))


def test_raw_lake_reports_a_missing_month(spark, world, out):
    os.makedirs(out)
    empty = os.path.join(out, "files")
    world["frame"].where("i94mon = 1").write.parquet(f"{empty}/i94_jan16_sub.parquet")
    world["frame"].where("false").write.parquet(f"{empty}/i94_feb16_sub.parquet")
    checks = build_raw_lake(spark, empty, os.path.join(out, "raw"), ["16"], ["jan", "feb"])
    failed = failed_checks(checks).select("check", "subject")
    assert rows(failed) == [("not_empty", "i94yr=2016/i94mon=2")]


def test_code_tables(world):
    require_all_passed(code_table_checks(world["tables"]))
    tables = world["tables"]
    assert row_set(tables["i94port"]) == [
        ("060", "No PORT Code (60)"), ("ALC", "ALCAN, AK"), ("NK", "No PORT Code (NK)"),
    ]
    assert row_set(tables["i94mode"]) == [("1", "Air"), ("2", "Sea"), ("9", "Not reported")]
    assert tables["i94visa"].count() == 3 and tables["i94addr"].count() == 2
    assert tables["i94cntyl"].count() == 3


def test_enriched_records(spark, world):
    lake = read_lake(spark, world["enriched"])
    got = {r["guid"]: r for r in lake.collect()}
    assert len(got) == 6 and set(lake.columns) == set(visits.ENRICHED_COLUMNS)
    first, second, third = (got[f"2016-01-{i}"] for i in (1, 2, 3))
    assert first["arrival_date"] == date(2016, 1, 1) and first["departure_date"] is None
    assert second["departure_date"] == date(1920, 8, 10)
    assert third["departure_date"] == date(2016, 1, 31)
    assert first["i94mode_value"] is None and second["i94mode_value"] is None
    assert third["i94mode_value"] == "Air" and third["i94cit_value"] is None
    assert first["i94cit_value"] == "MEXICO Air Sea (I-94, no land)"
    assert first["i94res_value"] == "ALBANIA" and second["i94addr_value"] is None
    assert got["2016-06-1"]["i94port_value"] == "No PORT Code (60)"
    assert got["2016-07-1"]["i94visa_value"] is None
    assert third["insnum"] == "'2868" and second["i94bir"] == 1812.0
    require_all_passed(enriched_lake_checks(read_lake(spark, world["raw"]), lake))


def test_enriched_column_order(world):
    frame = enriched_records(world["frame"], world["tables"])
    assert tuple(frame.columns) == visits.ENRICHED_COLUMNS and len(frame.columns) == 36
    text = plan(frame)
    assert "Python" not in text and "SortMergeJoin" not in text


def test_rebuild_of_months(spark, world, out):
    build_enriched_lake(spark, world["raw"], world["tables"], out)
    before = row_set(read_lake(spark, out).select(*cols(visits.ENRICHED_COLUMNS)))
    months = [{"i94yr": 2016, "i94mon": m} for m in (6, 7)]
    for _ in range(2):
        build_enriched_lake(spark, world["raw"], world["tables"], out, partitions=months)
        assert row_set(read_lake(spark, out).select(*cols(visits.ENRICHED_COLUMNS))) == before


@pytest.mark.parametrize("bad", [("101", "AGAIN"), ("101.0", "SAME NUMBER"), (None, "NO KEY")])
def test_bad_lookup_keys_stop_the_build(spark, world, out, bad):
    extra = spark.createDataFrame([bad], "key string, value string")
    tables = dict(world["tables"])
    tables["i94cntyl"] = tables["i94cntyl"].unionAll(extra)
    with pytest.raises(ValueError, match="i94cntyl"):
        build_enriched_lake(spark, world["raw"], tables, out)
    assert not os.path.exists(out)


def test_analyst_queries(spark, world):
    lake = analyst.months_of_year(read_lake(spark, world["enriched"]), 2016, [6, 7, 8])
    assert rows(analyst.label_type_counts(lake)) == [
        (2016, 6, "Business", "B1", 1), (2016, 6, "Student", "F1", 1), (2016, 7, None, "F1", 1),
    ]
    assert rows(analyst.month_counts(lake)) == [(2016, 6, 2), (2016, 7, 1)]
    assert rows(analyst.type_counts(lake))[0] == (2016, 6, "B1", 1)
    assert rows(analyst.label_counts(lake))[2] == (2016, 7, None, 1)
    shares = rows(analyst.month_shares(read_lake(spark, world["raw"])))
    assert shares == [(2016, 1, 3, 50.0), (2016, 6, 2, 2 / 6 * 100), (2016, 7, 1, 1 / 6 * 100)]
    analyst.register({"df_i94e": lake})
    by_name = "select i94mon, count(*) as n from df_i94e group by 1 order by 1"
    assert rows(spark.sql(by_name)) == [(6, 2), (7, 1)]
    in_braces = analyst.query(spark, "select count(*) from {lake}", lake=lake)
    assert rows(in_braces) == [(3,)]


def test_studies(spark, world):
    lake = read_lake(spark, world["raw"])
    study = key_study(lake)
    assert study.repeated_in_partition.count() == 0
    assert row_set(study.repeated) == [(1.0, 3), (2.0, 2)]
    assert study.repeated_records.count() == 5
    assert rows(study.records_per_id) == [(1, 3)]
    assert study.sequences.where("starts_at_one and ends_at_count").count() == 3
    assert rows(port_presence_by_mode(lake))[0] == (None, "Y", 1)
    assert (1.0, "060", 1) in rows(mode_port_counts(lake))


def test_profile_export(spark, world, out):
    export_column_profile(spark, world["raw"], out, n=2)
    got = read_delimited(spark, out)
    assert got.select("column_name").distinct().count() == 28
    months = rows(got.where("column_name = 'i94mon'").select("value", "records"))
    assert sorted(months) == [("1", "3"), ("6", "2")]
    one = os.path.join(out, "one")
    export_value_counts(read_lake(spark, world["raw"]), "admnum", one, n=3, near_unique=True)
    assert rows(read_delimited(spark, one)) == [
        ("5.000000001E9", "3"), ("5.000000002E9", "2"), ("5.000000003E9", "1"),
    ]
