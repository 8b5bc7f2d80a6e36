from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from recordlake.operators import (
    Section,
    code_table,
    code_table_report,
    extract_code_tables,
    section_lines,
)
from recordlake.sources import number_lines, read_lines
from tests.helpers import row_set, rows

SECTIONS = [
    Section("country", "  value country", ""),
    Section("port", "  value $port", ";"),
    Section("mode", "value mode", "\t"),
    Section("kind", "/* KIND - three categories:", "*/"),
    Section("absent", "value absent", ";"),
]

TEXT = [
    "libname library 'Your file location' ;",
    "",
    "/* COUNTRY */",
    "  value country",
    "   582 =  'MEXICO Air Sea, and Not Reported'",
    "   101 =  'ALBANIA'",
    "   54 = 'No Code (54)' ;",
    "",
    "  value $port",
    "   'ALC'\t=\t'ALCAN, AK             '",
    "   'CP '\t=\t'No PORT Code (CP)'",
    "   a line that is no code",
    "   'NK' \t=\t'x = y'",
    "",
    "   'ZZ'\t=\t'after a blank line'",
    ";",
    "  value country",
    "   999 = 'a second section of the same name'",
    "",
    "value mode",
    "\t1 = 'Air'",
    "\t9 = 'Not reported' ;",
    "\t",
    "/* KIND - three categories:",
    "   1 = Business",
    "   2 = Pleasure",
]

EXPECTED = {
    "country": [
        ("101", "ALBANIA"), ("54", "No Code (54)"),
        ("582", "MEXICO Air Sea, and Not Reported"),
    ],
    "port": [
        ("ALC", "ALCAN, AK"), ("CP", "No PORT Code (CP)"), ("NK", "x = y"),
        ("ZZ", "after a blank line"),
    ],
    "mode": [("1", "Air"), ("9", "Not reported")],
    "kind": [("1", "Business"), ("2", "Pleasure")],
    "absent": [],
}


def write(folder, name, lines, end="\r\n"):
    path = os.path.join(folder, name)
    with open(path, "w", newline="") as f:
        f.write(end.join(lines) + end)
    return path


@pytest.mark.parametrize("end", ["\r\n", "\n"])
@pytest.mark.parametrize("broadcast_limit", [100_000, 0])
def test_sections(spark, tmp_path, end, broadcast_limit):
    write(tmp_path, "labels.txt", TEXT, end)
    tables = extract_code_tables(
        spark, str(tmp_path), SECTIONS, max_broadcast_sections=broadcast_limit
    )
    for section, pairs in EXPECTED.items():
        assert rows(code_table(tables, section)) == pairs


def sections_by_hand(lines, sections):
    """The lines within each section, by a plain walk through one file."""
    found = []
    for section in sections:
        if section.start not in lines:
            continue
        first = lines.index(section.start) + 1
        rest = lines[first:]
        last = rest.index(section.end) if section.end in rest else len(rest)
        found += [(section.name, line) for line in rest[:last]]
    return found


@pytest.mark.parametrize("broadcast_limit", [100_000, 0])
def test_random_texts(spark, tmp_path, settings, broadcast_limit):
    settings("spark.sql.files.maxPartitionBytes", "300")
    generator = random.Random(11)
    sections = [
        Section("a", "start a", ""), Section("b", "start b", ";"),
        Section("c", "start c", ""), Section("d", "start a", "\t"),
    ]
    markers = ["start a", "start b", "start c", "", ";", "\t"]
    want = []
    for number in range(30):
        lines = [
            generator.choice(markers) if generator.random() < 0.15 else f"{number}.{i} = x"
            for i in range(generator.choice([0, 5, 60, 150]))
        ]
        write(tmp_path, f"{number}.txt", lines or ["nothing"])
        want += [(f"{number}", *found) for found in sections_by_hand(lines, sections)]
    found = section_lines(spark, str(tmp_path), sections, broadcast_limit)
    number = F.regexp_extract("file", r"(\d+)\.txt", 1)
    assert sorted(rows(found.select(number, "section", "line"))) == sorted(want)
    assert len(want) > 500


@pytest.mark.parametrize("broadcast_limit", [100_000, 0])
def test_a_file_read_in_many_splits(spark, tmp_path, settings, broadcast_limit):
    settings("spark.sql.files.maxPartitionBytes", "2000")
    codes = [f" {i} = 'label {i}'" for i in range(2000)]
    write(tmp_path, "big.txt", ["", ";", "value big", *codes, ";", " 1 = 'outside'"])
    write(tmp_path, "small.txt", ["value big", " 5 = 'five'", ";", " 6 = 'outside'"])
    lines = read_lines(spark, str(tmp_path))
    assert lines.select("file", "block").distinct().count() > 10
    tables = extract_code_tables(
        spark, str(tmp_path), [Section("big", "value big", ";")],
        numeric_key=True, max_broadcast_sections=broadcast_limit,
    )
    want = [(i, f"label {i}") for i in range(2000)] + [(5, "five")]
    assert sorted(rows(tables.select("key", "value"))) == sorted(want)


def test_line_numbers(spark, tmp_path, settings):
    settings("spark.sql.files.maxPartitionBytes", "1500")
    texts = {name: [f"{name} {i}" if i % 7 else "" for i in range(n)]
             for name, n in (("a", 900), ("b", 3), ("c", 450))}
    for name, lines in texts.items():
        write(tmp_path, name + ".txt", lines)
    numbered = number_lines(read_lines(spark, str(tmp_path))).withColumn(
        "file", F.regexp_extract("file", r"([a-c])\.txt", 1)
    )
    want = [(n, i, line) for n, lines in texts.items() for i, line in enumerate(lines, 1)]
    assert sorted(rows(numbered)) == sorted(want)


def test_report(spark, tmp_path):
    write(tmp_path, "labels.txt", TEXT)
    got = row_set(code_table_report(spark, str(tmp_path), SECTIONS))
    assert got == [
        ("absent", 0, 0, 0), ("country", 1, 3, 0), ("kind", 1, 2, 0), ("mode", 1, 2, 0),
        ("port", 1, 4, 2),
    ]
