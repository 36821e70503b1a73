"""Files of many dialects load as a public sniffing reader loads them."""

from __future__ import annotations

import random

import duckdb
import pytest

from stateloom.sources import dialects, digests
from stateloom.sources.dialects import Dialect, detect
from stateloom.sources.headers import column_names
from stateloom.sources.statements import read_group

from .conftest import write_text

FILES = {
    "separator in a quoted name": ('"a;b",c\n1,2\n3,4\n', Dialect(",")),
    "separator in a bare name": ("a;b,c\n1,2\n3,4\n", Dialect(",")),
    "more of another separator in names": ("sum; eur; net,c\n1,2\n3,4\n5,6\n", Dialect(",")),
    "single quotes": ("'a,b','c'\n'1,2','3'\n'x','y'\n", Dialect(",", "'", "'")),
    "single quotes that all hide a separator": ("'a,b','c'\n'1,2','3'\n", Dialect(",", "'", "'")),
    "doubled single quotes": ("a;b\n'1;2';'3'\n'x';'it''s'\n", Dialect(";", "'", "'")),
    "backslash": ('a,b\n"say \\"x\\", y",2\n"z",3\n', Dialect(",", '"', "\\")),
    "tab": ("a\tb\n1\t2\n", Dialect("\t")),
    "pipe": ("a|b\n1|2\n", Dialect("|")),
    "one column": ("a\n1\n2\n", Dialect(",")),
    "header only": ("a;b\n", Dialect(";")),
    "quote in a value": ('a,b\n5" pipe,2\n"q",3\n', Dialect(",")),
    "quote that never closes": ('a,b\n"5 inch,2\nx,3\n', Dialect(",", "", "")),
    "header over two lines": ('"a\nb",c\n1,2\n3,4\n', Dialect(",")),
    "commas in prose": ("id;text\n1;a, b, c\n2;d, e\n3;f\n", Dialect(";")),
    "apostrophes": ("a,b\n'tis,2\n'twas,3\n", Dialect(",")),
    "both quotes": ("a;b\n\"x;1\";'y'\n\"z\";'w'\n", Dialect(";")),
    "separator at the end": ("a;b;\n1;2;\n3;4;\n", Dialect(";")),
    "returns": ("a;b\r\n1;2\r\n", Dialect(";")),
    "returns alone": ("a;b\r1;2\r3;4\r", Dialect(";")),
    "blank first line": ("\na,b\n1,2\n", Dialect(",")),
    "no name": ("a,,c\n1,2,3\n", Dialect(",")),
    "no line end": ('a;b\n1;"x;y"', Dialect(";")),
    "break in single quotes": ("a,b\n'x\ny','1'\n'z','2'\n", Dialect(",", "'", "'")),
}


@pytest.mark.parametrize("name", FILES)
def test_loads_like_the_sniffing_reader(spark, tmp_path, name):
    text, dialect = FILES[name]
    path = str(write_text(tmp_path / "f.csv", ""))
    with open(path, "w", encoding="utf-8", newline="") as out:
        out.write(text)
    found = digests.scan_file(path)
    assert Dialect(found.separator, found.quote, found.escape) == dialect
    columns = column_names(found.header, dialect)
    rows = read_group(spark, [path], columns, dialect, found.quoted_breaks).drop("__file")
    want = duckdb.sql(f"from read_csv_auto('{path}', header=true, all_varchar=true)")
    assert rows.columns == want.columns
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_decimal_commas_do_not_win_over_the_header():
    assert detect("a;b\n1,5;2,5\n3,5;4,5\n", True)[0] == Dialect(";")


def test_rows_that_mostly_fit_keep_the_separator():
    assert detect("a,b,c\n1,2,3\n4,5\n", True)[0] == Dialect(",")


@pytest.mark.parametrize("whole", [True, False])
def test_a_cut_sample_is_judged_like_a_whole_one(whole):
    rng = random.Random(1)
    rows = [["n;1", "b,2", "c"]] + [[rng.choice(["x", "y;z", "q'r", 'w"w', "line\nbreak", ""]) for _ in range(3)] for _ in range(200)]
    for d in (Dialect(";"), Dialect("\t", "'", "'"), Dialect(",")):
        text = "".join(d.separator.join(d.quote + v.replace(d.quote, d.escape + d.quote) + d.quote for v in r) + "\n" for r in rows)
        for cut in (60, 200, 333, 1000) if not whole else (len(text),):
            got, header = detect(text[:cut], whole)
            assert got == d and column_names(header, got) == rows[0], (d, cut)


def test_long_header_is_taken_whole(tmp_path, monkeypatch):
    monkeypatch.setattr(digests, "SAMPLE", 50)
    monkeypatch.setattr(digests, "CHUNK", 7)
    header = ";".join(f'"name; {i}, ü"' for i in range(60))
    path = write_text(tmp_path / "f.csv", header + "\n" + ";".join("1" * 60) + "\n")
    found = digests.scan_file(str(path))
    assert found.header == header and found.separator == ";" and not found.quoted_breaks


def test_nothing_and_blank_lines():
    assert detect("", True) == (Dialect(","), None)
    assert detect("\n\r\n", True) == (Dialect(","), None)
    assert dialects.parse("a,b\n", True, Dialect()).widths == [2]
