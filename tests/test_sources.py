"""Discovery, fingerprints, headers and heterogeneous statement files."""

from __future__ import annotations

import datetime as dt
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from stateloom.operators.mapping import mapped_projection
from stateloom.plans.ingest import ingest
from stateloom.plans.warehouse import Warehouse
from stateloom.sources import digests
from stateloom.sources.files import classify, statement_files, with_digests
from stateloom.sources.dialects import Dialect, detect
from stateloom.sources.headers import clean_header, column_names
from stateloom.sources.mappings import bundled_mapping, mapping_rows, read_mapping
from stateloom.sources.mappings import BUNDLED

from .conftest import LATER, RUN1, RUN2, inbox, tuples, write_text

LEDGER_KEYS = "src_path string, md5 string"


def test_discovery_levels_and_names(spark, tmp_path):
    root = tmp_path / "My Data+1"
    write_text(inbox(root) / "2024" / "q1" / "a.csv", "id\n1\n")
    write_text(inbox(root, "My Bank%20", "cards") / "b.csv", "id\n1\n")
    write_text(inbox(root) / "C.CSV", "id\n1\n")
    write_text(inbox(root) / "notes.txt", "id\n1\n")
    write_text(root / "To Parse" / "Bank" / "T-Bank" / "no_type.csv", "id\n1\n")
    files = statement_files(spark, str(root))
    assert tuples(files, "src_path", "bank", "table_name", "file_name", "size") == [
        ("To Parse/Bank/My Bank%20/cards/b.csv", "My Bank%20", "my_bank_20_cards", "b.csv", 5),
        ("To Parse/Bank/T-Bank/transactions/2024/q1/a.csv", "T-Bank", "t_bank_transactions", "a.csv", 5),
    ]
    assert statement_files(spark, str(root), any_case=True).count() == 3
    assert statement_files(spark, str(tmp_path / "nowhere")).count() == 0
    # odd characters in paths survive the load as well
    warehouse = Warehouse(spark, str(tmp_path / "house"))
    assert ingest(spark, warehouse, str(root), RUN1, "r1", LATER) == {"ingested": 2, "skipped": 0}
    assert warehouse.raw("my_bank_20_cards").read().count() == 1


@pytest.mark.parametrize("chunk", [1, 3, 1 << 22])
def test_digest_header_and_line_breaks(spark, tmp_path, monkeypatch, chunk):
    long_header = ";".join(f'"column {i}"' for i in range(900))
    wrapped = {"wrapped.csv": 'id,name\n1,"a\nb"\n', "last.csv": 'id;name\r\n1;"a\r\n"'}
    texts = {
        "plain.csv": "id,name\n1,x\n", "blank.csv": "\n", "no_newline.csv": "id,name", "quotes.csv": 'id,name\n1,"a""b"\n2,"c"\n3,""\n',
        "кириллица.csv": "Сумма;Дата\n1;2\n", "wide.csv": long_header + "\n" + "1;" * 899 + "1\n",
        "stray.csv": 'id,name\n1,5" pipe\n2,x\n', "escaped.csv": 'id,name\n1,"say ""x"""\n2,"a,b"\n', **wrapped,
    }
    for name, text in texts.items():
        write_text(inbox(tmp_path) / name, text)
        assert len(text) < 100_000
    monkeypatch.setattr(digests, "CHUNK", chunk)
    direct = {name: digests.scan_file(str(inbox(tmp_path) / name)) for name in texts if chunk > 1 or name != "wide.csv"}
    for name, found in direct.items():
        first = texts[name].split("\n")[0].removesuffix("\r")
        assert (found.md5, found.header, found.quoted_breaks) == (hashlib.md5(texts[name].encode()).hexdigest(), first, name in wrapped), name
    by_spark = tuples(with_digests(statement_files(spark, str(tmp_path))), "file_name", *digests.Scanned._fields)
    assert {r[0]: r[1:] for r in by_spark if r[0] in direct} == direct


def test_classify_by_path_and_bytes(spark, tmp_path):
    folder = inbox(tmp_path)
    for name in ("known", "changed", "copy", "fresh"):
        write_text(folder / f"{name}.csv", f"id\n{'known' if name == 'copy' else name}\n")
    old = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc).timestamp()
    for path in folder.iterdir():
        os.utime(path, (old, old))
    write_text(folder / "moving.csv", "id\n9\n")
    now = dt.datetime.fromtimestamp((folder / "moving.csv").stat().st_mtime + 3, dt.timezone.utc)
    base = "To Parse/Bank/T-Bank/transactions/"
    ledger = spark.createDataFrame(
        [(base + "known.csv", hashlib.md5(b"id\nknown\n").hexdigest()), (base + "changed.csv", "0" * 32)], LEDGER_KEYS
    )
    files = with_digests(statement_files(spark, str(tmp_path)))
    assert tuples(classify(files, ledger, now), "file_name", "state") == [
        ("changed.csv", "new"), ("copy.csv", "new"), ("fresh.csv", "new"), ("known.csv", "known"), ("moving.csv", "unsettled")
    ]
    later = now + dt.timedelta(seconds=6)
    assert classify(files, ledger, later).filter("state = 'unsettled'").count() == 0


def test_header_names(spark):
    df = spark.createDataFrame([("\ufeffid;x\r",)], "h string")
    assert df.select(clean_header(F.col("h"))).first()[0] == "id;x"
    assert column_names("id,id,ID,,x", Dialect()) == ["id", "id_1", "ID_2", "column3", "x"]
    assert column_names('"a;b";c', Dialect(";")) == ["a;b", "c"]
    assert column_names("'a\nb','it''s'", Dialect(",", "'", "'")) == ["a\nb", "it's"]
    assert column_names('"a\\"b","c"', Dialect(",", '"', "\\")) == ['a"b', "c"]
    assert column_names('"a,b', Dialect(",", "", "")) == ['"a', "b"]
    with pytest.raises(ValueError, match="does not end"):
        column_names('"a', Dialect())


def test_differing_files_of_one_table(spark, tmp_path):
    folder = inbox(tmp_path, "Any", "rows")
    write_text(folder / "0_empty.csv", "")  # Spark lists no empty files: not loaded, not counted
    write_text(folder / "0_blank.csv", "\n")
    write_text(folder / "1_first.csv", 'id,name,amount\n1,x,10\n1,x,10\n2,"",\n')
    write_text(folder / "2_reordered.csv", "amount;id;name\n30;3;z\n")
    write_text(folder / "3_missing.csv", "id,amount\n4,40\n")
    write_text(folder / "4_extra.csv", "id,name,amount,note\n1,x,10,n\n")
    write_text(folder / "5_wrapped.csv", 'id,name,amount\n5,"line\nbreak",50\n')
    write_text(folder / "6_copy.csv", "id,name,amount\n1,x,10\n")
    warehouse = Warehouse(spark, str(tmp_path / "house"))
    assert ingest(spark, warehouse, str(tmp_path), RUN1, "r1", LATER) == {"ingested": 7, "skipped": 0}
    raw = warehouse.raw("any_rows").read()
    assert raw.columns == ["__load_key", "id", "name", "amount", "__ingested_at"]
    assert tuples(raw, "id", "name", "amount") == sorted(
        [
            ("1", "x", "10"),  # twice in its file, once here
            ("2", None, None), ("3", "z", "30"), ("4", None, "40"),
            ("1", "x", "10"),  # under another key, since its file has one column more
            ("5", "line\nbreak", "50"),
            ("1", "x", "10"),  # the same row of another file
        ],
        key=repr,
    )
    ones = [r[0] for r in raw.filter("id = '1'").select("__load_key").collect()]
    assert len(ones) == 3 and len(set(ones)) == 2
    assert raw.filter("id = '3'").first()["__load_key"] == hashlib.md5(b"2:30|1:3|1:z").hexdigest()
    assert warehouse.ledger_rows().count() == 7


def test_failed_load_leaves_no_trace_and_is_retried(spark, tmp_path):
    folder = inbox(tmp_path, "Any", "rows")
    write_text(folder / "a.csv", "id,name\n1,x\n")
    warehouse = Warehouse(spark, str(tmp_path / "house"))
    ingest(spark, warehouse, str(tmp_path), RUN1, "r1", LATER)
    bad = write_text(folder / "b.csv", "id,name\n2,y\n3\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        ingest(spark, warehouse, str(tmp_path), RUN2, "r2", LATER)
    assert tuples(warehouse.raw("any_rows").read(), "id") == [("1",)]
    assert warehouse.ledger_rows().count() == 1
    write_text(bad, "id,name\n2,y\n3,z\n")
    assert ingest(spark, warehouse, str(tmp_path), RUN2, "r3", LATER) == {"ingested": 1, "skipped": 1}
    # no build has staged the first file yet, so its row stays
    assert tuples(warehouse.raw("any_rows").read(), "id") == [("1",), ("2",), ("3",)]


def test_mapping_file_reads_like_the_bundled_one(spark):
    rows = mapping_rows(read_mapping(spark, str(BUNDLED)), "t_bank")
    assert rows == bundled_mapping() and len(rows) == 15
    with pytest.raises(ValueError, match="no mapping rows"):
        mapped_projection(spark.createDataFrame([("k",)], "__load_key string"), rows, "other", RUN1)
