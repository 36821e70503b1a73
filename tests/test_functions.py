"""Keys, text forms and clock conversions, hazard by hazard."""

from __future__ import annotations

import datetime as dt
import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stateloom.functions import (
    business_key, cell_text, comma_decimal, date_text, double_text, int_text, load_key, local_date, local_text_to_utc,
    normalize_identifier, register_sql_functions,
)
from stateloom.functions.text import check_decimal


def column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def results(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_double_text_matches_duckdb(spark):
    random.seed(7)
    values = [0.0, -0.0, 1e7, 1e-4, 9.99e-5, 1e-3, 123456789.125, 9999999999999998.0, 1e16, 1.5e-7, 1e22, 499978590.0]
    values += [float("nan"), float("inf"), float("-inf"), None]
    values += [round(random.uniform(-1e9, 1e9), 2) * 1000 for _ in range(2000)]
    values += [random.uniform(-1, 1) * 10 ** random.randint(-8, 15) for _ in range(2000)]
    # where Java's digits are not always the fewest or the nearest
    values += [random.uniform(-1, 1) * 10 ** random.uniform(16, 31) for _ in range(20000)]
    values += [1e23, 2e23, -1e22, 9.2e22, 4.81e21, 8.7381e20, 7.35529617708e18, 2.0972688688303508e18, -3.5783296469592777e25, 2.0**63]
    want = [None if v is None else duckdb.execute("select cast(?::double as varchar)", [v]).fetchone()[0] for v in values]
    assert results(column(spark, values, "double"), double_text("x")) == want
    assert want[2] == "10000000.0" and want[3] == "0.0001" and want[6] == "123456789.125"


def test_load_key_matches_hashlib(spark):
    random.seed(8)
    rows = [
        tuple(random.choice([None, "", "a|b", "2:xy", "Кэшбэк", "<NULL>", "x" * random.randint(0, 40)]) for _ in range(3))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "`Б` string, a string, B string")

    def key(row):
        named = dict(zip(["Б", "a", "B"], row))
        return hashlib.md5(
            "|".join(f"{len(v)}:{v}" for v in ("<NULL>" if named[n] is None else named[n] for n in sorted(named))).encode()
        ).hexdigest()

    assert [r[0] for r in df.select(load_key(df)).collect()] == [key(r) for r in rows]


def test_load_key_depends_on_the_file_header_and_null_tag(spark):
    narrow = spark.createDataFrame([("1",)], "id string")
    wide = spark.createDataFrame([("1", None)], "id string, extra string")
    keys = [df.select(load_key(df)).first()[0] for df in (narrow, wide)]
    assert keys[0] != keys[1]
    tagged = spark.createDataFrame([("<NULL>",), (None,)], "id string")
    assert len({r[0] for r in tagged.select(load_key(tagged)).collect()}) == 1


def test_business_key_leaves_out_nulls_and_ignores_description(spark):
    when = dt.datetime(2025, 8, 19, 4, 9, 9)
    df = spark.createDataFrame(
        [(when, 1e7, None), (when, 1e7, "*1"), (None, None, "*1")], "t timestamp_ntz, a double, c string"
    )
    have = [r[0] for r in df.select(business_key("t_bank", "t", "a", "c")).collect()]
    texts = [
        "t_bank|2025-08-19 04:09:09|10000000.0|no_card_last4", "t_bank|2025-08-19 04:09:09|10000000.0|*1", "t_bank|*1"
    ]
    assert have == [hashlib.md5(t.encode()).hexdigest() for t in texts]


def test_local_text_to_utc_takes_the_later_instant(spark):
    register_sql_functions(spark)
    texts = ["19.08.2025 07:09:09", "27.10.1996 02:30:00", "26.10.2014 01:30:00", "1.2.2024 3:04:05", None]
    want = [
        dt.datetime(2025, 8, 19, 4, 9, 9), dt.datetime(1996, 10, 26, 23, 30), dt.datetime(2014, 10, 25, 22, 30),
        dt.datetime(2024, 2, 1, 0, 4, 5), None,
    ]
    df = column(spark, texts, "string")
    assert results(df, local_text_to_utc(F.col("x"))) == want
    assert results(df, F.expr("local_text_to_utc(x, 'd.M.yyyy H:m:s', 'Europe/Moscow')")) == want


def test_every_hour_of_thirty_years_agrees_with_duckdb(spark):
    hours = spark.range(0, 30 * 365 * 24, 1, 8).select(
        (F.lit("1995-01-01").cast("timestamp_ntz") + F.expr("make_dt_interval(0, cast(id as int))")).alias("t")
    )
    from stateloom.functions import local_to_utc

    have = hours.select(F.sum(F.xxhash64(F.lit(1)).cast("decimal(38,0)") * 0), F.count("*")).first()[1]
    rows = hours.select("t", local_to_utc(F.col("t")).alias("u")).filter(F.col("u") != F.col("t") - F.expr("INTERVAL 3 HOURS"))
    mine = {(r.t, r.u) for r in rows.collect()}
    theirs = duckdb.execute(
        "select t, u from (select t, (t at time zone 'Europe/Moscow') at time zone 'UTC' as u from "
        f"(select timestamp '1995-01-01' + to_hours(range) as t from range({have}))) where u <> t - interval 3 hour"
    ).fetchall()
    assert mine == set(theirs)


@pytest.mark.parametrize("zones", [("America/New_York", "UTC"), ("UTC", "America/New_York"), ("Europe/Moscow", "Etc/UTC")])
def test_conversion_does_not_depend_on_the_session_zone(spark, zones):
    from stateloom.functions import local_to_utc

    halves = spark.range(0, 30 * 365 * 48, 1, 8).select(
        (F.lit("1995-01-01").cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, cast(id * 30 as int))")).alias("t")
    )
    by_name = [F.convert_timezone(F.lit("Europe/Moscow"), F.lit("UTC"), t) for t in (F.col("t"), F.col("t") + F.expr("INTERVAL 1 HOUR"))]
    want = F.greatest(by_name[0], by_name[1] - F.expr("INTERVAL 1 HOUR"))
    try:
        for zone in zones:
            spark.conf.set("spark.sql.session.timeZone", zone)
            register_sql_functions(spark)
            for form in (local_to_utc(F.col("t")), F.expr("local_to_utc(t, 'Europe/Moscow')")):
                assert halves.filter(~form.eqNullSafe(want)).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_local_date_literal_and_documented(spark):
    df = column(spark, [dt.datetime(2025, 8, 19, 2, 0, 0), dt.datetime(2025, 8, 19, 22, 0, 0)], "timestamp_ntz")
    assert results(df, local_date(F.col("x"))) == [dt.date(2025, 8, 18), dt.date(2025, 8, 19)]
    assert results(df, local_date(F.col("x"), documented=True)) == [dt.date(2025, 8, 19), dt.date(2025, 8, 20)]


def test_int_text(spark):
    df = column(spark, ["18.5", " 18 ", "1e2", None, "-2.5", "7"], "string")
    assert results(df, int_text(F.col("x"))) == [19, 18, 100, None, -3, 7]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        results(df, int_text(F.col("x"), strict=True))
    for text in ("", "abc", "5f"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            results(column(spark, [text], "string"), int_text(F.col("x")))


def test_comma_decimal(spark):
    df = column(spark, ["-1880,00", "0,5", "1e2", None], "string")
    assert results(df, comma_decimal(F.col("x"))) == [-1880.0, 0.5, 100.0, None]
    junk = column(spark, ["invalid", "1,5d", "2F", "", "1 880,00"], "string")
    assert results(junk, comma_decimal(F.col("x"), lenient=True)) == [None] * 5
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        results(junk, comma_decimal(F.col("x")))
    assert [str(v) for v in results(column(spark, ["1 880,5", "", "x", None], "string"), check_decimal(F.col("x")))] == [
        "1880.50", "0.00", "0.00", "0.00"
    ]


def test_date_text(spark):
    assert results(column(spark, ["19.08.2025", "1.2.2024", None], "string"), date_text(F.col("x"))) == [
        dt.date(2025, 8, 19), dt.date(2024, 2, 1), None
    ]


def test_normalize_identifier(spark):
    cases = {
        "T-Bank_transactions": "t_bank_transactions", "My-Bank_cards": "my_bank_cards",
        "Bank-Name_loans": "bank_name_loans", "Test@Bank_data": "test_bank_data", "__A  b__": "a_b", "Банк": "unknown",
        "": "unknown",
    }
    assert results(column(spark, list(cases), "string"), normalize_identifier(F.col("x"))) == list(cases.values())


def test_cell_text(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2025, 1, 15, 10, 0, 0, 500000), dt.datetime(2025, 1, 15, 10), dt.date(2025, 1, 15), 45.50, None, True, 7)],
        "a timestamp_ntz, b timestamp_ntz, c date, d double, e string, f boolean, g bigint",
    )
    cells = [cell_text(f.name, f.dataType) for f in df.schema.fields]
    assert list(df.select(*cells).first()) == [
        "2025-01-15T10:00:00.500000", "2025-01-15T10:00:00", "2025-01-15", "45.5", "None", "True", "7"
    ]
    assert isinstance(df.schema["a"].dataType, T.TimestampNTZType)
