"""Profile figures, declared checks, gate, contract and quarantine."""

from __future__ import annotations

from decimal import Decimal
from statistics import stdev

import pytest
from pyspark.sql import functions as F

from stateloom.functions.text import check_decimal
from stateloom.quality.checks import (
    accepted_values, between, column_exists, duplicate_keys, in_set, not_null, null_counts, rejected_values, row_rule,
    run_checks, unique,
)
from stateloom.quality.gate import ContractError, QualityError, enforce, enforce_schema
from stateloom.quality.profile import completeness, export_counts, metrics, uniqueness, value_ranges
from stateloom.quality.quarantine import split

from .conftest import HEADER, statement_row, tuples

D = Decimal
SCHEMA = "id int, name string, amount decimal(18,3), status string"
ROWS = [
    (1, "ash", D("12.25"), "open"), (2, None, D("90.50"), "shut"), (3, "elm", None, "open"),
    (4, "fir", D("310.75"), None), (5, "oak", D("500.00"), "open"),
]


def test_completeness_and_metrics(spark):
    assert tuple(completeness(spark.createDataFrame(ROWS[:4], SCHEMA), ["name", "amount", "status"]).first()) == (4, 3, 3, 3)
    figures = metrics(spark.createDataFrame(ROWS, SCHEMA), ["name", "amount", "status"], "amount").first()
    assert figures["total_rows"] == 5
    assert [figures[f"{c}_completeness"] for c in ("name", "amount", "status")] == [0.8] * 3
    assert figures["avg_amount"] == pytest.approx(228.375) and figures["amount_stddev"] == pytest.approx(stdev([12.25, 90.5, 310.75, 500]))
    empty = metrics(spark.createDataFrame([], SCHEMA), ["name"], "amount").first()
    assert tuple(empty) == (0, None, None, None)


def test_ranges_and_uniqueness(spark):
    df = spark.createDataFrame(
        [(1, D("7.5"), D("0.3")), (2, D("-12.5"), D("1")), (3, D("880"), D("0.85")), (4, D("0"), D("0"))],
        "id int, amount decimal(18,3), part decimal(18,3)",
    )
    bad = {"invalid_parts": (F.col("part") < 0) | (F.col("part") > 1)}
    assert [float(v) for v in value_ranges(df, ["amount", "part"], bad).first()] == [-12.5, 880, 0, 1, 0]
    people = spark.createDataFrame(
        [(1, "k7", "north"), (2, "k9", "south"), (3, "k7", "west"), (4, "k2", "north")],
        "id int, badge string, name string",
    )
    assert tuple(uniqueness(people, ["badge", "name"]).first()) == (3, 3, 4)
    assert tuple(uniqueness(people, ["badge", "name"], approximate=True).first()) == (3, 3, 4)
    long = "x" * 100
    texts = spark.createDataFrame([(long,), (long,), (long + "y",), ("x",), (None,)], "t string")
    assert tuple(uniqueness(texts, ["t"]).first()) == (3, 5)
    assert tuples(duplicate_keys(people, "badge")) == [("k7", 2)]


def test_checks_report(spark):
    df = spark.createDataFrame([*ROWS, (5, "x", D("-1"), "odd")], SCHEMA)
    report = run_checks(
        df,
        [
            column_exists("id"), column_exists("gone"), not_null("name"), unique("id"), unique("name", severity="warn"),
            accepted_values("status", ["open", "shut"], severity="warn"), in_set("id", [1, 2, 3, 4, 5]),
            between("amount", 20, 300), between("amount", low=-5), row_rule("short", "length(name) < 4"),
        ],
    )
    have = {(r.check_name, r.column_name, r.severity): (r.failures, r.passed) for r in report.collect()}
    assert have == {
        ("exists", "id", "error"): (0, True), ("exists", "gone", "error"): (1, False), ("not_null", "name", "error"): (1, False),
        ("unique", "id", "error"): (1, False), ("unique", "name", "warn"): (0, True),
        ("accepted_values", "status", "warn"): (1, False), ("in_set", "id", "error"): (0, True),
        ("between", "amount", "error"): (0, True), ("rule", "short", "error"): (0, True),
    } | {("between", "amount", "error"): have[("between", "amount", "error")]}
    between_failures = sorted(r.failures for r in report.filter("check_name = 'between'").collect())
    assert between_failures == [0, 4]
    assert tuples(rejected_values(df, "status", ["open", "shut"])) == [("odd", 1)]
    assert tuples(null_counts(df)) == [("amount", 1), ("id", 0), ("name", 1), ("status", 1)]
    with pytest.raises(ValueError):
        not_null("x", severity="fatal")


def test_gate_and_contract(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert [w["failures"] for w in enforce(df, [unique("id"), not_null("name", severity="warn")], "t")] == [1]
    with pytest.raises(QualityError, match=r"t: not_null\(name\): 1"):
        enforce(df, [not_null("name")], "t")
    enforce_schema(df, SCHEMA, "t")
    for wrong in ("id int, name string", SCHEMA.replace("id int", "id bigint"), "name string, id int, amount decimal(18,3), status string"):
        with pytest.raises(ContractError):
            enforce_schema(df, wrong, "t")


def test_export_rules_on_statement_rows(spark):
    good = [
        statement_row("03.02.2025 10:11:12", "-64,20", card="", mcc=""), statement_row("04.02.2025 11:12:13", "-850,00", reward="8,00", cashback="8"),
    ]
    bad = ["05.02.2025 12:13:14", "05.02.2025", "", "OK", "77,00", "RUB", "77,00", "RUB", "", "Разное", "", "x", "0,00", "0,00", "12,34"]
    df = spark.createDataFrame(good + [bad], HEADER).select(
        check_decimal(F.col("`Сумма операции`")).alias("amount"), check_decimal(F.col("`Сумма операции с округлением`")).alias("rounded"),
        check_decimal(F.col("`Кэшбэк`")).alias("cashback"), F.col("MCC").alias("mcc"),
    )
    rules = [row_rule("rounded", "rounded = abs(amount)"), row_rule("mcc", "mcc = '' or mcc rlike '^[0-9]+$'")]
    assert tuples(run_checks(df, rules), "column_name", "failures") == [("mcc", 0), ("rounded", 1)]
    assert tuple(export_counts(df, F.col("amount"), F.col("cashback")).first()) == (2, 1)


def test_quarantine(spark):
    df = spark.createDataFrame([("1", "", "16"), ("2", "b", "none"), ("3", "c", "45"), ("4", "d", "5f"), ("5", "e", "0x1p3")], "id string, name string, amount string")
    sound, aside = split(df, ["amount"], ["name"])
    assert tuples(sound, "id") == [("3",)]
    assert tuples(aside, "id", "problems") == [("1", "name"), ("2", "amount"), ("4", "amount"), ("5", "amount")]


def test_column_names_with_dots_and_commas(spark):
    df = spark.createDataFrame([(1, "x"), (1, None)], "`a.b` int, `Amount, Currency` string")
    report = run_checks(df, [not_null("Amount, Currency"), unique("a.b"), in_set("a.b", [1])])
    assert tuples(report, "column_name", "failures") == [("Amount, Currency", 1), ("a.b", 0), ("a.b", 1)]
    assert tuples(duplicate_keys(df, "a.b")) == [(1, 2)]
