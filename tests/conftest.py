"""Shared session and statement-file fixtures."""

from __future__ import annotations

import csv
import datetime as dt
import os
from pathlib import Path

import pytest

from stateloom.session import build_session

os.environ.setdefault("TZ", "UTC")

# The bank's export header.
HEADER = [
    "Дата операции", "Дата платежа", "Номер карты", "Статус", "Сумма операции", "Валюта операции", "Сумма платежа",
    "Валюта платежа", "Кэшбэк", "Категория", "MCC", "Описание", "Бонусы (включая кэшбэк)",
    "Округление на инвесткопилку", "Сумма операции с округлением",
]

RUN1 = dt.datetime(2025, 10, 1, 6, 0, 0)
RUN2 = dt.datetime(2025, 11, 1, 6, 0, 0)
RUN3 = dt.datetime(2025, 12, 1, 6, 0, 0)
RUN4 = dt.datetime(2026, 1, 1, 6, 0, 0)
LATER = dt.datetime(2100, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "stateloom-tests",
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def statement_row(when: str, amount: str, card: str = "*4822", status: str = "OK", reward: str = "0,00", **other) -> list[str]:
    day = when.split(" ")[0]
    return [
        when, day, card, status, amount, "RUB", amount, other.get("pay_currency", "RUB"), other.get("cashback", ""),
        other.get("category", "Маркетплейсы"), other.get("mcc", "5300"), other.get("description", "shop"), reward,
        "0,00", amount.lstrip("-"),
    ]


def write_statement(path: Path, rows: list[list[str]], header: list[str] | None = None, sep: str = ";") -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", encoding="utf-8", newline="") as handle:
        writer = csv.writer(handle, delimiter=sep, quoting=csv.QUOTE_ALL)
        writer.writerow(header or HEADER)
        writer.writerows(rows)
    return path


def write_text(path: Path, text: str) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return path


def inbox(root: Path, bank: str = "T-Bank", kind: str = "transactions") -> Path:
    return root / "To Parse" / "Bank" / bank / kind


def tuples(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
