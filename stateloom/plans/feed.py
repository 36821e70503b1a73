"""The `orders` table rendered as a bank export, to run the models on any of the given tables.

The rendered rows have the export's fifteen text columns: comma decimals, local wall times through
the whole day (clock changes included), blank cards, a few unequal currencies and amounts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from stateloom.functions.keys import load_key
from stateloom.functions.sql import register_sql_functions
from stateloom.operators.mapping import LOAD_KEY
from stateloom.plans import models
from stateloom.plans.bank import Bank

RUN_TS = dt.datetime(2024, 2, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _comma(amount: str) -> str:
    return f"replace(cast(cast({amount} AS decimal(18,2)) AS string), '.', ',')"


_OCCURRED = "cast(o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400) AS string)"
_DAY = "concat_ws('.', substring({x}, 9, 2), substring({x}, 6, 2), substring({x}, 1, 4))"
_AMOUNT = _comma("if(o_orderkey % 2 = 0, -o_totalprice, o_totalprice)")
_ROUNDED = _comma("if(o_orderstatus = 'P', double(ceil(abs(o_totalprice))), abs(o_totalprice))")
_LAST4 = "lpad(cast(o_custkey % 10000 AS string), 4, '0')"

# dates go through their plain text form, which involves no session zone
FEED = {
    "Дата операции": f"concat_ws(' ', {_DAY.format(x=_OCCURRED)}, substring({_OCCURRED}, 12, 8))",
    "Дата платежа": _DAY.format(x="cast(o_orderdate AS string)"),
    "Номер карты": f"if(o_custkey % 5 <> 0, concat('*', {_LAST4}), null)",
    "Статус": "if(o_orderstatus = 'F', 'FAILED', 'OK')",
    "Сумма операции": _AMOUNT,
    "Валюта операции": "'RUB'",
    "Сумма платежа": _AMOUNT,
    "Валюта платежа": "if(o_orderpriority = '5-LOW', 'USD', 'RUB')",
    "Кэшбэк": "if(o_orderkey % 3 > 0, cast(o_orderkey % 3 AS string), null)",
    "Категория": "o_orderpriority",
    "MCC": f"if(o_custkey % 5 <> 0, {_LAST4}, null)",
    "Описание": "concat('order ', cast(o_orderkey AS string))",
    "Бонусы (включая кэшбэк)": _comma("o_orderkey % 3"),
    "Округление на инвесткопилку": "'0,00'",
    "Сумма операции с округлением": _ROUNDED,
}


def bank_feed(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(*[f"{expression} AS `{name}`" for name, expression in FEED.items()])


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bank_feed(table(spark, sf_dir, "orders"))


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feed(spark, sf_dir)
    return rows.withColumn(LOAD_KEY, load_key(rows))


def staged_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_sql_functions(spark)
    return models.staging(raw_feed(spark, sf_dir), Bank(), RUN_TS)


def core_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.core(staged_feed(spark, sf_dir), Bank(), RUN_TS)


def mart_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.mart(core_feed(spark, sf_dir), Bank(), RUN_TS)


def view_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.combined_view(mart_feed(spark, sf_dir), Bank())
