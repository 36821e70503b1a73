"""What is particular to one bank: its mapping, labels and checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from stateloom.functions.clock import MOSCOW
from stateloom.operators.mapping import MappingRow
from stateloom.quality.checks import Check, accepted_values, not_null, unique
from stateloom.sources.mappings import bundled_mapping

# Fixed values of the T Bank models.
STATUSES = ["OK", "FAILED"]
CURRENCIES = ["RUB"]
AMOUNT_COLUMNS = (
    "Сумма операции", "Сумма платежа", "Кэшбэк", "Бонусы (включая кэшбэк)", "Округление на инвесткопилку",
    "Сумма операции с округлением",
)
REWARD_CATEGORY = "Cashback"
REWARD_DESCRIPTION = "Cashback and other rewards"
VIEW_SCHEMA = (
    "bank_nm string, category_nm string, description string, transaction_amt double, "
    "transaction_currency_cd string, transaction_dt date"
)


@dataclass(frozen=True)
class Bank:
    source: str = "t_bank"
    label: str = "T Bank"
    raw_table: str = "t_bank_transactions"
    zone: str = MOSCOW
    documented_date: bool = False
    dedup_within_batch: bool = False
    amount_columns: Sequence[str] = AMOUNT_COLUMNS
    mapping: Sequence[MappingRow] = field(default_factory=bundled_mapping)
    checks: dict[str, list[Check]] = field(default_factory=lambda: default_checks())


def default_checks() -> dict[str, list[Check]]:
    currency = [
        accepted_values("transaction_currency_cd", CURRENCIES, severity="warn"),
        not_null("transaction_currency_cd"),
    ]
    status = [accepted_values("status_nm", STATUSES), not_null("status_nm")]
    stored = [not_null("__ingested_at")]
    return {
        "staging": [
            not_null("__load_key"), unique("__load_key"), *status, not_null("transaction_amt"), *currency,
            not_null("transacted_at_utc"), *stored,
        ],
        "core": [
            not_null("transaction_bk"), unique("transaction_bk"), *status, not_null("transaction_amt"), *currency,
            not_null("transacted_at_utc"), *stored,
        ],
        "mart": [
            not_null("transaction_bk"), unique("transaction_bk"), not_null("transaction_amt"), *currency,
            not_null("transaction_dt"), not_null("total_rewards_amt"), *stored,
        ],
        "view": [not_null("bank_nm"), not_null("transaction_amt"), *currency, not_null("transaction_dt")],
    }
