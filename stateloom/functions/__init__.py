"""Column expressions. All of them are built-ins, so they stay inside generated code."""

from stateloom.functions.cells import cell_text
from stateloom.functions.clock import local_date, local_text_to_utc, local_to_utc
from stateloom.functions.keys import business_key, load_key
from stateloom.functions.naming import normalize_identifier
from stateloom.functions.sql import register_sql_functions
from stateloom.functions.text import comma_decimal, date_text, double_text, int_text

__all__ = [
    "business_key",
    "cell_text",
    "comma_decimal",
    "date_text",
    "double_text",
    "int_text",
    "load_key",
    "local_date",
    "local_text_to_utc",
    "local_to_utc",
    "normalize_identifier",
    "register_sql_functions",
]
