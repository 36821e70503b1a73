"""The same conversions as SQL functions, so that mappings kept as data can name them.

They are SQL-bodied functions: the analyzer inlines them, and no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from stateloom.functions.clock import UTC_NAMES
from stateloom.functions.text import NUMBER

BODIES = {
    "numeric_text(x STRING) RETURNS STRING": (
        f"CASE WHEN x RLIKE r'{NUMBER}' THEN x ELSE concat(x, '?') END"
    ),
    "comma_decimal(x STRING) RETURNS DOUBLE": "CAST(numeric_text(replace(x, ',', '.')) AS DOUBLE)",
    "rounded_int(x STRING) RETURNS INT": "CAST(round(CAST(numeric_text(x) AS DOUBLE)) AS INT)",
    "local_to_utc(t TIMESTAMP_NTZ, zone STRING) RETURNS TIMESTAMP_NTZ": (
        "greatest({now}, {an_hour_on} - INTERVAL 1 HOUR)"
    ),
    "local_text_to_utc(x STRING, pattern STRING, zone STRING) RETURNS TIMESTAMP_NTZ": (
        "local_to_utc(to_timestamp_ntz(x, pattern), zone)"
    ),
}


# A conversion of {x}; the first holds only where the session zone is UTC (see `clock.py`).
BY_INSTANT = "CAST(to_utc_timestamp(CAST({x} AS TIMESTAMP_LTZ), zone) AS TIMESTAMP_NTZ)"
BY_NAMES = "convert_timezone(zone, 'UTC', {x})"
REGISTERED = "stateloom.functions.zone"


def register_sql_functions(spark: SparkSession) -> None:
    """Make the functions known to the session; a no-op where they are.

    A function keeps the session zone it was made under, so they are made anew when that changes.
    """
    session_zone = spark.conf.get("spark.sql.session.timeZone")
    if spark.conf.get(REGISTERED, None) == session_zone:
        return
    convert = BY_INSTANT if session_zone in UTC_NAMES else BY_NAMES
    now, an_hour_on = convert.format(x="t"), convert.format(x="t + INTERVAL 1 HOUR")
    for signature, body in BODIES.items():
        filled = body.replace("{now}", now).replace("{an_hour_on}", an_hour_on)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {filled}")
    spark.conf.set(REGISTERED, session_zone)
