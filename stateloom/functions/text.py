"""Numbers and dates to and from text, with the text forms that hash keys rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Kept as one SQL text: built call by call, the expression costs more driver time than a small query.
_DOUBLE_TEXT = r"""
CASE
  WHEN {x} IS NULL THEN NULL
  WHEN isnan({x}) THEN 'nan'
  WHEN {x} = double('Infinity') THEN 'inf'
  WHEN {x} = double('-Infinity') THEN '-inf'
  WHEN {x} = 0 OR (abs({x}) >= 1e-3D AND abs({x}) < 1e7D) THEN cast({x} AS string)
  WHEN abs({x}) >= 1e-4D AND abs({x}) < 1e16D THEN
    regexp_replace(regexp_replace(
      cast(try_cast(cast({x} AS string) AS decimal(38,21)) AS string), r'0+$', ''), r'\.$', '.0')
  ELSE regexp_replace(CASE
    WHEN try_cast(format_string('%.14e', {x}) AS double) = {x} THEN format_string('%.14e', {x})
    WHEN abs({x}) >= 1e16D AND abs({x}) < 1e30D THEN replace(if(double({digits16}) = {x}, {digits16}, {digits17}), 'E', 'e+')
    WHEN try_cast(format_string('%.15e', {x}) AS double) = {x} THEN format_string('%.15e', {x})
    ELSE format_string('%.16e', {x}) END, r'\.?0*e', 'e')
END"""

# A whole number below 1e30 rounded to some digits: both parts of it at 2^50 are exact.
_DIGITS = "format_number(cast(bigint({x} / 1125899906842624D) AS decimal(16,0)) * 1125899906842624BD + bigint({x} % 1125899906842624D), '0.{places}E0')"


def double_text_sql(value: str) -> str:
    """`double_text` of an SQL expression, as SQL."""
    x = f"({value})"
    return _DOUBLE_TEXT.format(x=x, **{f"digits{n}": _DIGITS.format(x=x, places="#" * (n - 1)) for n in (16, 17)})


def double_text(value: str) -> Column:
    """A double, given as a column name or SQL expression, as text.

    Plain digits from 1e-4 up to 1e16, `1e+16` style outside. Spark itself turns to exponents at
    1e-3 and 1e7, so an amount of ten million would hash to another key than in the engines this
    text has to agree with. An exponent form has the fewest digits that name the same double. Java's own
    digits are that from 1e30 on and below 1e-4, but for some denormals; between 1e16 and 1e30 they may be too
    many or not the nearest ones, so there the exact whole number is rounded to 16 or 17 digits if 15 of Java's do not do.
    """
    return F.expr(double_text_sql(value))


# Decimal text, infinities and NaN. Java also reads '1.5d' and '0x1p3' as numbers; those are spoiled, so that a cast
# refuses them.
NUMBER = r"(?i)^\s*[+-]?(?:(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity|nan)\s*$"


def _numeric_text(text: Column) -> Column:
    return F.when(text.rlike(NUMBER), text).otherwise(F.concat(text, F.lit("?")))


def comma_decimal(text: Column, lenient: bool = False) -> Column:
    """`-1880,00` as a double. Junk is an error under ANSI, or NULL when `lenient`."""
    dotted = _numeric_text(F.replace(text, F.lit(","), F.lit(".")))
    return dotted.try_cast("double") if lenient else dotted.cast("double")


def int_text(text: Column, strict: bool = False) -> Column:
    """Whole-number text as an int; `18.5` rounds half away from zero unless `strict`."""
    if strict:
        return text.cast("int")
    return F.round(_numeric_text(text).cast("double")).cast("int")


def date_text(text: Column, pattern: str = "d.M.yyyy") -> Column:
    return F.to_date(text, pattern)


def check_decimal(text: Column) -> Column:
    """Lenient amount for data checks: spaces dropped, comma as the point, blank and junk as 0."""
    compact = F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit(","), F.lit("."))
    return F.coalesce(compact.try_cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
