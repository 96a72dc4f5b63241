"""Number grammars. Three incompatible ones exist side by side; each feed names its own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeops.functions.text import strip

# Stands for a decimal without declared precision, which Spark does not have.
WIDE = "decimal(38,10)"

_FLOAT = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"

# A failed try_cast costs an exception, so text is matched first and only numbers are cast. An
# input that is costly itself goes through ``_only``, which evaluates it once.


def _only(c: Column, pattern: str) -> Column:
    """The text when all of it matches, else NULL."""
    return F.nullif(F.regexp_extract(c, rf"\A(?:{pattern})\z", 0), F.lit(""))


def _matched(c: Column, pattern: str, to: str) -> Column:
    return F.when(c.rlike(rf"\A(?:{pattern})\z"), c.try_cast(to))


def _swap(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def try_numeric(c: Column, to: str = WIDE) -> Column:
    """Drop every character but digits, comma, dot and minus, then accept a plain number or
    well-formed thousands groups. ``1e5`` reads 15, ``(5)`` reads 5, ``12,5`` and ``.5`` are NULL."""
    kept = F.regexp_replace(c, r"[^0-9,.\-]+", "")
    return _swap(_only(kept, r"-?(\d+|\d{1,3}(,\d{3})+)(\.\d+)?"), ",", "").try_cast(to)


def decimal_comma(c: Column, to: str) -> Column:
    """A comma is the decimal point. Text that is no number is NULL."""
    return _matched(_swap(F.trim(c), ",", "."), _FLOAT, to)


def guarded_decimal(c: Column, to: str = WIDE) -> Column:
    """Optional sign, digits, at most one decimal comma or dot; anything else is NULL."""
    return _matched(_swap(F.trim(c), ",", "."), r"[+-]?[0-9]+(\.[0-9]+)?", to)


def truncated_int(c: Column, to: str = "int") -> Column:
    """``try_numeric`` cut toward zero."""
    return try_numeric(c).try_cast(to)


def digits_int(c: Column, to: str = "int") -> Column:
    """Digits only, outer spaces allowed."""
    return _matched(F.trim(c), "[0-9]+", to)


def signed_int(c: Column, to: str = "bigint") -> Column:
    """Optional minus and digits, outer spaces allowed."""
    return _matched(F.trim(c), r"-?\d+", to)


def float_text(c: Column) -> Column:
    """Double from decimal or scientific notation; NULL otherwise."""
    return _only(strip(c), _FLOAT).try_cast("double")


def locale_number(c: Column) -> Column:
    """One comma and no dot: the comma is the decimal point. Else commas separate thousands.
    Reads ``1,234`` as 1.234 where ``try_numeric`` reads 1234."""
    pointed = F.regexp_replace(c, r"\A([^,.]*),([^,.]*)\z", "$1.$2")
    return float_text(_swap(pointed, ",", ""))


def form_value(c: Column, kind: str, zero_when_empty: bool = True) -> Column:
    """A form field as ``str``, ``int``, ``decimal`` or ``date``. A blank or unreadable number is 0
    unless ``zero_when_empty`` is off; a blank or unreadable date or text is NULL."""
    from lakeops.functions.dates import date_any

    if kind == "date":
        return date_any(c)
    if kind == "str":
        return F.nullif(strip(c), F.lit(""))
    number = locale_number(c)
    if kind == "int":
        number = number.try_cast("bigint")
    return F.coalesce(number, F.lit(0).cast("bigint" if kind == "int" else "double")) if zero_when_empty else number


def code_digits(c: Column) -> Column:
    """A supply code: the whole part when it reads as a number of up to 63 bits, else its digits, else NULL."""
    digits = F.nullif(F.regexp_replace(c, r"\D", ""), F.lit(""))
    return F.coalesce(float_text(c).try_cast("bigint").cast("string"), digits)
