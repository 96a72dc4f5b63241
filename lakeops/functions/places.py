"""Coordinates and billing periods read from free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeops.functions.text import strip

# --- fixed values: accepted spellings --------------------------------------------------
DECIMAL_DEGREES = r"(?i)^\s*[+-]?\d+(?:[.,]\d+)?\s*[NSEWO]?\s*$"
SEXAGESIMAL = (
    r"^\s*(\d+)(?:\s*[°º]\s*(\d+))?(?:\s*['’′m]\s*(\d+(?:[.,]\d+)?))?(?:\s*[\"”″s])?\s*([NnSsEeWwOo])?\s*$"
)
PERIOD = r"(?:(20\d{2})[/-](0?[1-9]|1[0-2]))|((0?[1-9]|1[0-2])[/-](20\d{2}))"
COMPACT_PERIOD = r"(20\d{2})(0[1-9]|1[0-2])"
MONTHS = {
    "enero": 1, "ene": 1, "febrero": 2, "feb": 2, "marzo": 3, "mar": 3, "abril": 4, "abr": 4,
    "mayo": 5, "may": 5, "junio": 6, "jun": 6, "julio": 7, "jul": 7, "agosto": 8, "ago": 8,
    "setiembre": 9, "septiembre": 9, "sep": 9, "set": 9, "octubre": 10, "oct": 10,
    "noviembre": 11, "nov": 11, "diciembre": 12, "dic": 12,
}
# ----------------------------------------------------------------------------------------


def coordinate(c: Column, to: str = "decimal(11,8)") -> Column:
    """Decimal degrees with an optional hemisphere letter, or degrees, minutes and seconds.

    South, west and ``O`` (oeste) negate, so a signed value with such a letter turns
    positive: ``-12.5 S`` is 12.5.
    """
    bare = F.trim(c)
    digits = F.replace(F.regexp_replace(bare, r"[^0-9+\-.,]", ""), F.lit(","), F.lit("."))
    plain = digits.try_cast(to)

    def piece(i: int) -> Column:
        text = F.replace(F.regexp_extract(bare, SEXAGESIMAL, i), F.lit(","), F.lit("."))
        return F.concat(F.lit("0"), text).try_cast("double")  # an absent part reads 0

    angle = (piece(1) + piece(2) / 60 + piece(3) / 3600).try_cast(to)
    letter = F.upper(F.regexp_extract(bare, SEXAGESIMAL, 4))
    return (
        F.when(bare.rlike(DECIMAL_DEGREES), F.when(bare.rlike("(?i)[SWO]"), -plain).otherwise(plain))
        .when(bare.rlike("(?i)" + SEXAGESIMAL), F.when(letter.isin("S", "W", "O"), -angle).otherwise(angle))
        .cast(to)
    )


def billing_period(c: Column) -> Column:
    """``YYYYMM`` from text: separated numbers, then a Spanish month name with a year, then six digits.

    The year-first form reads a two-digit month by its first digit (``2024-12`` gives
    ``202401``); existing receipts are numbered that way.
    """
    low = F.lower(strip(c))
    part = lambda i: F.regexp_extract(low, PERIOD, i)
    month = F.concat(part(2), part(4))  # one of the two spellings matched, or neither
    separated = F.when(month != "", F.concat(part(1), part(5), F.lpad(month, 2, "0")))

    named = F.lit(None).cast("string")
    for name, number in reversed(MONTHS.items()):
        named = F.when(low.contains(name), F.lit(f"{number:02d}")).otherwise(named)
    spelled = F.concat(F.nullif(F.regexp_extract(low, r"(20\d{2})", 1), F.lit("")), named)

    compact = F.nullif(F.regexp_extract(low, COMPACT_PERIOD, 0), F.lit(""))
    return F.coalesce(separated, spelled, compact)
