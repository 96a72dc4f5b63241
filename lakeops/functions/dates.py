"""Date and time grammars and calendar windows.

Texts are rearranged to ISO form and cast with ``try_cast``, so an impossible date such as
31/02 is NULL, and no result depends on the session's zone. The clock is never read:
functions that need "today" take ``as_of``.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeops.functions.text import strip

NTZ = "timestamp_ntz"


def _first(*choices: Column) -> Column:
    return F.coalesce(*choices)


def _iso(c: Column, pattern: str, order: str, to: str = "date") -> Column:
    """``c`` rearranged by ``order`` when ``pattern`` matches all of it; else NULL."""
    whole = rf"\A(?:{pattern})\z"
    return F.when(c.rlike(whole), F.regexp_replace(c, whole, order).try_cast(to))


def _iso_short_year(c: Column, pattern: str, order: str, to: str = "date") -> Column:
    """As ``_iso`` with a two-digit year, marked ``YY`` in both: 70-99 belong to the 1900s."""
    return _first(
        _iso(c, pattern.replace("YY", r"[0-6]\d"), order.replace("YY", "20"), to),
        _iso(c, pattern.replace("YY", r"[7-9]\d"), order.replace("YY", "19"), to),
    )


def date_slash_or_iso(c: Column) -> Column:
    """First word as day/month/year where the text has a slash anywhere, else as year-month-day.
    Null tokens and blanks are NULL."""
    word = F.split_part(c, F.lit(" "), F.lit(1))
    slashed = _iso(word, r"(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$2-$1")
    dashed = _iso(word, r"(\d{4})-(\d{1,2})-(\d{1,2})", "$1-$2-$3")
    return F.when(F.contains(c, F.lit("/")), slashed).otherwise(dashed)


def date_any_separator(c: Column) -> Column:
    """First word; dd/mm/yyyy or yyyy/mm/dd, each slash also a dot or dash. Null tokens are NULL."""
    word = F.split_part(c, F.lit(" "), F.lit(1))
    return _first(
        _iso(word, r"([0-9]{2})[/.\-]([0-9]{2})[/.\-]([0-9]{4})", "$3-$2-$1"),
        _iso(word, r"([0-9]{4})[/.\-]([0-9]{2})[/.\-]([0-9]{2})", "$1-$2-$3"),
    )


def date_exact(c: Column) -> Column:
    """The whole untrimmed text as yyyy-mm-dd, dd/mm/yyyy or dd-mm-yyyy."""
    return _first(
        _iso(c, r"(\d{4})-(\d{2})-(\d{2})", "$1-$2-$3"),
        _iso(c, r"(\d{2})([/-])(\d{2})\2(\d{4})", "$4-$3-$1"),
    )


def date_short_year(c: Column) -> Column:
    """Trimmed; yyyy-mm-dd, dd/mm/yyyy or dd/mm/yy."""
    bare = F.trim(c)
    return _first(
        _iso(bare, r"(\d{4})-(\d{2})-(\d{2})", "$1-$2-$3"),
        _iso(bare, r"(\d{2})/(\d{2})/(\d{4})", "$3-$2-$1"),
        _iso_short_year(bare, r"(\d{2})/(\d{2})/(YY)", "YY$3-$2-$1"),
    )


def date_any(c: Column) -> Column:
    """Stripped; the first of d/m/yyyy, yyyy-m-d, d-m-yyyy that parses."""
    bare = strip(c)
    return _first(
        _iso(bare, r"(\d{1,2})([/-])(\d{1,2})\2(\d{4})", "$4-$3-$1"),
        _iso(bare, r"(\d{4})-(\d{1,2})-(\d{1,2})", "$1-$2-$3"),
    )


def timestamp_field(c: Column) -> Column:
    """ISO with a gap and optional seconds, dd/mm/yyyy hh:mm[:ss], or dd/mm/yy h:mm AM/PM."""
    bare = F.trim(c)
    half_day = r"(\d{2})/(\d{2})/(YY)\s+(0?[1-9]|1[0-2]):(\d{2})\s*(?:AM|PM|am|pm)"
    afternoon = F.when(bare.rlike("(?i)pm$"), 12).otherwise(0)
    twelve = F.when(bare.rlike(r"\s12:"), 12).otherwise(0)
    moved = F.make_dt_interval(F.lit(0), afternoon - twelve)
    return _first(
        _iso(bare, r"(\d{4}-\d{2}-\d{2})\s+(\d{2}:\d{2}(?::\d{2})?)", "$1 $2", NTZ),
        _iso(bare, r"(\d{2})/(\d{2})/(\d{4})\s+(\d{2}:\d{2}(?::\d{2})?)", "$3-$2-$1 $4", NTZ),
        _iso_short_year(bare, half_day, "YY$3-$2-$1 $4:$5", NTZ) + moved,
    )


def timestamp_order(c: Column) -> Column:
    """ISO with blank or ``T``, fraction and ``Z`` dropped; else yyyy-mm-dd, dd/mm/yyyy or
    dd-mm-yyyy, the last two with optional hh:mm[:ss]."""
    clock = r"( \d{2}:\d{2}(?::\d{2})?)?"
    return _first(
        _iso(c, r"(\d{4}-\d{2}-\d{2})(?:[ T](\d{2}:\d{2}:\d{2})(?:\.\d+)?Z?)?", "$1 $2", NTZ),
        _iso(c, rf"(\d{{2}})([/-])(\d{{2}})\2(\d{{4}}){clock}", "$4-$3-$1$5", NTZ),
    )


def timestamp_meter(c: Column) -> Column:
    """Whatever casts to a timestamp; null tokens and all other text are NULL."""
    return F.trim(c).try_cast(NTZ)


def moment(t: datetime) -> Column:
    """A literal local time, the same in every session zone."""
    return F.lit(t.isoformat(sep=" ")).cast(NTZ)


# --- calendar -----------------------------------------------------------------------------


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def iso_week_label(day: Column) -> Column:
    """``YYYY-WW`` with the ISO year."""
    return F.format_string("%d-%02d", F.extract(F.lit("YEAROFWEEK"), day), F.weekofyear(day))


def previous_week_start(as_of: Column) -> Column:
    """Monday of the ISO week before the one ``as_of`` is in."""
    return F.date_sub(F.to_date(F.date_trunc("week", as_of)), 7)


def previous_period(as_of: Column, pattern: str = "yyyyMM") -> Column:
    """Month before ``as_of``, as ``yyyyMM`` or ``MMyy``."""
    return F.date_format(F.add_months(F.trunc(as_of, "month"), -1), pattern)


def in_last_months(ts: Column, as_of: Column, months: int) -> Column:
    """Within the last ``months`` complete months before ``as_of``."""
    first = F.trunc(as_of, "month")
    return (F.to_date(ts) >= F.add_months(first, -months)) & (F.to_date(ts) < first)


def month_epochs(as_of: Column, months: int) -> tuple[Column, Column]:
    """Start and end of that span in UTC epoch seconds."""
    first = F.trunc(as_of, "month")
    return (
        F.unix_date(F.add_months(first, -months)).cast("bigint") * 86400,
        F.unix_date(first).cast("bigint") * 86400,
    )


def in_trailing_days(ts: Column, as_of: Column, days: int) -> Column:
    """From ``days`` before yesterday up to yesterday."""
    return F.to_date(ts).between(F.date_sub(as_of, 1 + days), F.date_sub(as_of, 1))


def checked_range(
    start: datetime | None, end: datetime | None, as_of: date, max_days: int = 31
) -> tuple[datetime, datetime]:
    """A request's time range; both ends missing mean the whole of yesterday. A span over
    ``max_days`` is refused."""
    if start is None and end is None:
        yesterday = as_of - timedelta(days=1)
        return datetime.combine(yesterday, time(0, 0, 1)), datetime.combine(yesterday, time(23, 59, 59))
    if start is None or end is None:
        raise ValueError("a range needs both ends")
    if (end - start).days > max_days:
        raise ValueError(f"range of {(end - start).days} days exceeds {max_days}")
    return start, end
