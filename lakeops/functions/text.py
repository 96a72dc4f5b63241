"""Blank and null-token policies, and small text expressions.

``trim`` removes spaces only, as SQL ``btrim`` does; ``strip`` removes all white space.
The policies differ per feed on purpose and must not be merged.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------
NULL_TOKENS = ("nan", "null")
NULL_TOKENS_METER = ("nan", "null", "-", "n/a")
ACCENTED = "áéíóúñ"
PLAIN = "aeioun"
# ----------------------------------------------------------------------------------------


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def cut(c: Column, length: int | None) -> Column:
    return c if length is None else F.left(c, F.lit(length))


def is_missing(c: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """NULL, blank, or a null token in any letter case."""
    bare = F.trim(c)
    return c.isNull() | (bare == "") | F.lower(bare).isin(*tokens)


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def same_text(a: Column, b: Column) -> Column:
    """Equality that ignores letter case and outer spaces."""
    return F.lower(F.trim(a)) == F.lower(F.trim(b))


def text_token(c: Column, length: int | None = None) -> Column:
    """Blank, ``nan`` and ``null`` (any case) become NULL; else trimmed and cut."""
    return F.when(~is_missing(c), cut(F.trim(c), length))


def text_nan(c: Column, length: int | None = None) -> Column:
    """Blank and the exact spelling ``NaN`` become NULL."""
    return cut(F.nullif(F.nullif(F.trim(c), F.lit("NaN")), F.lit("")), length)


def text_blank(c: Column, length: int | None = None) -> Column:
    """Only blank becomes NULL."""
    return cut(F.nullif(F.trim(c), F.lit("")), length)


def text_meter(c: Column, length: int | None = None) -> Column:
    """As ``text_token``, with ``-`` and ``n/a`` as further null tokens."""
    return F.when(~is_missing(c, NULL_TOKENS_METER), cut(F.trim(c), length))


def text_kept(c: Column, length: int | None = None) -> Column:
    """Trim only: a blank stays a blank."""
    return cut(F.trim(c), length)


def text_flag(c: Column, length: int) -> Column:
    """Cut, never NULL."""
    return F.coalesce(cut(F.trim(c), length), F.lit(""))


def as_text(c: Column, length: int = 255) -> Column:
    """Any scalar as text of at most ``length`` characters."""
    return F.left(c.cast("string"), F.lit(length))


def before_separator(c: Column, separator: str = "_") -> Column:
    """The part before the first separator, outer white space removed."""
    return F.substring_index(strip(c), separator, 1)


def short_sha(c: Column, length: int = 12) -> Column:
    return F.substring(F.sha2(c, 256), 1, length)


def short_md5(c: Column, length: int = 8) -> Column:
    return F.substring(F.md5(c), 1, length)


def header_key(c: Column) -> Column:
    """A header in comparable form: lower case, unaccented, ``_`` for gaps, ``[a-z0-9_]`` only."""
    folded = F.translate(F.lower(strip(c)), ACCENTED, PLAIN)
    gaps = F.regexp_replace(folded, r"[-\s]+", "_")
    return F.coalesce(F.regexp_replace(gaps, r"[^a-z0-9_]+", ""), F.lit(""))


def header_key_of(name: str | None) -> str:
    """``header_key`` for a column name already known to the driver."""
    folded = (name or "").strip().lower().translate(str.maketrans(ACCENTED, PLAIN))
    return re.sub(r"[^a-z0-9_]+", "", re.sub(r"[-\s]+", "_", folded))


def has_digits_after_dash(c: Column) -> Column:
    """A hyphen, en dash or em dash, then digits."""
    return F.trim(c).rlike(r"[-–—]\s*[0-9]+")


def risk_level(missing: Column) -> Column:
    """Risk label of a number of missing days."""
    return (
        F.when(missing >= 7, "ALTO")
        .when(missing >= 4, "MEDIO")
        .when(missing >= 2, "BAJO")
        .otherwise("OK")
    )


#: First bytes of a file that tell what it is.
PAYLOAD_BYTES = 500


def payload_kind(content: Column) -> Column:
    """``zip``, ``html`` or ``other``, from the first bytes of a file. Under 100 bytes is no page."""
    head = F.lower(F.substring(content, 1, PAYLOAD_BYTES).cast("string"))
    marked = head.contains("<!doctype html") | head.contains("<html") | head.contains("<head")
    page = (F.octet_length(content) >= 100) & marked
    return (
        F.when(F.hex(F.substring(content, 1, 4)) == "504B0304", "zip")
        .when(page, "html")
        .otherwise("other")
    )
