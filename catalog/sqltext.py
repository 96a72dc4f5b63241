"""DuckDB spellings of the cleaning rules, written apart from the Spark ones.

The patterns that guard numbers, dates and ids, and the date formats, are fixed values: they say which
texts are accepted.
"""

from __future__ import annotations


def try_numeric(x: str, to: str = "DECIMAL(38,10)") -> str:
    kept = f"regexp_replace({x}, '[^0-9,.\\-]', '', 'g')"
    return (
        f"CASE WHEN regexp_full_match({kept}, '-?\\d+(\\.\\d+)?') OR regexp_full_match({kept}, "
        f"'-?\\d{{1,3}}(,\\d{{3}})+(\\.\\d+)?') THEN TRY_CAST(replace({kept}, ',', '') AS {to}) END"
    )


def missing(x: str, tokens: str = "'nan','null'") -> str:
    return f"({x} IS NULL OR trim({x}) = '' OR lower(trim({x})) IN ({tokens}))"


def text_token(x: str, n: int) -> str:
    return f"CASE WHEN NOT {missing(x)} THEN left(trim({x}), {n}) END"


def text_nan(x: str, n: int) -> str:
    return f"left(nullif(nullif(trim({x}), 'NaN'), ''), {n})"


def strict_date(x: str, guard: str, fmt: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '{guard}') THEN CAST(try_strptime({x}, '{fmt}') AS DATE) END"


def date_slash_or_iso(x: str) -> str:
    word = f"split_part({x}, ' ', 1)"
    slash = strict_date(word, r"\d{1,2}/\d{1,2}/\d{4}", "%d/%m/%Y")
    iso = strict_date(word, r"\d{4}-\d{1,2}-\d{1,2}", "%Y-%m-%d")
    return f"CASE WHEN {missing(x)} THEN NULL WHEN strpos({x}, '/') > 0 THEN {slash} ELSE {iso} END"


def date_any_separator(x: str) -> str:
    word = f"regexp_replace(split_part({x}, ' ', 1), '[.\\-]', '/', 'g')"
    return (
        f"CASE WHEN {missing(x)} THEN NULL ELSE coalesce({strict_date(word, '[0-9]{2}/[0-9]{2}/[0-9]{4}', '%d/%m/%Y')}, "
        f"{strict_date(word, '[0-9]{4}/[0-9]{2}/[0-9]{2}', '%Y/%m/%d')}) END"
    )


def date_exact(x: str) -> str:
    forms = (
        (r"\d{4}-\d{2}-\d{2}", "%Y-%m-%d"),
        (r"\d{2}/\d{2}/\d{4}", "%d/%m/%Y"),
        (r"\d{2}-\d{2}-\d{4}", "%d-%m-%Y"),
    )
    return "coalesce(" + ", ".join(strict_date(x, g, f) for g, f in forms) + ")"


def date_short_year(x: str) -> str:
    forms = (
        (r"\d{4}-\d{2}-\d{2}", "%Y-%m-%d"),
        (r"\d{2}/\d{2}/\d{4}", "%d/%m/%Y"),
        (r"\d{2}/\d{2}/\d{2}", "%d/%m/%y"),
    )
    return "coalesce(" + ", ".join(strict_date(f"trim({x})", g, f) for g, f in forms) + ")"


def date_any(x: str) -> str:
    forms = (
        (r"\d{1,2}/\d{1,2}/\d{4}", "%d/%m/%Y"),
        (r"\d{4}-\d{1,2}-\d{1,2}", "%Y-%m-%d"),
        (r"\d{1,2}-\d{1,2}-\d{4}", "%d-%m-%Y"),
    )
    return "coalesce(" + ", ".join(strict_date(f"trim({x})", g, f) for g, f in forms) + ")"


def timestamp_field(x: str) -> str:
    t = f"regexp_replace(trim({x}), '\\s+', ' ', 'g')"
    cases = (
        (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", "%Y-%m-%d %H:%M:%S"),
        (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}", "%Y-%m-%d %H:%M"),
        (r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}", "%d/%m/%Y %H:%M:%S"),
        (r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}", "%d/%m/%Y %H:%M"),
        (r"\d{2}/\d{2}/\d{2} \d{1,2}:\d{2} ?(AM|PM|am|pm)", "%d/%m/%y %I:%M %p"),
    )
    whens = " ".join(f"WHEN regexp_full_match({t}, '{g}') THEN try_strptime(upper({t}), '{f}')" for g, f in cases)
    return f"CASE {whens} END"


def timestamp_order(x: str) -> str:
    cases = (
        (r"\d{4}-\d{2}-\d{2}", "%Y-%m-%d"),
        (r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}", "%d/%m/%Y %H:%M:%S"),
        (r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}", "%d/%m/%Y %H:%M"),
        (r"\d{2}/\d{2}/\d{4}", "%d/%m/%Y"),
        (r"\d{2}-\d{2}-\d{4} \d{2}:\d{2}:\d{2}", "%d-%m-%Y %H:%M:%S"),
        (r"\d{2}-\d{2}-\d{4} \d{2}:\d{2}", "%d-%m-%Y %H:%M"),
        (r"\d{2}-\d{2}-\d{4}", "%d-%m-%Y"),
    )
    iso = (
        f"WHEN regexp_full_match({x}, '\\d{{4}}-\\d{{2}}-\\d{{2}}[ T]\\d{{2}}:\\d{{2}}:\\d{{2}}(\\.\\d+)?Z?') "
        f"THEN TRY_CAST(replace(split_part(regexp_replace({x}, 'Z$', ''), '.', 1), 'T', ' ') AS TIMESTAMP) "
    )
    return "CASE " + iso + " ".join(
        f"WHEN regexp_full_match({x}, '{g}') THEN try_strptime({x}, '{f}')" for g, f in cases
    ) + " END"


def iso(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def invalid_id(x: str) -> str:
    return f"({x} IS NOT NULL AND trim({x}) <> '' AND NOT regexp_matches(trim({x}), '[-–—]\\s*[0-9]+'))"


def marked(source: str, rules: tuple[str, ...], keys: tuple[str, ...], carry: str = "*") -> str:
    """SELECT over ``source`` with ``reason``, duplicates counted among rows no rule took."""
    tests = {"invalid": invalid_id(keys[0]), "missing": missing(keys[0])}
    whens = " ".join(f"WHEN {tests[r]} THEN '{r}'" for r in rules)
    first = f"CASE {whens} END" if rules else "CAST(NULL AS VARCHAR)"
    parts = ", ".join(keys)
    return (
        f"SELECT {carry}, coalesce(rule_hit, CASE WHEN {keys[0]} IS NOT NULL AND copies > 1 THEN 'duplicate' END) AS reason "
        f"FROM (SELECT *, count(*) FILTER (WHERE rule_hit IS NULL) OVER (PARTITION BY {parts}) AS copies "
        f"FROM (SELECT *, {first} AS rule_hit FROM {source}))"
    )
