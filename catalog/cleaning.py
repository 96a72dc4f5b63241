"""Scalar cleaning: numbers, dates, null policies, coordinates, periods, ids."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from catalog import sqltext as q
from catalog.registry import BILLS, NUMBERS, STAMPS, derive, duck, query, table
from lakeops.functions import dates, numbers, places, text
from lakeops.operators import quarantine



@query(
    "clean_try_numeric",
    f"SELECT ord, CAST({q.try_numeric('number_text')} AS DOUBLE) AS wide, "
    f"CAST({q.try_numeric('number_text', 'DECIMAL(18,2)')} AS DOUBLE) AS amount, "
    f"CAST({q.try_numeric('number_text', 'DECIMAL(18,6)')} AS DOUBLE) AS price FROM ({duck(NUMBERS)})",
)
def clean_try_numeric(spark, sf):
    return derive(spark, sf, NUMBERS).select(
        "ord",
        numbers.try_numeric(F.col("number_text")).alias("wide"),
        numbers.try_numeric(F.col("number_text"), "decimal(18,2)").alias("amount"),
        numbers.try_numeric(F.col("number_text"), "decimal(18,6)").alias("price"),
    )


@query(
    "clean_decimal_comma",
    "SELECT ord, CAST(TRY_CAST(nullif(replace(trim(number_text), ',', '.'), '') AS DECIMAL(18,2)) AS DOUBLE) AS amount "
    f"FROM ({duck(NUMBERS)})",
)
def clean_decimal_comma(spark, sf):
    return derive(spark, sf, NUMBERS).select("ord", numbers.decimal_comma(F.col("number_text"), "decimal(18,2)").alias("amount"))


@query(
    "clean_guarded_decimal",
    "SELECT ord, CAST(CASE WHEN regexp_full_match(trim(number_text), '[+-]?[0-9]+([.,][0-9]+)?') "
    "THEN TRY_CAST(replace(trim(number_text), ',', '.') AS DECIMAL(38,10)) END AS DOUBLE) AS amount "
    f"FROM ({duck(NUMBERS)})",
)
def clean_guarded_decimal(spark, sf):
    return derive(spark, sf, NUMBERS).select("ord", numbers.guarded_decimal(F.col("number_text")).alias("amount"))


@query(
    "clean_int",
    f"SELECT ord, TRY_CAST(trunc({q.try_numeric('number_text')}) AS INTEGER) AS truncated, "
    "CASE WHEN regexp_full_match(trim(number_text), '[0-9]+') THEN TRY_CAST(trim(number_text) AS INTEGER) END AS digits, "
    "CASE WHEN regexp_full_match(trim(number_text), '-?\\d+') THEN TRY_CAST(trim(number_text) AS BIGINT) END AS signed "
    f"FROM ({duck(NUMBERS)})",
)
def clean_int(spark, sf):
    return derive(spark, sf, NUMBERS).select(
        "ord",
        numbers.truncated_int(F.col("number_text")).alias("truncated"),
        numbers.digits_int(F.col("number_text")).alias("digits"),
        numbers.signed_int(F.col("number_text")).alias("signed"),
    )


_LOCALE = (
    "CASE WHEN length(trim(number_text)) - length(replace(trim(number_text), ',', '')) = 1 AND strpos(number_text, '.') = 0 "
    "THEN replace(trim(number_text), ',', '.') ELSE replace(trim(number_text), ',', '') END"
)
_FLOAT = f"CASE WHEN regexp_full_match({_LOCALE}, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') THEN TRY_CAST({_LOCALE} AS DOUBLE) END"


@query("clean_locale_number", f"SELECT ord, {_FLOAT} AS value FROM ({duck(NUMBERS)})")
def clean_locale_number(spark, sf):
    return derive(spark, sf, NUMBERS).select("ord", numbers.locale_number(F.col("number_text")).alias("value"))


@query(
    "clean_form_values",
    f"SELECT ord, CAST(trunc(coalesce({_FLOAT}, 0)) AS BIGINT) AS as_int, coalesce({_FLOAT}, 0.0) AS as_decimal, "
    "nullif(trim(number_text), '') AS as_str, "
    f"{q.iso(q.date_any('day_text'))} AS as_date "
    f"FROM ({duck(NUMBERS)}) JOIN ({duck(STAMPS)}) USING (ord)",
)
def clean_form_values(spark, sf):
    rows = derive(spark, sf, NUMBERS).join(derive(spark, sf, STAMPS), "ord")
    return rows.select(
        "ord",
        numbers.form_value(F.col("number_text"), "int").alias("as_int"),
        numbers.form_value(F.col("number_text"), "decimal").alias("as_decimal"),
        numbers.form_value(F.col("number_text"), "str").alias("as_str"),
        numbers.form_value(F.col("day_text"), "date").alias("as_date"),
    )


_DAY_GRAMMARS = {
    "clean_date_a": (dates.date_slash_or_iso, q.date_slash_or_iso),
    "clean_date_b": (dates.date_any_separator, q.date_any_separator),
    "clean_date_c": (dates.date_exact, q.date_exact),
    "clean_date_d": (dates.date_short_year, q.date_short_year),
    "clean_date_any": (dates.date_any, q.date_any),
}


def _day_query(name, clean, sql):
    @query(name, f"SELECT ord, day_text, {q.iso(sql('day_text'))} AS day FROM ({duck(STAMPS)})")
    def run(spark, sf):
        return derive(spark, sf, STAMPS).select("ord", "day_text", clean(F.col("day_text")).alias("day"))


for _name, (_clean, _sql) in _DAY_GRAMMARS.items():
    _day_query(_name, _clean, _sql)


@query("clean_ts_a", f"SELECT ord, time_text, {q.iso(q.timestamp_field('time_text'))} AS ts FROM ({duck(STAMPS)})")
def clean_ts_a(spark, sf):
    return derive(spark, sf, STAMPS).select("ord", "time_text", dates.timestamp_field(F.col("time_text")).alias("ts"))


@query("clean_ts_b", f"SELECT ord, time_text, {q.iso(q.timestamp_order('time_text'))} AS ts FROM ({duck(STAMPS)})")
def clean_ts_b(spark, sf):
    return derive(spark, sf, STAMPS).select("ord", "time_text", dates.timestamp_order(F.col("time_text")).alias("ts"))


_METER_TOKENS = "'nan','null','-','n/a'"


@query(
    "clean_ts_c",
    "WITH t AS (SELECT o_orderkey AS ord, CASE o_orderkey % 5 WHEN 0 THEN ' n/a' WHEN 1 THEN '-' WHEN 2 THEN NULL "
    "ELSE ' ' || CAST(o_orderdate + (o_orderkey % 86400) * interval '1' second AS VARCHAR) END AS time_text FROM orders) "
    f"SELECT ord, CASE WHEN {q.missing('time_text', _METER_TOKENS)} THEN NULL "
    "ELSE CAST(TRY_CAST(trim(time_text) AS TIMESTAMP) AS VARCHAR) END AS ts FROM t",
)
def clean_ts_c(spark, sf):
    recipe = """
    SELECT o_orderkey AS ord, CASE o_orderkey % 5 WHEN 0 THEN ' n/a' WHEN 1 THEN '-' WHEN 2 THEN NULL
      ELSE ' ' || cast(o_orderdate + (o_orderkey % 86400) * interval '1' second as string) END AS time_text
    FROM {orders}
    """
    return derive(spark, sf, recipe).select("ord", dates.timestamp_meter(F.col("time_text")).alias("ts"))


_TOKENS = """
SELECT o_orderkey AS ord, CASE o_orderkey % 8 WHEN 0 THEN ' nan ' WHEN 1 THEN 'NaN' WHEN 2 THEN 'NULL' WHEN 3 THEN '-'
  WHEN 4 THEN 'N/A' WHEN 5 THEN '   ' WHEN 6 THEN NULL ELSE '  ' || o_orderpriority || ' ' END AS raw
FROM {orders}
"""


@query(
    "null_policies",
    f"SELECT ord, {q.text_token('raw', 6)} AS token, {q.text_nan('raw', 6)} AS nan_only, "
    "left(nullif(trim(raw), ''), 6) AS blank_only, "
    f"CASE WHEN NOT {q.missing('raw', _METER_TOKENS)} THEN trim(raw) END AS meter, trim(raw) AS kept, "
    f"coalesce(left(trim(raw), 6), '') AS flag FROM ({duck(_TOKENS)})",
)
def null_policies(spark, sf):
    raw = F.col("raw")
    return derive(spark, sf, _TOKENS).select(
        "ord",
        text.text_token(raw, 6).alias("token"),
        text.text_nan(raw, 6).alias("nan_only"),
        text.text_blank(raw, 6).alias("blank_only"),
        text.text_meter(raw).alias("meter"),
        text.text_kept(raw).alias("kept"),
        text.text_flag(raw, 6).alias("flag"),
    )


@query(
    "key_predicates",
    f"SELECT ord, {q.missing('num_recibo')} AS is_missing, coalesce({q.invalid_id('num_recibo')}, false) AS is_invalid, "
    "(per_consumo IS NULL OR trim(per_consumo) = '') AS is_blank, "
    "coalesce(lower(trim(tarifa)) = 'nan', false) AS is_nan_rate "
    f"FROM ({duck(BILLS)})",
)
def key_predicates(spark, sf):
    receipt = F.col("num_recibo")
    return derive(spark, sf, BILLS).select(
        "ord",
        quarantine.missing_id(receipt).alias("is_missing"),
        F.coalesce(quarantine.invalid_id(receipt), F.lit(False)).alias("is_invalid"),
        text.is_blank(F.col("per_consumo")).alias("is_blank"),
        F.coalesce(text.same_text(F.col("tarifa"), F.lit(" NAN ")), F.lit(False)).alias("is_nan_rate"),
    )


_PLACES = """
SELECT c_custkey AS id, CASE c_custkey % 11
  WHEN 0 THEN '-' || cast(c_custkey % 90 as string) || ',0464'
  WHEN 1 THEN cast(c_custkey % 90 as string) || '.5 S'
  WHEN 2 THEN '-' || cast(c_custkey % 90 as string) || '.5 S'
  WHEN 3 THEN cast(c_custkey % 90 as string) || '°02''47"S'
  WHEN 4 THEN cast(c_custkey % 180 as string) || '°01''42,5" O'
  WHEN 5 THEN 'abc'
  WHEN 6 THEN NULL
  WHEN 7 THEN ' ' || cast(c_custkey % 90 as string) || ' '
  WHEN 8 THEN cast(c_custkey % 90 as string) || ' ° 30 n'
  WHEN 9 THEN cast(c_custkey as string) || '999'
  ELSE '+' || cast(c_custkey % 90 as string) || '.123456789E' END AS place
FROM {customer}
"""
# Fixed value: coordinates as they are written.
_DMS = "^\\s*(\\d+)(?:\\s*[°º]\\s*(\\d+))?(?:\\s*[''’′m]\\s*(\\d+(?:[.,]\\d+)?))?(?:\\s*[\"”″s])?\\s*([NnSsEeWwOo])?\\s*$"


def _piece(i: int) -> str:
    return f"coalesce(TRY_CAST(replace(nullif(regexp_extract(trim(place), '{_DMS}', {i}), ''), ',', '.') AS DOUBLE), 0)"


@query(
    "parse_coords",
    "SELECT id, place, CAST(TRY_CAST(CASE "
    "WHEN regexp_full_match(trim(place), '\\s*[+-]?\\d+([.,]\\d+)?\\s*[NSEWOnsewo]?\\s*') THEN "
    "TRY_CAST(replace(regexp_replace(trim(place), '[^0-9+\\-.,]', '', 'g'), ',', '.') AS DECIMAL(11,8)) "
    "* CASE WHEN regexp_matches(trim(place), '[SWOswo]') THEN -1 ELSE 1 END "
    f"WHEN regexp_matches(trim(place), '(?i){_DMS}') THEN TRY_CAST({_piece(1)} + {_piece(2)} / 60 + {_piece(3)} / 3600 AS DECIMAL(11,8)) "
    f"* CASE WHEN upper(regexp_extract(trim(place), '{_DMS}', 4)) IN ('S','W','O') THEN -1 ELSE 1 END "
    f"END AS DECIMAL(11,8)) AS DOUBLE) AS degrees FROM ({duck(_PLACES)})",
)
def parse_coords(spark, sf):
    return derive(spark, sf, _PLACES).select("id", "place", places.coordinate(F.col("place")).alias("degrees"))


_PERIODS = """
SELECT o_orderkey AS ord, CASE o_orderkey % 9
  WHEN 0 THEN cast(year(o_orderdate) + 10 as string) || '-' || lpad(cast(month(o_orderdate) as string), 2, '0')
  WHEN 1 THEN cast(year(o_orderdate) + 10 as string) || '/' || cast(month(o_orderdate) as string)
  WHEN 2 THEN lpad(cast(month(o_orderdate) as string), 2, '0') || '-' || cast(year(o_orderdate) + 10 as string)
  WHEN 3 THEN 'Setiembre ' || cast(year(o_orderdate) + 10 as string)
  WHEN 4 THEN cast(year(o_orderdate) + 10 as string) || lpad(cast(month(o_orderdate) as string), 2, '0')
  WHEN 5 THEN 'sep'
  WHEN 6 THEN ' DIC. ' || cast(year(o_orderdate) + 10 as string)
  WHEN 7 THEN ''
  ELSE 'marzo y abril ' || cast(year(o_orderdate) + 10 as string) END AS period_text
FROM {orders}
"""
# Fixed value: periods as they are written.
_PERIOD = r"(?:(20\d{2})[/-](0?[1-9]|1[0-2]))|((0?[1-9]|1[0-2])[/-](20\d{2}))"
# Months as they are written, longer names before their beginnings.
_MONTHS_SQL = " ".join(
    f"WHEN strpos(p, '{name}') > 0 THEN '{number}'"
    for number, names in (
        ("01", ("enero", "ene")), ("02", ("febrero", "feb")), ("03", ("marzo", "mar")), ("04", ("abril", "abr")),
        ("05", ("mayo", "may")), ("06", ("junio", "jun")), ("07", ("julio", "jul")), ("08", ("agosto", "ago")),
        ("09", ("setiembre", "septiembre", "set", "sep")), ("10", ("octubre", "oct")), ("11", ("noviembre", "nov")),
        ("12", ("diciembre", "dic")),
    )
    for name in names
)


def _group(i: int) -> str:
    return f"nullif(regexp_extract(p, '{_PERIOD}', {i}), '')"


@query(
    "period_from_text",
    f"WITH t AS (SELECT ord, period_text, lower(trim(period_text)) AS p FROM ({duck(_PERIODS)})) "
    f"SELECT ord, period_text, coalesce(coalesce({_group(1)}, {_group(5)}) || lpad(coalesce({_group(2)}, {_group(4)}), 2, '0'), "
    f"nullif(regexp_extract(p, '20\\d{{2}}'), '') || CASE {_MONTHS_SQL} END, "
    "nullif(regexp_extract(p, '20\\d{2}(0[1-9]|1[0-2])'), '')) AS period FROM t",
)
def period_from_text(spark, sf):
    return derive(spark, sf, _PERIODS).select(
        "ord", "period_text", places.billing_period(F.col("period_text")).alias("period")
    )


_CODES = """
SELECT o_orderkey AS ord, CASE o_orderkey % 6 WHEN 0 THEN cast(o_orderkey as string) || '.0'
  WHEN 1 THEN ' ' || cast(o_orderkey as string) WHEN 2 THEN 'SUM-' || cast(o_orderkey as string)
  WHEN 3 THEN 'none' WHEN 4 THEN '' ELSE '1.5e3' END AS code,
  '  S' || cast(o_custkey as string) || '_' || o_orderpriority || '_x ' AS site
FROM {orders}
"""
_IS_FLOAT = "regexp_full_match(trim(code), '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?')"


@query(
    "code_digits",
    f"SELECT ord, CASE WHEN {_IS_FLOAT} THEN CAST(CAST(trunc(CAST(trim(code) AS DOUBLE)) AS BIGINT) AS VARCHAR) "
    "ELSE nullif(regexp_replace(code, '\\D', '', 'g'), '') END AS digits, "
    "split_part(trim(site), '_', 1) AS site_code, substring(sha256(site), 1, 12) AS sha_id, substring(md5(site), 1, 8) AS md5_id "
    f"FROM ({duck(_CODES)})",
)
def code_digits(spark, sf):
    site = F.col("site")
    return derive(spark, sf, _CODES).select(
        "ord",
        numbers.code_digits(F.col("code")).alias("digits"),
        text.before_separator(site).alias("site_code"),
        text.short_sha(site).alias("sha_id"),
        text.short_md5(site).alias("md5_id"),
    )


@query(
    "calendar_labels",
    "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, "
    "CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month_start, "
    "CAST(isoyear(o_orderdate) AS VARCHAR) || '-' || lpad(CAST(weekofyear(o_orderdate) AS VARCHAR), 2, '0') AS week_label, "
    "CAST(CAST(date_trunc('week', o_orderdate) - interval 7 day AS DATE) AS VARCHAR) AS last_week, "
    "strftime(date_trunc('month', o_orderdate) - interval 1 month, '%Y%m') AS last_period, "
    "strftime(date_trunc('month', o_orderdate) - interval 1 month, '%m%y') AS last_short FROM orders",
)
def calendar_labels(spark, sf):
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        day.alias("day"),
        dates.month_start(day).alias("month_start"),
        dates.iso_week_label(day).alias("week_label"),
        dates.previous_week_start(day).alias("last_week"),
        dates.previous_period(day).alias("last_period"),
        dates.previous_period(day, "MMyy").alias("last_short"),
    )


@query(
    "date_windows",
    "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, "
    "(o_orderdate >= TIMESTAMP '1997-12-01' AND o_orderdate < TIMESTAMP '1998-06-01') AS in_months, "
    "(CAST(o_orderdate AS DATE) BETWEEN DATE '1998-04-29' AND DATE '1998-06-13') AS in_days, "
    "CAST(epoch(TIMESTAMP '1997-12-01') AS BIGINT) AS from_epoch, CAST(epoch(TIMESTAMP '1998-06-01') AS BIGINT) AS to_epoch, "
    "(CAST(o_orderdate AS DATE) <= DATE '1998-06-14') AS not_future FROM orders",
)
def date_windows(spark, sf):
    as_of, ts = F.lit(date(1998, 6, 14)), F.col("o_orderdate")
    start, end = dates.month_epochs(as_of, 6)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.to_date(ts).alias("day"),
        dates.in_last_months(ts, as_of, 6).alias("in_months"),
        dates.in_trailing_days(ts, as_of, 45).alias("in_days"),
        start.alias("from_epoch"),
        end.alias("to_epoch"),
        (F.to_date(ts) <= as_of).alias("not_future"),
    )


@query(
    "range_guard",
    "SELECT event_id, CAST(ts AS VARCHAR) AS ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-14 00:00:01' AND TIMESTAMP '2024-01-14 23:59:59'",
)
def range_guard(spark, sf):
    """Events of yesterday, by the range a request without one gets."""
    start, end = dates.checked_range(None, None, date(2024, 1, 15))
    ts = F.col("ts").cast(dates.NTZ)
    bounds = [F.lit(str(t)).cast(dates.NTZ) for t in (start, end)]
    return table(spark, sf, "events").where(ts.between(*bounds)).select("event_id", ts.alias("ts"))


@query(
    "payload_kind",
    "SELECT page_id, CASE WHEN strlen(html) >= 100 AND (strpos(lower(html[1:500]), '<!doctype html') > 0 OR "
    "strpos(lower(html[1:500]), '<html') > 0 OR strpos(lower(html[1:500]), '<head') > 0) THEN 'html' ELSE 'other' END AS kind, "
    "substring(sha256(html), 1, 12) AS file_id FROM pages",
)
def payload_kind(spark, sf):
    content = F.encode(F.col("html"), "UTF-8")
    return table(spark, sf, "pages").select(
        "page_id", text.payload_kind(content).alias("kind"), text.short_sha(content).alias("file_id")
    )
