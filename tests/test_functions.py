from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from lakeops.functions import dates, numbers, places, text


@pytest.mark.parametrize(
    "raw, want",
    [
        (None, None), ("", None), (" ", None), ("nan", None), ("1e5", D(15)), ("1,234", D(1234)), ("12,5", None),
        (".5", None), ("(5)", D(5)), ("-1,234,567.89", D("-1234567.89")), ("--5", None), ("S/ 10.00", D(10)),
        ("1,23", None), ("1,234.", None), ("12,34,567", None), ("5-", None),
    ],
)
def test_try_numeric(cleaned, raw, want):
    assert cleaned(numbers.try_numeric, [raw]) == [want]


def test_number_rounding_and_overflow(cleaned):
    to = lambda c: numbers.try_numeric(c, "decimal(18,2)")
    assert cleaned(to, ["2.345", "-2.345", "9" * 17]) == [D("2.35"), D("-2.35"), None]


def test_decimal_grammars_disagree(cleaned):
    values = ["1,234", "1.5", "+2,5", "x", " 7 ", "1,2,3"]
    assert cleaned(lambda c: numbers.decimal_comma(c, "decimal(18,2)"), values) == [D("1.23"), D("1.5"), D("2.5"), None, D(7), None]
    assert cleaned(lambda c: numbers.guarded_decimal(c, "decimal(18,3)"), values) == [D("1.234"), D("1.5"), D("2.5"), None, D(7), None]
    assert cleaned(numbers.locale_number, values) == [1.234, 1.5, 2.5, None, 7.0, 123.0]


def test_integers(cleaned):
    values = ["12.9", "-12.9", "7", " 7 ", "-7", "a", "99999999999"]
    assert cleaned(numbers.truncated_int, values) == [12, -12, 7, 7, -7, None, None]
    assert cleaned(numbers.digits_int, values) == [None, None, 7, 7, None, None, None]
    assert cleaned(numbers.signed_int, values) == [None, None, 7, 7, -7, None, 99999999999]


@pytest.mark.parametrize(
    "kind, want",
    [
        ("int", [0, 0, 0, 12, 1, 0]),
        ("decimal", [0.0, 0.0, 0.0, 12.7, 1.234, 0.0]),
        ("str", [None, None, "x", "12.7", "1,234", "1d"]),
    ],
)
def test_form_value(cleaned, kind, want):
    assert cleaned(lambda c: numbers.form_value(c, kind), [None, " ", "x", "12.7", "1,234", "1d"]) == want
    if kind != "str":
        strict = cleaned(lambda c: numbers.form_value(c, kind, zero_when_empty=False), [None, "x"])
        assert strict == [None, None]


DAY = date(2024, 3, 5)
DAYS = ["05/03/2024", "2024-03-05", "05-03-2024", "05.03.2024", "05/03/24", "31/02/2024", "2024-03-05 00:00:00", "null", " 2024-03-05", "5/3/2024"]


@pytest.mark.parametrize(
    "clean, want",
    [
        (dates.date_slash_or_iso, [DAY, DAY, None, None, None, None, DAY, None, None, DAY]),
        (dates.date_any_separator, [DAY, DAY, DAY, DAY, None, None, DAY, None, None, None]),
        (dates.date_exact, [DAY, DAY, DAY, None, None, None, None, None, None, None]),
        (dates.date_short_year, [DAY, DAY, None, None, DAY, None, None, None, DAY, None]),
        (dates.date_any, [DAY, DAY, DAY, None, None, None, None, None, DAY, DAY]),
    ],
)
def test_dates(cleaned, clean, want):
    assert cleaned(clean, DAYS) == want


def test_two_digit_years(cleaned):
    assert cleaned(dates.date_short_year, ["01/01/69", "01/01/70"]) == [date(2069, 1, 1), date(1970, 1, 1)]


TIMES = [
    "2024-03-05T13:07:09.123Z", "05/03/2024 13:07", "05/03/24 1:07 PM", "05-03-2024 13:07:09", "2024-03-05  13:07",
    "05/03/24 12:30 am", "2024-03-05", "n/a", "05/03/24 13:07 PM", "31/02/2024 10:00:00",
]


@pytest.mark.parametrize(
    "clean, want",
    [
        (dates.timestamp_field, [None, (13, 7), (13, 7), None, (13, 7), (0, 30), None, None, None, None]),
        (dates.timestamp_order, [(13, 7, 9), (13, 7), None, (13, 7, 9), None, None, (0, 0), None, None, None]),
    ],
)
def test_timestamps(cleaned, clean, want):
    assert cleaned(clean, TIMES) == [w and datetime(2024, 3, 5, *w) for w in want]


def test_meter_timestamp(cleaned):
    found = cleaned(dates.timestamp_meter, ["-", " N/A", None, "2024-03-05 13:00", "soon"])
    assert found == [None, None, None, datetime(2024, 3, 5, 13), None]


@pytest.mark.parametrize("zone", ["UTC", "America/Lima"])
def test_zone_does_not_matter(spark, cleaned, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert cleaned(dates.timestamp_order, ["05/03/2024 13:07"]) == [datetime(2024, 3, 5, 13, 7)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "raw, want",
    [
        ("-12,0464", D("-12.04640000")), ("12.5 S", D("-12.50000000")), ("-12.5 S", D("12.50000000")),
        ("12°02'47\"S", D("-12.04638889")), ("77°01'42\" O", D("-77.02833333")), ("abc", None), (None, None),
        ("12 n", D("12.00000000")), ("1234.5", None),
    ],
)
def test_coordinate(cleaned, raw, want):
    assert cleaned(places.coordinate, [raw]) == [want]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("Setiembre 2024", "202409"), ("2024/9", "202409"), ("09-2024", "202409"), ("12/2024", "202412"),
        ("2024-12", "202401"), ("202409", "202409"), ("sep", None), ("", None), (None, None), ("enero de 2023", "202301"),
    ],
)
def test_billing_period(cleaned, raw, want):
    assert cleaned(places.billing_period, [raw]) == [want]


def test_code_digits(cleaned):
    assert cleaned(numbers.code_digits, ["12.0", "SUM-7", "none", "", "1.5e3", "-5.9"]) == ["12", "7", None, None, "1500", "-5"]


def test_null_policies(cleaned):
    values = ["nan", "NaN", " NULL ", "-", "n/a", "  ", None, " ok "]
    assert cleaned(text.text_token, values) == [None, None, None, "-", "n/a", None, None, "ok"]
    assert cleaned(text.text_nan, values) == ["nan", None, "NULL", "-", "n/a", None, None, "ok"]
    assert cleaned(text.text_blank, values) == ["nan", "NaN", "NULL", "-", "n/a", None, None, "ok"]
    assert cleaned(text.text_meter, values) == [None, None, None, None, None, None, None, "ok"]
    assert cleaned(text.text_kept, values)[5:] == ["", None, "ok"]


def test_trim_keeps_tabs_and_strip_does_not(cleaned):
    assert cleaned(text.text_blank, ["\tx"]) == ["\tx"]
    assert cleaned(text.before_separator, ["\t S1_a_b "]) == ["S1"]


HEADERS = ["Código Suministro", " Fecha-Emisión ", "Pago (S/.)", "Ñandú üx", None]


def test_headers_agree(cleaned):
    want = ["codigo_suministro", "fecha_emision", "pago_s", "nandu_x", ""]
    assert cleaned(text.header_key, HEADERS) == want
    assert [text.header_key_of(h) for h in HEADERS] == want


def test_dash_forms(cleaned):
    assert cleaned(text.has_digits_after_dash, ["R-1", "R– 2", "R—3", "R4", "R-x"]) == [True, True, True, False, False]


def test_payload_kind(spark):
    files = [(b"PK\x03\x04rest",), (b"<HTML>" + b" " * 100,), (b"<html>",), (b"a,b\n1,2\n",)]
    rows = spark.createDataFrame(files, "content binary")
    kinds = [r[0] for r in rows.select(text.payload_kind(F.col("content"))).collect()]
    assert kinds == ["zip", "html", "other", "other"]


def test_week_window(spark):
    day = F.lit(date(2025, 1, 6))
    row = spark.range(1).select(dates.previous_week_start(day), dates.iso_week_label(dates.previous_week_start(day))).first()
    assert tuple(row) == (date(2024, 12, 30), "2025-01")


def test_checked_range():
    as_of = date(2024, 3, 1)
    assert dates.checked_range(None, None, as_of) == (datetime(2024, 2, 29, 0, 0, 1), datetime(2024, 2, 29, 23, 59, 59))
    month = datetime(2024, 1, 1), datetime(2024, 2, 1, 23)
    assert dates.checked_range(*month, as_of) == month
    with pytest.raises(ValueError, match="exceeds 31"):
        dates.checked_range(datetime(2024, 1, 1), datetime(2024, 2, 2), as_of)
    with pytest.raises(ValueError):
        dates.checked_range(datetime(2024, 1, 1), None, as_of)
