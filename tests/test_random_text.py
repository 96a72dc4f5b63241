"""Cleaning rules against plain-Python statements of them, over random text."""

import random
import re
import unicodedata
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

from lakeops.functions import dates, numbers, places, text


def _texts(alphabet, n=3000, longest=12, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(n)]


def test_try_numeric(cleaned):
    def rule(s):
        kept = "".join(ch for ch in s if ch in "0123456789,.-")
        if re.fullmatch(r"-?\d+(\.\d+)?", kept) or re.fullmatch(r"-?\d{1,3}(,\d{3})+(\.\d+)?", kept):
            return Decimal(kept.replace(",", "")).quantize(Decimal("0.01"), ROUND_HALF_UP)
        return None

    values = _texts("0123456789,,..--S /e") + _texts("0123,", longest=10)
    got = cleaned(lambda c: numbers.try_numeric(c, "decimal(18,2)"), values)
    assert got == [rule(v) for v in values]


def test_locale_number(cleaned):
    def rule(s):
        s = s.strip()
        s = s.replace(",", ".") if s.count(",") == 1 and "." not in s else s.replace(",", "")
        try:
            return float(s)
        except ValueError:
            return None

    values = _texts("0123456789,.-+e \t")
    assert cleaned(numbers.locale_number, values) == [rule(v) for v in values]


def test_code_digits(cleaned):
    def rule(s):
        try:
            whole = int(float(s))
        except (ValueError, OverflowError):
            whole = None
        if whole is not None and abs(whole) < 2**63:
            return str(whole)
        return re.sub(r"\D", "", s) or None  # no number, or one too large to be a code

    values = _texts("0123456789.-aE", longest=8)
    assert cleaned(numbers.code_digits, values) == [rule(v) for v in values]


def test_header_key(cleaned):
    def rule(s):
        s = s.strip().lower()
        s = "".join(unicodedata.normalize("NFD", ch)[0] if ch in "áéíóúñ" else ch for ch in s)
        return re.sub(r"[^a-z0-9_]+", "", re.sub(r"[-\s]+", "_", s))

    values = _texts("aZ09_ -\táéíóúñÑÁü%()")
    assert cleaned(text.header_key, values) == [rule(v) for v in values]
    assert [text.header_key_of(v) for v in values] == [rule(v) for v in values]


def test_any_date(cleaned):
    def rule(s):
        for form in ("%d/%m/%Y", "%Y-%m-%d", "%d-%m-%Y"):
            try:
                return datetime.strptime(s.strip(), form).date()
            except ValueError:
                continue
        return None

    rng = random.Random(11)
    values = []
    for _ in range(3000):
        d, m, y = rng.randrange(1, 33), rng.randrange(0, 14), rng.randrange(1990, 2040)
        sep = rng.choice("/-. ")
        parts = [f"{d:02d}" if rng.random() < 0.5 else str(d), f"{m:02d}" if rng.random() < 0.5 else str(m), str(y)]
        if rng.random() < 0.4:
            parts.reverse()
        values.append(rng.choice(["", " "]) + sep.join(parts))
    assert cleaned(dates.date_any, values) == [rule(v) for v in values]


def test_billing_period(cleaned):
    def rule(s):
        s = s.strip().lower()
        found = re.search(places.PERIOD, s)
        if found:
            y1, m1, _, m2, y2 = found.groups()
            return f"{y1 or y2}{int(m1 or m2):02d}"
        year = re.search(r"20\d{2}", s)
        if year:
            for name, number in places.MONTHS.items():
                if name in s:
                    return f"{year.group()}{number:02d}"
        found = re.search(places.COMPACT_PERIOD, s)
        return found.group() if found else None

    rng = random.Random(2)
    words = ["2024", "2019", "12", "9", "03", "/", "-", " ", "Enero", "sep", "DIC", "marzo", "202409", "x"]
    values = ["".join(rng.choice(words) for _ in range(rng.randrange(1, 5))) for _ in range(3000)]
    assert cleaned(places.billing_period, values) == [rule(v) for v in values]
