"""Meter readings: hours without copies, then days and months. All sums combine before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.dates import month_start, timestamp_meter
from lakeops.functions.numbers import try_numeric
from lakeops.functions.text import text_meter, text_nan

SITE, OBJECT, START, SUBNET = "site_name", "manage_object", "start_time", "subnet"
HOURLY = ("energy_consumption_per_hour_kwh", "supply_duration_per_hour_h", "total_energy_consumption_kwh")
DAILY = ("energy_consumption_per_day_kwh", "supply_duration_per_day_h", "total_energy_consumption_per_day_kwh")
MONTHLY = (
    "energy_consumption_per_month_kwh",
    "supply_duration_per_month_h",
    "total_energy_consumption_per_month_kwh",
)
AMOUNT = "decimal(18,4)"


def clean_readings(landing: DataFrame) -> DataFrame:
    """All-text landing rows to typed rows; rows without site, object or time go."""
    texts = [text_nan(F.col(c)).alias(c) for c in (SITE, SUBNET, OBJECT)]
    amounts = [try_numeric(text_meter(F.col(c)), AMOUNT).alias(c) for c in HOURLY]
    typed = landing.select(*texts, timestamp_meter(F.col(START)).alias(START), *amounts)
    return typed.dropna(subset=[SITE, OBJECT, START])


def hour_dedup(readings: DataFrame) -> DataFrame:
    """One row per site, object and time, each column at its own greatest value."""
    return readings.groupBy(SITE, OBJECT, START).agg(
        F.max(SUBNET).alias(SUBNET), *[F.max(c).alias(c) for c in HOURLY]
    )


def _rollup(
    rows: DataFrame, period: Column, name: str, measures: Sequence[str], totals: Sequence[str]
) -> DataFrame:
    sums = [F.sum(m).try_cast(AMOUNT).alias(t) for m, t in zip(measures, totals)]
    return rows.groupBy(SITE, OBJECT, period.alias(name)).agg(F.max(SUBNET).alias(SUBNET), *sums)


def _until(hours: DataFrame, as_of: Column | None) -> DataFrame:
    return hours if as_of is None else hours.where(F.to_date(START) <= as_of)


def daily_rollup(hours: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Sums per site, object and day, up to ``as_of``."""
    return _rollup(_until(hours, as_of), F.to_date(START), "fecha", HOURLY, DAILY)


def monthly_rollup(hours: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Sums per site, object and month of the hours given.

    Over a batch that holds part of a month, this gives that part only.
    """
    return _rollup(_until(hours, as_of), month_start(F.col(START)), "mes", HOURLY, MONTHLY)


def months_from_days(days: DataFrame) -> DataFrame:
    """Month sums over stored days, so that a partial batch cannot shrink a month."""
    return _rollup(days, month_start(F.col("fecha")), "mes", DAILY, MONTHLY)
