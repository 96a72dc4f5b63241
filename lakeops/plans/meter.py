"""Meter job: hourly landing rows -> daily and monthly stores."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.dates import month_start
from lakeops.operators import load, rollup
from lakeops.session import few, scratch_scope, written
from lakeops.sources.tables import Table

DAY_KEY = ("site_name", "manage_object", "fecha")
MONTH_KEY = ("site_name", "manage_object", "mes")


def _schema(period: str, totals: tuple[str, ...]) -> str:
    sums = ", ".join(f"{t} {rollup.AMOUNT}" for t in totals)
    return f"site_name string, manage_object string, subnet string, {sums}, {period} date"


DAY_SCHEMA = _schema("fecha", rollup.DAILY)
MONTH_SCHEMA = _schema("mes", rollup.MONTHLY)


def day_table(spark: SparkSession, path: str) -> Table:
    """Days are partitions, so an upsert rewrites only the days a batch touches."""
    return Table(spark, path, DAY_SCHEMA, partition_by=["fecha"])


def month_table(spark: SparkSession, path: str) -> Table:
    return Table(spark, path, MONTH_SCHEMA, partition_by=["mes"])


def _apply(table: Table, batch: DataFrame, keys: tuple[str, ...], period: str) -> dict[str, int]:
    batch = written(batch, f"rollup-{period}")
    stored, small = table.read_touched(batch), few(batch)
    done = written(load.applied(stored, batch, keys, few=small), f"applied-{period}")
    counts = load.action_counts(done).first().asDict()
    table.replace_partitions(load.next_state(load.with_rest(stored, done, keys, small)))
    return {name: counts[name] for name in ("inserted", "updated")}


def load_readings(
    spark: SparkSession, landing: DataFrame, days: Table, months: Table, as_of: date, month_source: str = "daily"
) -> dict[str, object]:
    """Clean, dedup and roll up one batch into both stores.

    ``month_source='daily'`` sums the stored days of each touched month. ``'batch'`` sums the batch
    alone, which overwrites a month by whatever part of it the batch holds.
    """
    if month_source not in ("daily", "batch"):
        raise ValueError(f"unknown month source {month_source!r}")
    with scratch_scope(spark):
        return _load_readings(landing, days, months, F.lit(as_of).cast("date"), month_source)


def _load_readings(
    landing: DataFrame, days: Table, months: Table, limit: Column, month_source: str
) -> dict[str, object]:
    return load_hours(written(rollup.hour_dedup(rollup.clean_readings(landing)), "hours"), days, months, limit, month_source)


def load_hours(hours: DataFrame, days: Table, months: Table, limit: Column, month_source: str) -> dict[str, object]:
    """Roll a written table of hours up into both stores."""
    daily = _apply(days, rollup.daily_rollup(hours, limit), DAY_KEY, "fecha")
    if month_source == "batch":
        by_month = rollup.monthly_rollup(hours, limit)
    else:
        touched = written(rollup.monthly_rollup(hours, limit).select(*MONTH_KEY), "touched-months")
        # The few months of a batch, as literals, prune the day partitions that are summed.
        months_of = [r[0] for r in touched.select("mes").distinct().collect()]
        stored = days.read().where(month_start(F.col("fecha")).isin(months_of))
        by_month = rollup.months_from_days(stored).join(touched, list(MONTH_KEY), "left_semi")
    monthly = _apply(months, by_month, MONTH_KEY, "mes")
    message = "days: insert %s update %s | months: insert %s update %s" % (
        daily["inserted"], daily["updated"], monthly["inserted"], monthly["updated"],
    )
    return {
        "inserted": daily["inserted"] + monthly["inserted"],
        "updated": daily["updated"] + monthly["updated"],
        "message": message,
    }
