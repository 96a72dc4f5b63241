"""High-consumption report over a daily series.

Rows of a site are never gathered. Three per-site tables (last day, statistics, activity) are
aggregated and joined back with salting, so one site may hold most of the rows. What is read more
than once is written to the shared folder: the last days, the rows inside the window, the statistics
and the activity. The functions below therefore run jobs.

With a kept state (``STATE``: each site's last day and last anomaly) a daily run over a store that is
partitioned by day opens only the days that lie in some site's window, and the state takes the place of
the last days (``report_of_store``).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.load import stored_like
from lakeops.operators.skew import Facts, attach_facts, write_facts
from lakeops.operators.stats import group_facts
from lakeops.session import scratch_scope, written
from lakeops.sources.tables import Table

# --- fixed values: names in the exported report ------------------------------------------
RECENT_PREFIX = "consumo_dia_"
HEADINGS = {
    "site_name": "Site Name", "fecha": "Fecha", "consumo": "Consumo Diario kWh", "median_30d": "Mediana 30d",
    "std_30d": "Std Dev 30d", "cv": "CV", "pct_diff": "Variación %", "window_start": "Ventana Inicio",
    "window_end": "Ventana Fin", "window_samples": "Muestras Ventana",
}
# ------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class AnomalySettings:
    """``window_days`` up to each site's own last day give its baseline. A day is anomalous when it
    exceeds the median by ``pct_threshold`` and std / median is at most ``cv_max``. A site with
    ``normal_streak`` rows after its last anomaly is left out, unless that is 0 or less."""

    window_days: int = 30
    pct_threshold: float = 0.80
    cv_max: float = 0.5
    recent_days: int = 7
    normal_streak: int = 3
    rows_per_task: int | None = None


def series(df: DataFrame, site: str, day: str, value: str, tie: str | None = None) -> DataFrame:
    """``(site_name, fecha, consumo, objeto)`` without rows that lack one of the first three."""
    named = df.select(
        F.col(site).cast("string").alias("site_name"),
        F.to_date(day).alias("fecha"),
        F.col(value).cast("double").alias("consumo"),
        (F.col(tie).cast("string") if tie else F.lit("")).alias("objeto"),
    )
    return named.dropna(subset=["site_name", "fecha", "consumo"])


def flag_anomalies(rows: DataFrame, s: AnomalySettings, ends: Facts | None = None) -> DataFrame:
    """Rows of each site's window with baseline, ``pct_diff`` and ``is_anomaly``. ``ends`` has every
    site's ``window_end`` and how many rows it has, or about."""
    return _flag(rows, s, ends)[0]


def _flag(rows: DataFrame, s: AnomalySettings, ends: Facts | None) -> tuple[DataFrame, Facts]:
    """Flagged rows and the statistics, which have the rows of each site."""
    key, spread = ["site_name"], ["fecha", "objeto", "consumo"]
    if ends is None:
        last = rows.groupBy(*key).agg(F.max("fecha").alias("window_end"), F.count(F.lit(1)).alias("n"))
        ends = write_facts(last, "n", "site-ends")
    window = (
        attach_facts(rows, ends, key, spread_by=spread, rows_per_task=s.rows_per_task)
        .withColumn("window_start", F.date_sub("window_end", s.window_days - 1))
        .where(F.col("fecha") >= F.col("window_start"))
    )
    window = written(window.select(*key, "fecha", "consumo", "objeto", "window_end", "window_start"), "site-window")
    weights = (ends.largest, ends.total)
    stats = group_facts(window, key, "consumo", spread_by=spread, rows_per_task=s.rows_per_task, weights=weights)
    joined = attach_facts(window, stats, key, spread_by=spread, rows_per_task=s.rows_per_task)
    median = F.col("median")
    baseline = joined.withColumns(
        {
            "cv": F.when(median > 0, F.col("std") / median),
            "pct_diff": F.when(median > 0, (F.col("consumo") - median) / median * 100),
        }
    )
    hit = (F.col("cv") <= s.cv_max) & (F.col("pct_diff") >= s.pct_threshold * 100)
    return baseline.withColumn("is_anomaly", F.coalesce(hit, F.lit(False))), stats


def site_activity(flagged: DataFrame, s: AnomalySettings) -> DataFrame:
    """Per site: anomalous rows, rows after the last anomaly, and the first value of recent days.

    Rows shrink to one per site and day before a site is gathered, so a site gathers at most
    ``window_days`` entries.
    """
    day = flagged.groupBy("site_name", "window_end", "fecha").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_anomaly").alias("hits"),
        F.min_by("consumo", F.struct("objeto", "consumo")).alias("first_value"),
    )
    site = day.groupBy("site_name", "window_end").agg(
        F.sum("hits").alias("hits"),
        F.max(F.when(F.col("hits") > 0, F.col("fecha"))).alias("last_anomaly"),
        F.collect_list(F.struct("fecha", "n", "first_value")).alias("days"),
    )
    later = F.filter("days", lambda d: d.fecha > F.col("last_anomaly"))
    after = F.aggregate(later, F.lit(0).cast("bigint"), lambda total, d: total + d.n)
    by_day = F.map_from_entries(F.transform("days", lambda d: F.struct(d.fecha, d.first_value)))
    recent = {
        f"{RECENT_PREFIX}{i}": F.try_element_at(by_day, F.date_sub("window_end", s.recent_days - i))
        for i in range(1, s.recent_days + 1)
    }
    return site.withColumns({"rows_after": after, **recent}).drop("days", "window_end")


def anomaly_report(rows: DataFrame, settings: AnomalySettings | None = None) -> DataFrame:
    """Anomalous rows of sites still in alarm, within their recent days, with the recent values."""
    s = settings or AnomalySettings()
    flagged, stats = _flag(rows, s, None)
    return _reported(flagged, written(site_activity(flagged, s), "site-activity"), stats, s)


def _reported(flagged: DataFrame, activity: DataFrame, stats: Facts, s: AnomalySettings) -> DataFrame:
    active = activity.where("hits > 0")
    if s.normal_streak > 0:
        active = active.where(F.col("rows_after") < s.normal_streak)
    active = Facts(active, "hits", stats.largest, stats.total)  # a site has no more hits than rows
    hits = flagged.where(F.col("is_anomaly") & (F.col("consumo") > F.col("median")))
    if s.recent_days > 0:
        hits = hits.where(F.col("fecha") >= F.date_sub("window_end", s.recent_days - 1))
    spread = ["fecha", "objeto", "consumo"]
    reported = attach_facts(hits, active, ["site_name"], spread_by=spread, rows_per_task=s.rows_per_task)
    recent = [f"{RECENT_PREFIX}{i + 1}" for i in range(max(s.recent_days, 0))]
    return reported.select(
        "site_name", "fecha", "consumo", F.col("median").alias("median_30d"), F.col("std").alias("std_30d"),
        "cv", "pct_diff", "window_start", "window_end", F.col("n").alias("window_samples"), *recent,
    ).orderBy("site_name", "fecha")


# --- kept state -----------------------------------------------------------------------------------

#: ``n`` is how many rows a site had in its largest batch, which tells hot sites.
STATE = "site_name string, last_day date, n bigint, last_anomaly date"


def state_table(spark: SparkSession, path: str) -> Table:
    return Table(spark, path, STATE, key=("site_name",))


def update_state(state: Table, batch: DataFrame) -> None:
    """Take a batch of ``series`` rows into the state; a repeated or late one leaves later days as they are."""
    seen = batch.groupBy("site_name").agg(F.max("fecha").alias("last_day"), F.count(F.lit(1)).alias("n"))
    seen = seen.withColumn("last_anomaly", F.lit(None).cast("date"))
    _merge_state(state, seen)


def _merge_state(state: Table, seen: DataFrame) -> None:
    with scratch_scope(state.spark):
        seen = written(seen, "site-state")
        both = stored_like(state.read(), seen, ["site_name"]).select(*seen.columns).unionByName(seen)
        state.upsert(both.groupBy("site_name").agg(*[F.max(c).alias(c) for c in ("last_day", "n", "last_anomaly")]))


def in_windows(last_days: Iterable[date], window_days: int, column: str = "fecha") -> Column:
    """Whether a day lies in the window of one of the last days, as ranges that prune partitions."""
    ranges: list[tuple[date, date]] = []
    for end in sorted(last_days):
        begin = end - timedelta(days=window_days - 1)
        if ranges and begin <= ranges[-1][1] + timedelta(days=1):
            ranges[-1] = (ranges[-1][0], end)
        else:
            ranges.append((begin, end))
    day = F.col(column)
    return reduce(lambda a, b: a | b, (day.between(F.lit(a), F.lit(b)) for a, b in ranges), F.lit(False))


def report_of_store(days: Table, state: Table, value: str, tie: str | None = None, settings: AnomalySettings | None = None) -> DataFrame:
    """``anomaly_report`` over a store of daily rows (site_name, fecha, ...) that is partitioned by
    ``fecha``, from the kept state; days outside all windows aren't opened. The distinct last days, which
    name partitions, come to the driver. Writes each site's last anomaly to the state."""
    s = settings or AnomalySettings()
    known = state.read()
    last_days = [r[0] for r in known.select("last_day").distinct().collect()]
    ends = Facts(
        known.select("site_name", F.col("last_day").alias("window_end"), "n"), "n",
        *known.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first(),
    )
    rows = series(days.read().where(in_windows(last_days, s.window_days)), "site_name", "fecha", value, tie)
    flagged, stats = _flag(rows, s, ends)
    activity = written(site_activity(flagged, s), "site-activity")
    alarms = activity.where("last_anomaly is not null")
    day, none = F.col("last_anomaly"), F.lit(0).cast("bigint")
    _merge_state(state, alarms.select("site_name", day.alias("last_day"), none.alias("n"), "last_anomaly"))
    return _reported(flagged, activity, stats, s)
