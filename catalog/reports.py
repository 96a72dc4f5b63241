"""Rollups, reports and run statistics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from catalog.registry import DAILY, DAILY_OBJECTS, READINGS, RUNS, derive, duck, query
from lakeops.operators import rollup
from lakeops.plans import anomaly, gaps, runlog
from lakeops.session import scratch_path
from lakeops.sources.tables import Table

AS_OF = date(2024, 1, 31)

_HOURS = (
    "SELECT site_name, manage_object, start_time, max(subnet) AS subnet, max(energy_consumption_per_hour_kwh) AS e, "
    f"max(supply_duration_per_hour_h) AS h, max(total_energy_consumption_kwh) AS t FROM ({duck(READINGS)}) GROUP BY 1, 2, 3"
)
_SUMS = (
    "max(subnet) AS subnet, CAST(CAST(sum(e) AS DECIMAL(18,4)) AS DOUBLE) AS energy, "
    "CAST(CAST(sum(h) AS DECIMAL(18,4)) AS DOUBLE) AS hours, CAST(CAST(sum(t) AS DECIMAL(18,4)) AS DOUBLE) AS total"
)


@query(
    "hour_dedup",
    "SELECT site_name, manage_object, CAST(start_time AS VARCHAR) AS start_time, subnet, "
    f"CAST(e AS DOUBLE) AS energy, CAST(t AS DOUBLE) AS total FROM ({_HOURS})",
)
def hour_dedup(spark, sf):
    hours = rollup.hour_dedup(derive(spark, sf, READINGS))
    return hours.select(
        "site_name", "manage_object", F.col("start_time").cast("timestamp_ntz").alias("start_time"), "subnet",
        F.col(rollup.HOURLY[0]).alias("energy"), F.col(rollup.HOURLY[2]).alias("total"),
    )


def _totals(df, period, names):
    return df.select(
        "site_name", "manage_object", period, "subnet",
        *[F.col(c).alias(a) for c, a in zip(names, ("energy", "hours", "total"))],
    )


@query(
    "daily_rollup",
    f"SELECT site_name, manage_object, CAST(CAST(start_time AS DATE) AS VARCHAR) AS fecha, {_SUMS} FROM ({_HOURS}) "
    "WHERE CAST(start_time AS DATE) <= DATE '2024-01-25' GROUP BY 1, 2, 3",
)
def daily_rollup(spark, sf):
    hours = rollup.hour_dedup(derive(spark, sf, READINGS))
    return _totals(rollup.daily_rollup(hours, F.lit(date(2024, 1, 25))), "fecha", rollup.DAILY)


_BY_MONTH = (
    f"SELECT site_name, manage_object, CAST(CAST(date_trunc('month', start_time) AS DATE) AS VARCHAR) AS mes, {_SUMS} "
    f"FROM ({_HOURS}) GROUP BY 1, 2, 3"
)


@query("monthly_rollup", _BY_MONTH)
def monthly_rollup(spark, sf):
    hours = rollup.hour_dedup(derive(spark, sf, READINGS))
    return _totals(rollup.monthly_rollup(hours), "mes", rollup.MONTHLY)


@query("months_from_days", _BY_MONTH)
def months_from_days(spark, sf):
    days = rollup.daily_rollup(rollup.hour_dedup(derive(spark, sf, READINGS)))
    return _totals(rollup.months_from_days(days), "mes", rollup.MONTHLY)


# --- anomalies ----------------------------------------------------------------------------------


def _anomaly_sql(source: str, tie: str, cv_max: float, window: int = 30, recent: int = 7, streak: int = 3, pct: float = 0.8):
    picks = ", ".join(
        f"round(max(v) FILTER (WHERE rn = 1 AND day = last_day - {recent - 1 - i}), 4) AS consumo_dia_{i + 1}"
        for i in range(recent)
    )
    names = ", ".join(f"consumo_dia_{i + 1}" for i in range(recent))
    return (
        f"WITH s AS (SELECT site, day, CAST(value AS DOUBLE) AS v, {tie} AS tie FROM ({source})), "
        "e AS (SELECT *, max(day) OVER (PARTITION BY site) AS last_day FROM s), "
        f"w AS (SELECT * FROM e WHERE day >= last_day - {window - 1}), "
        "b AS (SELECT site, median(v) AS med, stddev_samp(v) AS sd, count(*) AS n FROM w GROUP BY site), "
        "f AS (SELECT w.*, med, sd, n, CASE WHEN med > 0 THEN sd / med END AS cv, "
        "CASE WHEN med > 0 THEN (v - med) / med * 100 END AS pct, "
        "row_number() OVER (PARTITION BY w.site, day ORDER BY tie, v) AS rn FROM w JOIN b USING (site)), "
        f"a AS (SELECT *, coalesce(cv <= {cv_max} AND pct >= {pct} * 100, false) AS hit FROM f), "
        "l AS (SELECT site, max(day) FILTER (WHERE hit) AS last_hit FROM a GROUP BY site), "
        "k AS (SELECT site FROM a JOIN l USING (site) WHERE last_hit IS NOT NULL GROUP BY site "
        f"HAVING count(*) FILTER (WHERE day > last_hit) < {streak}), "
        f"p AS (SELECT site, {picks} FROM a GROUP BY site) "
        "SELECT site AS site_name, CAST(day AS VARCHAR) AS fecha, round(v, 4) AS consumo, round(med, 4) AS median_30d, "
        "round(sd, 4) AS std_30d, round(cv, 4) AS cv, round(pct, 4) AS pct_diff, "
        f"CAST(CAST(last_day - {window - 1} AS DATE) AS VARCHAR) AS window_start, CAST(last_day AS VARCHAR) AS window_end, "
        f"n AS window_samples, {names} FROM a JOIN k USING (site) JOIN p USING (site) "
        f"WHERE hit AND v > med AND day >= last_day - {recent - 1}"
    )


def _rounded(report):
    doubles = {f.name for f in report.schema if f.dataType.typeName() == "double"}
    return report.select(*[F.round(c, 4).alias(c) if c in doubles else F.col(c) for c in report.columns])


@query("anomaly_report", _anomaly_sql(duck(DAILY), "''", 1.0))
def anomaly_report(spark, sf):
    rows = anomaly.series(derive(spark, sf, DAILY), "site", "day", "value")
    return _rounded(anomaly.anomaly_report(rows, anomaly.AnomalySettings(cv_max=1.0)))


@query("anomaly_recent_pivot", _anomaly_sql(duck(DAILY_OBJECTS), "object", 2.0, window=14, recent=5, streak=4, pct=0.5))
def anomaly_recent_pivot(spark, sf):
    """Several objects per site and day: the pivot shows the first object's value."""
    settings = anomaly.AnomalySettings(window_days=14, pct_threshold=0.5, cv_max=2.0, recent_days=5, normal_streak=4)
    rows = anomaly.series(derive(spark, sf, DAILY_OBJECTS), "site", "day", "value", tie="object")
    return _rounded(anomaly.anomaly_report(rows, settings))


@query("anomaly_report_from_state", _anomaly_sql(duck(DAILY_OBJECTS), "object", 2.0, window=14, recent=5, streak=4, pct=0.5))
def anomaly_report_from_state(spark, sf):
    """Two overlapping batches of days go into a store by day and a state; the report opens only windows."""
    settings = anomaly.AnomalySettings(window_days=14, pct_threshold=0.5, cv_max=2.0, recent_days=5, normal_streak=4)
    rows = derive(spark, sf, DAILY_OBJECTS).select(
        F.col("site").alias("site_name"), F.col("object").alias("manage_object"), F.col("value").alias("kwh"), F.col("day").alias("fecha")
    )
    days = Table(spark, scratch_path(spark, "days"), "site_name string, manage_object string, kwh decimal(18,4), fecha date", partition_by=["fecha"])
    state = anomaly.state_table(spark, scratch_path(spark, "state"))
    for batch in (rows.where("fecha < '2024-01-20'"), rows.where("fecha >= '2024-01-18'")):
        days.replace_partitions(batch)
        anomaly.update_state(state, anomaly.series(batch, "site_name", "fecha", "kwh", "manage_object"))
    return _rounded(anomaly.report_of_store(days, state, "kwh", "manage_object", settings))


@query(
    "site_baseline",
    f"WITH s AS (SELECT site, day, CAST(value AS DOUBLE) AS v FROM ({duck(DAILY_OBJECTS)})), "
    "w AS (SELECT *, max(day) OVER (PARTITION BY site) AS last_day FROM s) "
    "SELECT site AS site_name, count(*) AS n, round(median(v), 4) AS median, round(stddev_samp(v), 4) AS std "
    "FROM w WHERE day >= last_day - 29 GROUP BY site",
)
def site_baseline(spark, sf):
    rows = anomaly.series(derive(spark, sf, DAILY_OBJECTS), "site", "day", "value", tie="object")
    flagged = anomaly.flag_anomalies(rows, anomaly.AnomalySettings())
    return flagged.groupBy("site_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.any_value("median"), 4).alias("median"),
        F.round(F.any_value("std"), 4).alias("std"),
    )


# --- gaps -----------------------------------------------------------------------------------------

_GAPS = (
    "WITH d AS (SELECT DISTINCT split_part(trim(site), '_', 1) AS codigo_sitio, CAST(ts AS DATE) AS d FROM "
    "(SELECT ' ' || CAST(user_id AS VARCHAR) || '_' || event_type AS site, ts FROM events)), "
    "g AS (SELECT codigo_sitio, min(d) AS d0, count(*) AS found, "
    "count(*) FILTER (WHERE d BETWEEN DATE '2024-01-22' AND DATE '2024-01-30') AS week_found FROM d GROUP BY 1) "
    "SELECT codigo_sitio, CAST(d0 AS VARCHAR) AS fecha_inicio, '2024-01-31' AS fecha_fin, "
    "date_diff('day', d0, DATE '2024-01-31') + 1 AS dias_esperados, found AS dias_con_data, "
    "date_diff('day', d0, DATE '2024-01-31') + 1 - found AS dias_faltantes, '2024-04' AS semana_reporte, "
    "'2024-01-22' AS semana_inicio, '2024-01-30' AS semana_fin, CAST(9 AS BIGINT) AS dias_esperados_semana, "
    "week_found AS dias_con_data_semana, 9 - week_found AS dias_faltantes_semana, "
    "CASE WHEN 9 - week_found >= 7 THEN 'ALTO' WHEN 9 - week_found >= 4 THEN 'MEDIO' WHEN 9 - week_found >= 2 THEN 'BAJO' ELSE 'OK' END AS riesgo_actual "
    "FROM g"
)
_SITE_DAYS = "SELECT ' ' || cast(user_id as string) || '_' || event_type AS site, ts FROM {events}"


@query("gap_totals", _GAPS)
def gap_totals(spark, sf):
    return gaps.gap_totals(derive(spark, sf, _SITE_DAYS), "site", "ts", AS_OF)


@query("gap_report", _GAPS + " WHERE week_found < 9")
def gap_report(spark, sf):
    return gaps.gap_report(derive(spark, sf, _SITE_DAYS), "site", "ts", AS_OF)


@query("gap_report_from_sets", _GAPS + " WHERE week_found < 9")
def gap_report_from_sets(spark, sf):
    """Overlapping batches, the last one a repeat, are merged into kept day sets; the report reads those alone."""
    rows = derive(spark, sf, _SITE_DAYS)
    sets = gaps.day_set_table(spark, scratch_path(spark, "day-sets"))
    for part in ("ts < '2024-01-16'", "ts >= '2024-01-13'", "ts < '2024-01-04'"):
        gaps.load_days(rows.where(part), sets, "site", "ts")
    return gaps.gap_report_of_sets(sets.read(), AS_OF)


# --- run log ----------------------------------------------------------------------------------------


def _runs(spark, sf):
    runs = derive(spark, sf, RUNS)
    return runs.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("inicio", "fin")})


@query(
    "run_stats",
    "SELECT sp, count(*) AS runs, count(*) FILTER (WHERE estado = 'DONE') AS succeeded, "
    "count(*) FILTER (WHERE estado = 'ERROR') AS failed, "
    "round(100.0 * count(*) FILTER (WHERE estado = 'DONE') / count(*), 2) AS success_pct, "
    "round(avg(epoch(fin) - epoch(inicio)), 3) AS mean_seconds, "
    "CAST(max(epoch(fin) - epoch(inicio)) AS BIGINT) AS longest_seconds, CAST(max(fin) AS VARCHAR) AS last_end "
    f"FROM ({duck(RUNS)}) WHERE inicio >= TIMESTAMP '1996-01-01' AND inicio < TIMESTAMP '2001-01-01' GROUP BY sp",
)
def run_stats(spark, sf):
    ntz = lambda s: F.lit(s).cast("timestamp_ntz")
    return runlog.run_stats(_runs(spark, sf), ntz("1996-01-01"), ntz("2001-01-01"))


@query(
    "run_history",
    f"SELECT CAST(CAST(fin AS DATE) AS VARCHAR) AS day, sp, estado, count(*) AS runs FROM ({duck(RUNS)}) "
    "WHERE fin >= TIMESTAMP '1997-01-01' AND fin < TIMESTAMP '1999-01-01' GROUP BY 1, 2, 3",
)
def run_history(spark, sf):
    ntz = lambda s: F.lit(s).cast("timestamp_ntz")
    return runlog.run_history(_runs(spark, sf), ntz("1997-01-01"), ntz("1999-01-01"))


@query(
    "latest_run",
    f"SELECT id, sp, CAST(inicio AS VARCHAR) AS inicio, CAST(fin AS VARCHAR) AS fin, estado FROM ({duck(RUNS)}) "
    "WHERE sp = 'load_3' ORDER BY coalesce(fin, inicio, TIMESTAMP '1970-01-01') DESC, id DESC LIMIT 1",
)
def latest_run(spark, sf):
    return runlog.latest_run(_runs(spark, sf), "load_3")


@query("job_count", f"SELECT count(DISTINCT sp) AS jobs FROM ({duck(RUNS)})")
def job_count(spark, sf):
    return runlog.job_count(_runs(spark, sf))
