"""Missing-days report per site code.

From all rows (``gap_totals``, ``gap_report``), or from a kept table of day sets: a code's days as the
bits of a bitmap (``DAY_SETS``). Sets merge, so a batch costs its own rows and the sets of its codes,
a repeated or late batch changes nothing that is there, and the report reads no history.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.dates import iso_week_label, previous_week_start
from lakeops.functions.text import before_separator, risk_level
from lakeops.operators.load import stored_like
from lakeops.session import scratch_scope, written
from lakeops.sources.tables import Table

# --- fixed values: names in the exported report ------------------------------------------
HEADINGS = {
    "codigo_sitio": "Codigo Sitio", "fecha_inicio": "Primera Lectura", "fecha_fin": "Fecha Evaluacion",
    "dias_esperados": "Dias Esperados", "dias_con_data": "Dias con Data", "dias_faltantes": "Dias Faltantes",
    "semana_reporte": "Semana Reporte", "semana_inicio": "Semana Inicio", "semana_fin": "Semana Fin",
    "dias_esperados_semana": "Dias Esperados Semana - Ayer",
    "dias_con_data_semana": "Dias con Data Semana - Ayer",
    "dias_faltantes_semana": "Dias Faltantes Semana - Ayer", "riesgo_actual": "Riesgo Actual",
}
# ------------------------------------------------------------------------------------------


#: ``lote`` numbers stretches of 32768 days, as a bitmap has so many bits; ``primera`` is the first day.
DAY_SETS = "codigo_sitio string, lote bigint, primera date, dias binary"
DAY_KEY = ("codigo_sitio", "lote")


def site_days(df: DataFrame, site: str, day: str) -> DataFrame:
    """Distinct ``(codigo_sitio, d)``, so that a busy site reaches its reducer as one row per day."""
    code = before_separator(F.col(site).cast("string"))
    return df.select(code.alias("codigo_sitio"), F.to_date(day).alias("d")).dropna().distinct()


def gap_totals(df: DataFrame, site: str, day: str, as_of: date) -> DataFrame:
    """Per code: first day, days expected and found, over all time and since the last ISO week.
    Both counts come from one aggregation."""
    week_start, week_end = _week(as_of)
    found = site_days(df, site, day).groupBy("codigo_sitio").agg(
        F.min("d").alias("fecha_inicio"),
        F.count(F.lit(1)).alias("dias_con_data"),
        F.count_if(F.col("d").between(week_start, week_end)).alias("dias_con_data_semana"),
    )
    return _report(found, as_of)


def _week(as_of: date) -> tuple[Column, Column]:
    """From the last ISO week's first day to yesterday."""
    today = F.lit(as_of).cast("date")
    return previous_week_start(today), F.date_sub(today, 1)


def _report(found: DataFrame, as_of: date) -> DataFrame:
    today, (week_start, week_end) = F.lit(as_of).cast("date"), _week(as_of)
    expected = F.date_diff(today, F.col("fecha_inicio")) + 1
    in_week = F.date_diff(week_end, week_start) + 1
    missing = in_week - F.col("dias_con_data_semana")
    return found.select(
        "codigo_sitio",
        "fecha_inicio",
        today.alias("fecha_fin"),
        expected.cast("bigint").alias("dias_esperados"),
        "dias_con_data",
        (expected - F.col("dias_con_data")).alias("dias_faltantes"),
        iso_week_label(week_start).alias("semana_reporte"),
        week_start.alias("semana_inicio"),
        week_end.alias("semana_fin"),
        in_week.cast("bigint").alias("dias_esperados_semana"),
        "dias_con_data_semana",
        missing.alias("dias_faltantes_semana"),
        risk_level(missing).alias("riesgo_actual"),
    )


def _worst_first(totals: DataFrame) -> DataFrame:
    """Codes with days missing since the last ISO week."""
    return totals.where("dias_faltantes_semana > 0").orderBy(F.col("dias_faltantes_semana").desc(), "codigo_sitio")


def gap_report(df: DataFrame, site: str, day: str, as_of: date) -> DataFrame:
    """Codes with days missing since the last ISO week, worst first."""
    return _worst_first(gap_totals(df, site, day, as_of))


# --- kept day sets ------------------------------------------------------------------------------


def day_set_table(spark: SparkSession, path: str) -> Table:
    return Table(spark, path, DAY_SETS, key=DAY_KEY)


def _number(day: Column) -> Column:
    return F.unix_date(day).cast("bigint") + 1


def day_sets(df: DataFrame, site: str, day: str) -> DataFrame:
    """DAY_SETS of the rows given."""
    number = _number(F.col("d"))
    return site_days(df, site, day).groupBy("codigo_sitio", F.bitmap_bucket_number(number).alias("lote")).agg(
        F.min("d").alias("primera"), F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("dias")
    )


def merged_day_sets(sets: DataFrame) -> DataFrame:
    """One set of all that are given for a code."""
    return sets.groupBy(*DAY_KEY).agg(F.min("primera").alias("primera"), F.bitmap_or_agg("dias").alias("dias"))


def load_days(batch: DataFrame, table: Table, site: str, day: str) -> None:
    """Merge a batch's days into the table; only its codes' sets are read and written."""
    with scratch_scope(table.spark):
        new = written(day_sets(batch, site, day), "day-sets")
        known = stored_like(table.read(), new, DAY_KEY)
        table.upsert(merged_day_sets(known.select(*new.columns).unionByName(new)))


def has_day(day: Column) -> Column:
    """1 if the set of the row has the day, else 0."""
    at = F.bitmap_bit_position(_number(day))
    byte = F.conv(F.hex(F.substring("dias", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(1)
    return F.when(F.bitmap_bucket_number(_number(day)) == F.col("lote"), bit).otherwise(0)


def gap_totals_of_sets(sets: DataFrame, as_of: date) -> DataFrame:
    """``gap_totals`` from DAY_SETS, a code's sets merged."""
    week_start, week_end = _week(as_of)
    in_week = F.aggregate(F.sequence(week_start, week_end), F.lit(0), lambda n, d: n + has_day(d))
    found = sets.groupBy("codigo_sitio").agg(
        F.min("primera").alias("fecha_inicio"),
        F.sum(F.bitmap_count("dias")).alias("dias_con_data"),
        F.sum(in_week).alias("dias_con_data_semana"),
    )
    return _report(found, as_of)


def gap_report_of_sets(sets: DataFrame, as_of: date) -> DataFrame:
    """``gap_report`` from DAY_SETS."""
    return _worst_first(gap_totals_of_sets(sets, as_of))
