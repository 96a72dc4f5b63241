"""Registration of queries, and the inputs they derive from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
_TABLES = ("customer", "documents", "events", "lineitem", "orders", "pages", "part", "supplier")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, recipe: str) -> DataFrame:
    """Run a recipe: portable SQL that names its tables in braces."""
    used = {t: table(spark, sf_dir, t) for t in _TABLES if "{" + t + "}" in recipe}
    return spark.sql(recipe, **used)


def duck(recipe: str) -> str:
    """The same recipe for DuckDB."""
    return recipe.format(**{t: t for t in _TABLES})


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text and decimals as doubles, so that two engines compare equal."""

    def cell(f):
        if isinstance(f.dataType, DateType | TimestampType | TimestampNTZType):
            return F.col(f.name).cast("string").alias(f.name)
        if isinstance(f.dataType, DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        return F.col(f.name)

    return df.select(*[cell(f) for f in df.schema])


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
        if sql:
            ORACLE[name] = sql
        return fn

    return register


# --- derived inputs ------------------------------------------------------------------------

_DATE = {
    "y": "cast(year(o_orderdate) as string)",
    "m": "lpad(cast(month(o_orderdate) as string), 2, '0')",
    "d": "lpad(cast(day(o_orderdate) as string), 2, '0')",
    "n": "cast(day(o_orderdate) as string) || '/' || cast(month(o_orderdate) as string)",
}

# Bills as delivered: missing, malformed and repeated ids, mixed dates and amounts, all text.
BILLS = """
SELECT o_orderkey AS ord, o_orderdate AS issued,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL
       WHEN o_orderkey % 89 = 0 THEN 'nan'
       WHEN o_orderkey % 83 = 0 THEN 'X' || cast(o_orderkey as string)
       WHEN o_orderkey % 100 < 5 THEN 'R-' || cast(o_orderkey - o_orderkey % 100 as string)
       ELSE 'R-' || cast(o_orderkey as string) END AS num_recibo,
  CASE WHEN o_orderkey % 100 < 5 THEN '202401'
       WHEN o_orderkey % 41 = 0 THEN NULL
       ELSE cast(year(o_orderdate) * 100 + month(o_orderdate) as string) END AS per_consumo,
  ' ' || cast(o_custkey as string) AS cod_suministro,
  CASE WHEN o_orderkey % 7 = 0 THEN 'NaN' WHEN o_orderkey % 7 = 1 THEN ' nan'
       ELSE ' BT5B-' || o_orderpriority END AS tarifa,
  CASE WHEN o_orderkey % 4 = 0 THEN %(d)s || '/' || %(m)s || '/' || %(y)s
       WHEN o_orderkey % 4 = 1 THEN %(y)s || '-' || %(m)s || '-' || %(d)s || ' 00:00:00'
       WHEN o_orderkey % 4 = 2 THEN ' ' ELSE 'null' END AS fec_emision,
  '0.' || lpad(cast(o_orderkey % 10000000 as string), 7, '0') AS ea_pu_hp,
  cast(o_orderkey % 30 as string) || '.9 dias' AS dias_punta,
  CASE WHEN o_orderkey % 5 = 0 THEN 'S/ ' || cast(cast(o_totalprice as decimal(18,2)) as string)
       WHEN o_orderkey % 5 = 1 THEN cast(cast(floor(o_totalprice / 1000) as bigint) as string) || ',' ||
            lpad(cast(cast(floor(o_totalprice) as bigint) % 1000 as string), 3, '0')
       WHEN o_orderkey % 5 = 2 THEN '12,5'
       ELSE cast(cast(o_totalprice as decimal(18,2)) as string) END AS total_a_pagar
FROM {orders}
"""
for _k, _v in _DATE.items():
    BILLS = BILLS.replace(f"%({_k})s", _v)

# Date and time texts in every accepted spelling and some refused ones.
STAMPS = """
SELECT o_orderkey AS ord,
  CASE o_orderkey % 12
    WHEN 0 THEN %(y)s || '-' || %(m)s || '-' || %(d)s
    WHEN 1 THEN %(d)s || '/' || %(m)s || '/' || %(y)s
    WHEN 2 THEN %(d)s || '-' || %(m)s || '-' || %(y)s
    WHEN 3 THEN %(d)s || '.' || %(m)s || '.' || %(y)s
    WHEN 4 THEN %(d)s || '/' || %(m)s || '/' || substring(%(y)s, 3, 2)
    WHEN 5 THEN '31/02/' || %(y)s
    WHEN 6 THEN %(y)s || '-' || %(m)s || '-' || %(d)s || ' 00:00:00'
    WHEN 7 THEN 'null'
    WHEN 8 THEN ' ' || %(d)s || '/' || %(m)s || '/' || %(y)s
    WHEN 9 THEN %(n)s || '/' || %(y)s
    WHEN 10 THEN ''
    ELSE NULL END AS day_text,
  CASE o_orderkey % 13
    WHEN 0 THEN %(y)s || '-' || %(m)s || '-' || %(d)s || ' 13:' || %(m)s || ':09'
    WHEN 1 THEN %(y)s || '-' || %(m)s || '-' || %(d)s || 'T13:' || %(m)s || ':09.123Z'
    WHEN 2 THEN %(d)s || '/' || %(m)s || '/' || %(y)s || ' 13:' || %(m)s
    WHEN 3 THEN %(d)s || '/' || %(m)s || '/' || %(y)s || ' 13:07:' || %(m)s
    WHEN 4 THEN %(d)s || '/' || %(m)s || '/' || substring(%(y)s, 3, 2) || ' ' || cast(month(o_orderdate) as string) || ':07 PM'
    WHEN 5 THEN %(d)s || '/' || %(m)s || '/' || substring(%(y)s, 3, 2) || ' 12:30 am'
    WHEN 6 THEN %(d)s || '-' || %(m)s || '-' || %(y)s || ' 13:07:' || %(m)s
    WHEN 7 THEN %(d)s || '-' || %(m)s || '-' || %(y)s
    WHEN 8 THEN %(y)s || '-' || %(m)s || '-' || %(d)s
    WHEN 9 THEN '31/02/' || %(y)s || ' 10:00:00'
    WHEN 10 THEN ' - '
    WHEN 11 THEN ' ' || %(y)s || '-' || %(m)s || '-' || %(d)s || ' 08:15 '
    ELSE NULL END AS time_text
FROM {orders}
"""
for _k, _v in _DATE.items():
    STAMPS = STAMPS.replace(f"%({_k})s", _v)

# Numbers in every grammar.
NUMBERS = """
SELECT o_orderkey AS ord,
  CASE o_orderkey % 14
    WHEN 0 THEN cast(cast(o_totalprice as decimal(18,2)) as string)
    WHEN 1 THEN '1,234'
    WHEN 2 THEN '12,5'
    WHEN 3 THEN '-1,234,567.89'
    WHEN 4 THEN '1e5'
    WHEN 5 THEN '(' || cast(o_orderkey as string) || ')'
    WHEN 6 THEN '.5'
    WHEN 7 THEN '--5'
    WHEN 8 THEN 'S/ ' || cast(cast(o_totalprice as decimal(18,2)) as string)
    WHEN 9 THEN ' ' || cast(o_orderkey as string) || ' '
    WHEN 10 THEN '-' || cast(o_custkey as string) || '.345'
    WHEN 11 THEN ''
    WHEN 12 THEN '+' || cast(o_custkey as string) || ',255'
    ELSE 'nan' END AS number_text
FROM {orders}
"""

# Hourly meter readings: site = user, object = event type.
READINGS = """
SELECT cast(user_id as string) AS site_name, 'net ' || event_type AS subnet, event_type AS manage_object,
  date_trunc('hour', ts) AS start_time,
  cast(value as decimal(18,4)) AS energy_consumption_per_hour_kwh,
  cast(1 as decimal(18,4)) AS supply_duration_per_hour_h,
  cast(value * 2 as decimal(18,4)) AS total_energy_consumption_kwh
FROM {events}
"""

# The same as an all-text landing table, with null tokens and rows that lack their key.
READINGS_TEXT = """
SELECT CASE WHEN event_id % 71 = 0 THEN 'NaN' ELSE ' ' || cast(user_id as string) END AS site_name,
  CASE WHEN event_id % 5 = 0 THEN '' ELSE 'net ' || event_type END AS subnet,
  event_type AS manage_object,
  CASE WHEN event_id % 67 = 0 THEN ' n/a' ELSE cast(date_trunc('hour', ts) as string) END AS start_time,
  CASE WHEN event_id % 61 = 0 THEN '-' ELSE cast(cast(value as decimal(18,4)) as string) END AS energy_consumption_per_hour_kwh,
  '1' AS supply_duration_per_hour_h,
  cast(cast(value * 2 as decimal(18,4)) as string) || ' kWh' AS total_energy_consumption_kwh,
  cast(ts as date) AS delivered
FROM {events}
"""

# One series row per site and day, and per site, object and day.
DAILY = """
SELECT cast(user_id as string) AS site, cast(ts as date) AS day,
  cast(sum(cast(value as decimal(18,4))) as decimal(18,4)) AS value
FROM {events} GROUP BY 1, 2
"""
DAILY_OBJECTS = """
SELECT cast(user_id as string) AS site, event_type AS object, cast(ts as date) AS day,
  cast(sum(cast(value as decimal(18,4))) as decimal(18,4)) AS value
FROM {events} GROUP BY 1, 2, 3
"""

# A run log: jobs run once per order.
RUNS = """
SELECT o_orderkey AS id, 'load_' || cast(o_custkey % 7 as string) AS sp,
  cast(o_orderdate as timestamp) AS inicio,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL
       ELSE o_orderdate + (o_orderkey % 3600) * interval '1' second END AS fin,
  CASE WHEN o_orderkey % 10 = 0 THEN 'ERROR' ELSE 'DONE' END AS estado
FROM {orders}
"""
