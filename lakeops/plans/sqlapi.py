"""The same functions for SQL users, as temporary SQL functions that Spark inlines into the plan."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lakeops.operators import quarantine

_TRY_NUMERIC = r"""
CREATE OR REPLACE TEMPORARY FUNCTION try_numeric(x STRING) RETURNS DECIMAL(38,10)
RETURN try_cast(replace(nullif(regexp_extract(regexp_replace(x, r'[^0-9,.\-]+', ''),
  r'\A(?:-?(\d+|\d{1,3}(,\d{3})+)(\.\d+)?)\z', 0), ''), ',', '') AS DECIMAL(38,10))
"""


def _columns(spark: SparkSession, view: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(view).schema)


def register(spark: SparkSession, rejects_view: str | None = None, log_view: str | None = None) -> None:
    """Create ``try_numeric(text)``; and, over the named views, the table functions
    ``latest_rejects(source, as_of)`` and ``latest_run(job)``."""
    spark.sql(_TRY_NUMERIC)
    if rejects_view:
        columns = _columns(spark, rejects_view)
        ts, source = quarantine.BATCH_TS, quarantine.SOURCE
        newest = (
            f"SELECT lower(trim({source})) AS k, CAST({ts} AS DATE) AS d, max({ts}) AS newest "
            f"FROM {rejects_view} GROUP BY 1, 2"
        )
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION latest_rejects(src STRING, as_of DATE) RETURNS TABLE ({columns}) "
            f"RETURN SELECT r.* FROM {rejects_view} r JOIN ({newest}) b ON r.{ts} = b.newest "
            f"AND lower(trim(r.{source})) = b.k WHERE b.k = lower(trim(src)) AND b.d = as_of"
        )
    if log_view:
        columns = _columns(spark, log_view)
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION latest_run(job STRING) RETURNS TABLE ({columns}) "
            f"RETURN SELECT * FROM {log_view} WHERE sp = job "
            "ORDER BY coalesce(fin, inicio, TIMESTAMP_NTZ '1970-01-01 00:00:00') DESC, id DESC LIMIT 1"
        )
