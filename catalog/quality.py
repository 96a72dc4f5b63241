"""Quarantine, duplicates, reject batches."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from catalog import sqltext as q
from catalog.registry import BILLS, derive, duck, query, table
from lakeops.operators import dedup, quarantine
from lakeops.plans import exports, feeds, loads
from lakeops.session import scratch_path
from lakeops.sources.files import read_delimited
from lakeops.sources.tables import read_landing

_RULES, _KEY = ("invalid", "missing"), ("num_recibo", "per_consumo")
_MARKED = q.marked(f"({duck(BILLS)})", _RULES, _KEY)


def _marked(spark, sf):
    return loads.mark(derive(spark, sf, BILLS), feeds.BILLS)


@query("quarantine_reasons", f"SELECT ord, num_recibo, per_consumo, reason FROM ({_MARKED}) WHERE reason IS NOT NULL")
def quarantine_reasons(spark, sf):
    bad = _marked(spark, sf).where(F.col("_reason").isNotNull())
    return bad.select("ord", "num_recibo", "per_consumo", F.col("_reason").alias("reason"))


@query(
    "quarantine_counts",
    f"SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n_rows FROM ({_MARKED}) GROUP BY 1",
)
def quarantine_counts(spark, sf):
    return quarantine.reason_counts(_marked(spark, sf))


@query(
    "quarantine_message",
    "SELECT 'accepted: ' || CAST(count(*) FILTER (WHERE reason IS NULL) AS VARCHAR) || ' | invalid: ' || "
    "CAST(count(*) FILTER (WHERE reason = 'invalid') AS VARCHAR) || ', missing: ' || "
    "CAST(count(*) FILTER (WHERE reason = 'missing') AS VARCHAR) || ', duplicate: ' || "
    f"CAST(count(*) FILTER (WHERE reason = 'duplicate') AS VARCHAR) AS message FROM ({_MARKED})",
)
def quarantine_message(spark, sf):
    n = lambda c: F.count_if(c)
    reason = F.col("_reason")
    return _marked(spark, sf).agg(
        F.format_string(
            "accepted: %d | invalid: %d, missing: %d, duplicate: %d",
            n(reason.isNull()),
            n(reason == "invalid"),
            n(reason == "missing"),
            n(reason == "duplicate"),
        ).alias("message")
    )


@query(
    "accepted_bills",
    "SELECT ord, num_recibo, per_consumo, "
    f"{q.iso(q.date_slash_or_iso('fec_emision'))} AS fec_emision, "
    f"CAST({q.try_numeric('total_a_pagar', 'DECIMAL(18,2)')} AS DOUBLE) AS total_a_pagar "
    f"FROM ({_MARKED}) WHERE reason IS NULL",
)
def accepted_bills(spark, sf):
    good = quarantine.accepted(_marked(spark, sf))
    typed = feeds.BILLS.clean(good, "ord")
    return typed.select("ord", "num_recibo", "per_consumo", "fec_emision", "total_a_pagar")


@query(
    "dup_keys_rejected",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, reason FROM ("
    + q.marked("lineitem", (), ("l_orderkey", "l_linenumber"))
    + ") WHERE reason IS NOT NULL",
)
def dup_keys_rejected(spark, sf):
    key = {"l_orderkey": F.col("l_orderkey"), "l_linenumber": F.col("l_linenumber")}
    rows = read_landing(spark, f"{sf}/lineitem.parquet")
    marked = quarantine.mark_rejects(rows, {}, key, spread_by=["ord"])
    return marked.where("_reason is not null").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.col("_reason").alias("reason")
    )


@query(
    "dup_key_groups",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def dup_key_groups(spark, sf):
    return quarantine.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_MIXED_CASE = """
SELECT c_custkey AS ord, CASE WHEN c_custkey % 53 = 0 THEN 'NaN' WHEN c_custkey % 2 = 0 THEN ' ' || upper(c_mktsegment) ||
  cast(c_nationkey as string) ELSE lower(c_mktsegment) || cast(c_nationkey as string) || ' ' END ||
  CASE WHEN c_custkey % 53 = 0 OR c_custkey % 3 = 0 THEN '' ELSE cast(c_custkey as string) END AS recibo
FROM {customer}
"""


@query(
    "dup_normalised_key",
    f"WITH t AS (SELECT *, CASE WHEN NOT {q.missing('recibo')} THEN lower(left(trim(recibo), 255)) END AS k "
    f"FROM ({duck(_MIXED_CASE)})) SELECT ord, recibo, coalesce(CASE WHEN {q.missing('recibo')} THEN 'missing' END, "
    "CASE WHEN k IS NOT NULL AND count(*) OVER (PARTITION BY k) > 1 THEN 'duplicate' END) AS reason FROM t",
)
def dup_normalised_key(spark, sf):
    marked = loads.mark(derive(spark, sf, _MIXED_CASE), feeds.PAYMENTS_INSERT)
    return marked.select("ord", "recibo", F.col("_reason").alias("reason"))


_STORED_UNTIL = "1998-07-01"


@query(
    "reject_anti_append",
    f"WITH m AS ({_MARKED}), bad AS (SELECT * FROM m WHERE reason IS NOT NULL), "
    f"stored AS (SELECT num_recibo, per_consumo FROM bad WHERE issued < TIMESTAMP '{_STORED_UNTIL}') "
    "SELECT b.ord, b.num_recibo, b.per_consumo, b.reason FROM bad b WHERE NOT EXISTS (SELECT 1 FROM stored s "
    "WHERE s.num_recibo IS NOT DISTINCT FROM b.num_recibo AND s.per_consumo IS NOT DISTINCT FROM b.per_consumo)",
)
def reject_anti_append(spark, sf):
    """A second run on the same day, when the first had rejected the older bills."""
    marked = _marked(spark, sf)
    first_run = F.lit("2024-02-01 08:00:00").cast("timestamp_ntz")
    second_run = F.lit("2024-02-01 17:30:00").cast("timestamp_ntz")
    stored = quarantine.rejected(marked.where(F.col("issued") < _STORED_UNTIL), "raw.bills", first_run)
    bad = quarantine.rejected(marked, "raw.bills", second_run)
    fresh = quarantine.new_rejects(bad, stored, _KEY, spread_by=["ord"])
    return fresh.select("ord", "num_recibo", "per_consumo", F.col("_reason").alias("reason"))


_REJECTS = """
SELECT o_orderkey AS ord, CASE WHEN o_orderkey % 2 = 0 THEN ' RAW.Bills' ELSE 'raw.payments' END AS _source,
  cast('2024-01-31 08:00:00' as timestamp) + (o_custkey % 3) * interval '1' hour
    + (o_orderkey % 4) * interval '1' day AS _batch_ts
FROM {orders}
"""


@query(
    "latest_reject_batch",
    f"WITH t AS (SELECT * FROM ({duck(_REJECTS)}) WHERE lower(trim(_source)) = 'raw.bills' AND CAST(_batch_ts AS DATE) = DATE '2024-02-02') "
    "SELECT ord, CAST(_batch_ts AS VARCHAR) AS batch_ts FROM t WHERE _batch_ts = (SELECT max(_batch_ts) FROM t)",
)
def latest_reject_batch(spark, sf):
    stored = derive(spark, sf, _REJECTS).withColumn("_batch_ts", F.col("_batch_ts").cast("timestamp_ntz"))
    found = quarantine.latest_rejects(stored, "raw.bills ", F.lit(date(2024, 2, 2)))
    return found.select("ord", F.col("_batch_ts").alias("batch_ts"))


@query(
    "reject_export",
    f"WITH t AS (SELECT * FROM ({duck(_REJECTS)}) WHERE lower(trim(_source)) = 'raw.payments' AND CAST(_batch_ts AS DATE) = DATE '2024-02-01') "
    "SELECT CAST(ord AS VARCHAR) AS ord FROM t WHERE _batch_ts = (SELECT max(_batch_ts) FROM t)",
)
def reject_export(spark, sf):
    """The day's latest rejects of one source, exported and read back."""
    stored = derive(spark, sf, _REJECTS).withColumn("_batch_ts", F.col("_batch_ts").cast("timestamp_ntz"))
    path = exports.export_rejects(stored, "raw.payments", date(2024, 2, 1), scratch_path(spark, "export"))
    return read_delimited(spark, path).select("ord")


_ANSWERS = "SELECT event_id, event_type AS form, user_id, date_trunc('hour', ts) AS fechacarga FROM {events}"


@query(
    "keep_last_batch",
    f"WITH t AS ({duck(_ANSWERS)}) SELECT event_id, form, CAST(fechacarga AS VARCHAR) AS fechacarga FROM t "
    "QUALIFY fechacarga = max(fechacarga) OVER (PARTITION BY form, CAST(fechacarga AS DATE))",
)
def keep_last_batch(spark, sf):
    kept = dedup.keep_last_batch(derive(spark, sf, _ANSWERS), ["form"], "fechacarga", spread_by=["event_id"])
    return kept.select("event_id", "form", F.col("fechacarga").cast("timestamp_ntz").alias("fechacarga"))


@query(
    "keep_last_batch_of_day",
    f"WITH t AS ({duck(_ANSWERS)}), k AS (SELECT form, max(fechacarga) AS m FROM t WHERE CAST(fechacarga AS DATE) = DATE '2024-01-15' GROUP BY 1) "
    "SELECT event_id, t.form, CAST(fechacarga AS VARCHAR) AS fechacarga FROM t LEFT JOIN k USING (form) "
    "WHERE CAST(fechacarga AS DATE) <> DATE '2024-01-15' OR fechacarga = m",
)
def keep_last_batch_of_day(spark, sf):
    rows, day = derive(spark, sf, _ANSWERS), F.lit(date(2024, 1, 15))
    kept = dedup.keep_last_batch(rows, ["form"], "fechacarga", spread_by=["event_id"], day=day)
    return kept.select("event_id", "form", F.col("fechacarga").cast("timestamp_ntz").alias("fechacarga"))


@query(
    "batch_summary",
    f"WITH t AS (SELECT * FROM ({duck(_ANSWERS)}) WHERE CAST(fechacarga AS DATE) = DATE '2024-01-15'), "
    "k AS (SELECT form, max(fechacarga) AS m FROM t GROUP BY 1) "
    "SELECT form, CAST(m AS VARCHAR) AS kept_stamp, count(*) FILTER (WHERE fechacarga <> m) AS rows_removed "
    "FROM t JOIN k USING (form) GROUP BY 1, 2",
)
def batch_summary(spark, sf):
    found = dedup.batch_summary(derive(spark, sf, _ANSWERS), ["form"], "fechacarga", F.lit(date(2024, 1, 15)))
    return found.withColumn("kept_stamp", F.col("kept_stamp").cast("timestamp_ntz"))


@query(
    "missing_key_count",
    f"SELECT count(*) FILTER (WHERE num_recibo IS NULL OR trim(num_recibo) = '') AS n_missing FROM ({duck(BILLS)})",
)
def missing_key_count(spark, sf):
    return quarantine.missing_key_count(derive(spark, sf, BILLS), "num_recibo")
