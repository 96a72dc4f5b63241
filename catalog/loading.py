"""Keyed deduplication, load strategies, and whole feed jobs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from catalog import sqltext as q
from catalog.registry import BILLS, READINGS, READINGS_TEXT, derive, duck, query, table
from lakeops.functions.dates import NTZ
from lakeops.operators import dedup, load, rollup
from lakeops.plans import checklist, exports, feeds, loads, meter
from lakeops.session import scratch_path
from lakeops.sources.tables import Table, load_frame
from lakeops.streaming import meter as stream

_STAMP = datetime(2024, 2, 1, 8, 0, 0)

# --- one row per key ------------------------------------------------------------------------


@query(
    "latest_per_key",
    "SELECT o_custkey, o_orderkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_totalprice FROM orders "
    "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) = 1",
)
def latest_per_key(spark, sf):
    rows = table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast(NTZ))
    latest = dedup.latest_per_key(rows, ["o_custkey"], "o_orderdate", "o_orderkey")
    return latest.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


@query(
    "first_arrival",
    f"SELECT ord, num_recibo, per_consumo FROM ({duck(BILLS)}) WHERE num_recibo IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY num_recibo ORDER BY ord) = 1",
)
def first_arrival(spark, sf):
    return dedup.first_arrival(derive(spark, sf, BILLS), ["num_recibo"], "ord").select(
        "ord", "num_recibo", "per_consumo"
    )


# --- strategies ------------------------------------------------------------------------------

# The store holds older orders; the batch brings newer ones, overlaps, and raises some prices.
_STORE = "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_orderdate < '1999-01-01'"
_BATCH = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM {orders} WHERE o_orderdate >= '1997-01-01'
"""
_KEY = ["o_orderkey"]
_PAIR = f"WITH t AS ({duck(_STORE)}), s AS ({duck(_BATCH)}) "
_UPSERTED = (
    "SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(s.o_custkey, t.o_custkey) AS o_custkey, "
    "coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice, "
    "CASE WHEN s.o_orderkey IS NULL THEN 'keep' WHEN t.o_orderkey IS NULL THEN 'insert' {same}ELSE 'update' END AS action "
    "FROM t FULL JOIN s USING (o_orderkey)"
)
_ALL = _UPSERTED.replace("{same}", "")
_CHANGED = _UPSERTED.replace(
    "{same}", "WHEN (s.o_custkey, s.o_totalprice) IS NOT DISTINCT FROM (t.o_custkey, t.o_totalprice) THEN 'same' "
)
_COUNTS = (
    "SELECT count(*) FILTER (WHERE action = 'insert') AS inserted, count(*) FILTER (WHERE action = 'update') AS updated, "
    "count(*) FILTER (WHERE action = 'same') AS unchanged, count(*) FILTER (WHERE action = 'keep') AS kept FROM ({})"
)


def _pair(spark, sf):
    return derive(spark, sf, _STORE), derive(spark, sf, _BATCH)


@query("insert_new_only", _PAIR + "SELECT s.* FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)")
def insert_new_only(spark, sf):
    store, batch = _pair(spark, sf)
    return load.insert_new(store, batch, _KEY)


@query("upsert_all", _PAIR + _ALL)
def upsert_all(spark, sf):
    return load.upsert(*_pair(spark, sf), _KEY).withColumnRenamed("_action", "action")


@query("upsert_changed", _PAIR + _CHANGED)
def upsert_changed(spark, sf):
    return load.upsert_changed(*_pair(spark, sf), _KEY).withColumnRenamed("_action", "action")


@query("upsert_all_counts", _PAIR + _COUNTS.format(_ALL))
def upsert_all_counts(spark, sf):
    return load.action_counts(load.upsert(*_pair(spark, sf), _KEY))


@query("upsert_changed_counts", _PAIR + _COUNTS.format(_CHANGED))
def upsert_changed_counts(spark, sf):
    return load.action_counts(load.upsert_changed(*_pair(spark, sf), _KEY))


@query(
    "full_refresh_counts",
    "SELECT (SELECT count(*) FROM orders WHERE o_orderdate < '1999-01-01') AS deleted, "
    "(SELECT count(*) FROM orders WHERE o_orderdate >= '1997-01-01') AS inserted, "
    "(SELECT count(*) FROM orders WHERE o_orderdate >= '1997-01-01') AS stored",
)
def full_refresh_counts(spark, sf):
    """A refresh replaces a written table whole; its counts come before and after."""
    old, new = _pair(spark, sf)
    store = Table(spark, scratch_path(spark, "refresh"), old.schema)
    load_frame(old, store, "replace")
    before = store.read().agg(F.count(F.lit(1)).alias("deleted"))
    gone = before.first()["deleted"]
    load_frame(new, store, "replace")
    counted = store.read().agg(F.count(F.lit(1)).alias("stored"))
    came = store.read().join(new, ["o_orderkey"], "left_semi").count()
    return counted.select(F.lit(gone).alias("deleted"), F.lit(came).alias("inserted"), "stored")


@query(
    "table_modes",
    "SELECT o_orderkey, o_custkey, o_totalprice, count(*) AS copies FROM "
    f"({duck(_STORE)} UNION ALL {duck(_BATCH)}) GROUP BY ALL",
)
def table_modes(spark, sf):
    """Replace, then append."""
    old, new = _pair(spark, sf)
    store = Table(spark, scratch_path(spark, "modes"), old.schema)
    load_frame(new, store, "append")
    load_frame(old, store, "replace")
    load_frame(new, store, "append")
    return store.read().groupBy(*old.columns).agg(F.count(F.lit(1)).alias("copies"))


# --- meter stores -----------------------------------------------------------------------------

_HOURS = (
    "SELECT site_name, manage_object, start_time, max(subnet) AS subnet, max(energy_consumption_per_hour_kwh) AS e, "
    "max(supply_duration_per_hour_h) AS h, max(total_energy_consumption_kwh) AS t FROM {src} GROUP BY 1, 2, 3"
)


def _days(src: str) -> str:
    return (
        "SELECT site_name, manage_object, CAST(start_time AS DATE) AS fecha, CAST(sum(e) AS DECIMAL(18,4)) AS e "
        f"FROM ({_HOURS.format(src=src)}) GROUP BY 1, 2, 3"
    )


@query(
    "rollup_upsert_counts",
    f"WITH r AS ({duck(READINGS)}), t AS ({_days("(SELECT * FROM r WHERE start_time < '2024-01-20')")}), "
    f"s AS ({_days("(SELECT * FROM r WHERE start_time >= '2024-01-15')")}) "
    "SELECT count(*) FILTER (WHERE t.fecha IS NULL) AS inserted, "
    "count(*) FILTER (WHERE t.fecha IS NOT NULL AND s.fecha IS NOT NULL) AS updated, "
    "CAST(0 AS BIGINT) AS unchanged, count(*) FILTER (WHERE s.fecha IS NULL) AS kept "
    "FROM t FULL JOIN s USING (site_name, manage_object, fecha)",
)
def rollup_upsert_counts(spark, sf):
    readings = derive(spark, sf, READINGS)
    days = lambda rows: rollup.daily_rollup(rollup.hour_dedup(rows))
    stored = days(readings.where(F.col("start_time") < "2024-01-20"))
    batch = days(readings.where(F.col("start_time") >= "2024-01-15"))
    return load.action_counts(load.upsert(stored, batch, meter.DAY_KEY))


def _typed(src: str) -> str:
    ok = "('nan','null','-','n/a')"
    amount = lambda c: (
        f"CASE WHEN {c} IS NULL OR trim({c}) = '' OR lower(trim({c})) IN {ok} THEN NULL "
        f"ELSE {q.try_numeric(f'trim({c})', 'DECIMAL(18,4)')} END AS {c}"
    )
    columns = ", ".join(amount(c) for c in rollup.HOURLY)
    texts = ", ".join(f"nullif(nullif(trim({c}), 'NaN'), '') AS {c}" for c in ("site_name", "subnet", "manage_object"))
    return (
        f"SELECT * FROM (SELECT {texts}, TRY_CAST(trim(start_time) AS TIMESTAMP) AS start_time, {columns} FROM {src}) "
        "WHERE site_name IS NOT NULL AND manage_object IS NOT NULL AND start_time IS NOT NULL"
    )


_FIRST_BATCH = f"({_typed(f"(SELECT * FROM ({duck(READINGS_TEXT)}) WHERE delivered < DATE '2024-01-20')")})"
_SECOND_BATCH = f"({_typed(f"(SELECT * FROM ({duck(READINGS_TEXT)}) WHERE delivered >= DATE '2024-01-15')")})"
_STORED_DAYS = (
    f"WITH a AS ({_days(_FIRST_BATCH)}), b AS ({_days(_SECOND_BATCH)}), "
    "d AS (SELECT * FROM b UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.site_name = a.site_name "
    "AND b.manage_object = a.manage_object AND b.fecha = a.fecha)) "
)


def _meter_stores(spark, sf, month_source):
    text = derive(spark, sf, READINGS_TEXT)
    days = meter.day_table(spark, scratch_path(spark, "days"))
    months = meter.month_table(spark, scratch_path(spark, "months"))
    end = datetime(2024, 1, 31).date()
    for batch in (text.where(F.col("delivered") < "2024-01-20"), text.where(F.col("delivered") >= "2024-01-15")):
        meter.load_readings(spark, batch, days, months, end, month_source)
    return days, months


@query(
    "meter_load_days",
    _STORED_DAYS + "SELECT site_name, manage_object, CAST(fecha AS VARCHAR) AS fecha, CAST(e AS DOUBLE) AS energy FROM d",
)
def meter_load_days(spark, sf):
    days, _ = _meter_stores(spark, sf, "daily")
    return days.read().select(
        "site_name", "manage_object", "fecha", F.col("energy_consumption_per_day_kwh").alias("energy")
    )


_ALL_DAYS = _days(f"({_typed(f'({duck(READINGS_TEXT)})')})")


@query(
    "meter_stream_days",
    f"SELECT site_name, manage_object, CAST(fecha AS VARCHAR) AS fecha, CAST(e AS DOUBLE) AS energy FROM ({_ALL_DAYS})",
)
def meter_stream_days(spark, sf):
    """Readings land in files out of order, some rows twice; the days are those of all rows at once."""
    text, folder = derive(spark, sf, READINGS_TEXT), scratch_path(spark, "landing")
    day = F.dayofmonth("delivered")
    stores = stream.hour_table(spark, scratch_path(spark, "hours")), meter.day_table(spark, scratch_path(spark, "days")), meter.month_table(
        spark, scratch_path(spark, "months")
    )
    end, checkpoint = datetime(2024, 1, 31).date(), scratch_path(spark, "stream")
    for part in (day % 3 != 1, day % 3 != 2):  # the second has late days, and a third of the first again
        text.where(part).write.mode("append").parquet(folder)
        landing = spark.readStream.schema(text.schema).parquet(folder)  # what has landed since is a micro-batch
        stream.stream_readings(landing, *stores, checkpoint, lambda: end, "60 days").awaitTermination()
    return stores[1].read().select(
        "site_name", "manage_object", "fecha", F.col("energy_consumption_per_day_kwh").alias("energy")
    )


@query(
    "meter_load_months",
    _STORED_DAYS + "SELECT site_name, manage_object, CAST(CAST(date_trunc('month', fecha) AS DATE) AS VARCHAR) AS mes, "
    "CAST(CAST(sum(e) AS DECIMAL(18,4)) AS DOUBLE) AS energy FROM d GROUP BY 1, 2, 3",
)
def meter_load_months(spark, sf):
    """Months summed over stored days: the second batch holds half a month and does not shrink it."""
    _, months = _meter_stores(spark, sf, "daily")
    return months.read().select(
        "site_name", "manage_object", "mes", F.col("energy_consumption_per_month_kwh").alias("energy")
    )


@query(
    "meter_load_months_batch",
    f"WITH a AS ({_days(_FIRST_BATCH)}), b AS ({_days(_SECOND_BATCH)}), "
    "am AS (SELECT site_name, manage_object, date_trunc('month', fecha) AS mes, sum(e) AS e FROM a GROUP BY 1, 2, 3), "
    "bm AS (SELECT site_name, manage_object, date_trunc('month', fecha) AS mes, sum(e) AS e FROM b GROUP BY 1, 2, 3) "
    "SELECT site_name, manage_object, CAST(CAST(mes AS DATE) AS VARCHAR) AS mes, "
    "CAST(CAST(CASE WHEN bm.mes IS NULL THEN am.e ELSE bm.e END AS DECIMAL(18,4)) AS DOUBLE) AS energy "
    "FROM am FULL JOIN bm USING (site_name, manage_object, mes)",
)
def meter_load_months_batch(spark, sf):
    """Months summed over the batch alone, which overwrites the month."""
    _, months = _meter_stores(spark, sf, "batch")
    return months.read().select(
        "site_name", "manage_object", "mes", F.col("energy_consumption_per_month_kwh").alias("energy")
    )


# --- feeds --------------------------------------------------------------------------------------

_RULES, _DUP = ("invalid", "missing"), ("num_recibo", "per_consumo")
_OLD = f"(SELECT * FROM ({duck(BILLS)}) WHERE issued < TIMESTAMP '1998-01-01')"
_NEW = f"(SELECT * FROM ({duck(BILLS)}) WHERE issued >= TIMESTAMP '1996-01-01')"


def _bill(date_sql, rules, source):
    return (
        f"SELECT {q.text_token('num_recibo', 250)} AS num_recibo, {q.text_nan('per_consumo', 50)} AS per_consumo, "
        f"{q.text_token('cod_suministro', 250)} AS cod_suministro, {q.text_nan('tarifa', 10)} AS tarifa, "
        f"{q.iso(date_sql('fec_emision'))} AS fec_emision, "
        f"CAST({q.try_numeric('ea_pu_hp', 'DECIMAL(18,6)')} AS DOUBLE) AS ea_pu_hp, "
        f"TRY_CAST(trunc({q.try_numeric('dias_punta')}) AS INTEGER) AS dias_punta, "
        f"CAST({q.try_numeric('total_a_pagar', 'DECIMAL(18,2)')} AS DOUBLE) AS total_a_pagar "
        f"FROM (SELECT * FROM ({q.marked(source, rules, _DUP)}) WHERE reason IS NULL AND NOT {q.missing('num_recibo')} "
        "QUALIFY row_number() OVER (PARTITION BY trim(num_recibo) ORDER BY ord) = 1)"
    )


_BILL_COLUMNS = (
    "num_recibo", "per_consumo", "cod_suministro", "tarifa", "fec_emision", "ea_pu_hp", "dias_punta", "total_a_pagar",
)


def _run_bills(spark, sf, feed):
    """Two overlapping batches through the whole job."""
    landing = derive(spark, sf, BILLS)
    store = Table(spark, scratch_path(spark, "bills"), feed.schema())
    rejects = Table(spark, scratch_path(spark, "rejects"), loads.reject_schema(landing.schema))
    for batch in (landing.where("issued < '1998-01-01'"), landing.where("issued >= '1996-01-01'")):
        loads.run_feed(spark, batch, feed, store, rejects, _STAMP)
    return store, rejects


@query(
    "bills_load",
    f"WITH a AS ({_bill(q.date_slash_or_iso, _RULES, _OLD)}), b AS ({_bill(q.date_slash_or_iso, _RULES, _NEW)}) "
    "SELECT * FROM a UNION ALL SELECT * FROM b WHERE num_recibo NOT IN (SELECT num_recibo FROM a)",
)
def bills_load(spark, sf):
    store, _ = _run_bills(spark, sf, feeds.BILLS)
    return store.read().select(*_BILL_COLUMNS)


@query(
    "bills_load_rejects",
    f"WITH a AS (SELECT * FROM ({q.marked(_OLD, _RULES, _DUP)}) WHERE reason IS NOT NULL), "
    f"b AS (SELECT * FROM ({q.marked(_NEW, _RULES, _DUP)}) WHERE reason IS NOT NULL), "
    "r AS (SELECT num_recibo, per_consumo, reason FROM a UNION ALL SELECT num_recibo, per_consumo, reason FROM b "
    "WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.num_recibo IS NOT DISTINCT FROM b.num_recibo "
    "AND a.per_consumo IS NOT DISTINCT FROM b.per_consumo)) "
    "SELECT num_recibo, per_consumo, reason, count(*) AS copies FROM r GROUP BY ALL",
)
def bills_load_rejects(spark, sf):
    _, rejects = _run_bills(spark, sf, feeds.BILLS)
    return rejects.read().groupBy("num_recibo", "per_consumo", F.col("_reason").alias("reason")).agg(
        F.count(F.lit(1)).alias("copies")
    )


@query(
    "web_bills_load",
    f"WITH a AS ({_bill(q.date_any_separator, (), _OLD)}), b AS ({_bill(q.date_any_separator, (), _NEW)}) "
    "SELECT * FROM b UNION ALL SELECT * FROM a WHERE num_recibo NOT IN (SELECT num_recibo FROM b)",
)
def web_bills_load(spark, sf):
    store, _ = _run_bills(spark, sf, feeds.WEB_BILLS)
    return store.read().select(*_BILL_COLUMNS)


@query(
    "web_bills_insert",
    f"WITH a AS ({_bill(q.date_any_separator, (), _OLD)}), b AS ({_bill(q.date_any_separator, (), _NEW)}) "
    "SELECT * FROM a UNION ALL SELECT * FROM b WHERE num_recibo NOT IN (SELECT num_recibo FROM a)",
)
def web_bills_insert(spark, sf):
    store, _ = _run_bills(spark, sf, feeds.WEB_BILLS_INSERT)
    return store.read().select(*_BILL_COLUMNS)


_PAYMENTS = """
SELECT o_orderkey AS ord, o_orderdate AS issued,
  CASE WHEN o_orderkey % 43 = 0 THEN ' nan' WHEN o_orderkey % 100 < 3 THEN 'P' || cast(o_orderkey - o_orderkey % 100 as string)
       WHEN o_orderkey % 50 < 2 THEN CASE WHEN o_orderkey % 50 = 0 THEN 'q' ELSE ' Q' END || cast(o_orderkey - o_orderkey % 50 as string)
       ELSE ' P' || cast(o_orderkey as string) END AS recibo,
  cast(o_custkey as string) || '.0' AS ruc_concesionario, 'C ' || o_orderpriority AS concesionario,
  cast(o_totalprice as string) AS total_text, cast(cast(o_totalprice as decimal(18,2)) as string) AS total_pagado,
  cast(day(o_orderdate) as string) || '/' || cast(month(o_orderdate) as string) || '/' || cast(year(o_orderdate) as string) AS fecha_emision,
  'lote-' || cast(o_orderkey % 5 as string) || '.xlsx' AS archivo,
  CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE cast(o_orderkey % 1000 as string) || '.18' END AS igv,
  CASE WHEN o_orderkey % 6 = 0 THEN 'NaN' ELSE ' mes ' || cast(month(o_orderdate) as string) END AS mes_facturacion,
  cast(o_orderkey as string) || '.7' AS cuenta,
  CASE WHEN o_orderkey % 5 = 0 THEN '  ' WHEN o_orderkey % 5 = 1 THEN 'NaN' ELSE ' nota ' END AS texto,
  CASE WHEN o_orderkey % 4 = 0 THEN 'null' ELSE cast(cast(o_orderdate as date) as string) END AS fe_valor
FROM {orders}
"""
_OLDER = (
    ", CAST(" + q.try_numeric("igv", "DECIMAL(18,2)") + " AS DOUBLE) AS igv, " + q.text_nan("mes_facturacion", 255) + " AS mes_facturacion, "
    "TRY_CAST(trunc(" + q.try_numeric("cuenta") + ") AS BIGINT) AS cuenta, nullif(trim(texto), '') AS texto, "
    + q.iso(q.date_slash_or_iso("fe_valor")) + " AS fe_valor"
)


def _payment(source, key="recibo", last=", archivo"):
    keyed = f"(SELECT *, CASE WHEN NOT {q.missing('recibo')} THEN {key} END AS k FROM {source})"
    return (
        "SELECT trim(recibo) AS recibo, TRY_CAST(trunc(" + q.try_numeric("ruc_concesionario") + ") AS BIGINT) AS ruc_concesionario, "
        f"concesionario, CAST(CAST(total_pagado AS DECIMAL(18,2)) AS DOUBLE) AS total_pagado, "
        f"{q.iso(q.date_slash_or_iso('fecha_emision'))} AS fecha_emision{last} "
        f"FROM (SELECT * FROM ({q.marked(keyed, ('missing',), ('k',))}) WHERE reason IS NULL "
        "QUALIFY row_number() OVER (PARTITION BY trim(recibo) ORDER BY ord) = 1)"
    )


_PAID_OLD = f"(SELECT * FROM ({duck(_PAYMENTS)}) WHERE issued < TIMESTAMP '1998-01-01')"
_PAID_NEW = f"(SELECT * FROM ({duck(_PAYMENTS)}) WHERE issued >= TIMESTAMP '1996-01-01')"


@query(
    "payments_load",
    f"WITH a AS ({_payment(_PAID_OLD)}), b AS ({_payment(_PAID_NEW)}) "
    "SELECT * FROM b UNION ALL SELECT * FROM a WHERE recibo NOT IN (SELECT recibo FROM b)",
)
def payments_load(spark, sf):
    return _run_payments(spark, sf, feeds.PAYMENTS, "archivo")


_PAID = ("recibo", "ruc_concesionario", "concesionario", "total_pagado", "fecha_emision")


def _run_payments(spark, sf, feed, *more):
    landing = derive(spark, sf, _PAYMENTS)
    store = Table(spark, scratch_path(spark, "payments"), feed.schema())
    rejects = Table(spark, scratch_path(spark, "payment-rejects"), loads.reject_schema(landing.schema))
    for batch in (landing.where("issued < '1998-01-01'"), landing.where("issued >= '1996-01-01'")):
        loads.run_feed(spark, batch, feed, store, rejects, _STAMP)
    return store.read().select(*_PAID, *more)


def _older_payments(key):
    old, new = (_payment(part, key, _OLDER) for part in (_PAID_OLD, _PAID_NEW))
    return f"WITH a AS ({old}), b AS ({new}) SELECT * FROM a UNION ALL SELECT * FROM b WHERE recibo NOT IN (SELECT recibo FROM a)"


_OLDER_COLUMNS = ("igv", "mes_facturacion", "cuenta", "texto", "fe_valor")


@query("payments_insert", _older_payments("lower(left(trim(recibo), 255))"))
def payments_insert(spark, sf):
    """The older feed: duplicates by normalised key, and stored payments never change."""
    return _run_payments(spark, sf, feeds.PAYMENTS_INSERT, *_OLDER_COLUMNS)


@query("payments_insert_exact", _older_payments("recibo"))
def payments_insert_exact(spark, sf):
    """The other older feed: duplicates by the key as it came."""
    return _run_payments(spark, sf, feeds.PAYMENTS_INSERT_EXACT, *_OLDER_COLUMNS)


_FREE = """
SELECT o_orderkey AS ord, o_orderdate AS issued, ' ' || cast(o_orderkey - o_orderkey % 2 as string) AS num_recibo,
  CASE WHEN o_orderkey % 37 = 0 THEN '202401' ELSE cast(202400 + o_orderkey % 2 as string) END AS per_consumo,
  CASE o_orderkey % 3 WHEN 0 THEN strftime_iso WHEN 1 THEN strftime_slash ELSE ' ' || strftime_iso END AS fec_emision,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE replace(cast(cast(o_totalprice as decimal(18,2)) as string), '.', ',') END AS total_a_pagar,
  ' CL ' AS tarifa
FROM (SELECT *, cast(cast(o_orderdate as date) as string) AS strftime_iso,
  lpad(cast(day(o_orderdate) as string), 2, '0') || '-' || lpad(cast(month(o_orderdate) as string), 2, '0') || '-' ||
  cast(year(o_orderdate) as string) AS strftime_slash FROM {orders})
"""
_FREE_SQL = (
    "SELECT CAST(trim(num_recibo) AS BIGINT) AS num_recibo, left(nullif(trim(per_consumo), ''), 50) AS per_consumo, "
    f"{q.iso(q.date_exact('fec_emision'))} AS fec_emision, "
    "CAST(TRY_CAST(nullif(replace(trim(total_a_pagar), ',', '.'), '') AS DECIMAL(18,2)) AS DOUBLE) AS total_a_pagar, "
    "left(nullif(trim(tarifa), ''), 10) AS tarifa FROM (SELECT * FROM ("
    + q.marked("{}", (), _DUP)
    + ") WHERE reason IS NULL)"
)
_FREE_OLD = _FREE_SQL.replace("FROM {})", f"FROM (SELECT * FROM ({duck(_FREE)}) WHERE issued < TIMESTAMP '1998-01-01'))")
_FREE_NEW = _FREE_SQL.replace("FROM {})", f"FROM (SELECT * FROM ({duck(_FREE)}) WHERE issued >= TIMESTAMP '1996-01-01'))")


@query(
    "free_client_load",
    f"WITH t AS ({_FREE_OLD}), s AS ({_FREE_NEW}) "
    "SELECT num_recibo, per_consumo, CASE WHEN s.tarifa IS NULL THEN t.fec_emision ELSE s.fec_emision END AS fec_emision, "
    "CASE WHEN s.tarifa IS NULL THEN t.total_a_pagar ELSE s.total_a_pagar END AS total_a_pagar, "
    "CASE WHEN s.tarifa IS NULL THEN 'keep' WHEN t.tarifa IS NULL THEN 'insert' "
    "WHEN (s.fec_emision, s.total_a_pagar) IS NOT DISTINCT FROM (t.fec_emision, t.total_a_pagar) THEN 'same' ELSE 'update' END AS action "
    "FROM t FULL JOIN s USING (num_recibo, per_consumo)",
)
def free_client_load(spark, sf):
    landing, feed = derive(spark, sf, _FREE), feeds.FREE_CLIENTS
    state = lambda rows: loads.stage(loads.quarantine.accepted(loads.mark(rows, feed)), feed)
    old, new = state(landing.where("issued < '1998-01-01'")), state(landing.where("issued >= '1996-01-01'"))
    merged = load.with_rest(old, loads.merge(old, new, feed), feed.key)
    return merged.select("num_recibo", "per_consumo", "fec_emision", "total_a_pagar", F.col("_action").alias("action"))


_ORDERS_TEXT = """
SELECT o_orderkey AS ord, o_orderdate AS issued,
  CASE WHEN o_orderkey % 31 = 0 THEN '  ' ELSE ' T' || cast(o_orderkey - o_orderkey % 3 as string) END AS task_id,
  cast(cast(o_orderdate as date) as string) || 'T08:30:00.250Z' AS createtime,
  CASE WHEN o_orderkey % 4 = 0 THEN 'n/a' ELSE cast(cast(o_orderdate as date) as string) END AS complete_time,
  CASE WHEN o_orderkey % 6 = 0 THEN 'x' ELSE ' -' || cast(o_orderkey % 6 as string) END AS reject_counter,
  ' ' || o_orderpriority AS title
FROM {orders}
"""


def _work(source):
    return (
        f"SELECT trim(task_id) AS task_id, {q.iso(q.timestamp_order('createtime'))} AS createtime, "
        f"{q.iso(q.timestamp_order('complete_time'))} AS complete_time, "
        "CASE WHEN regexp_full_match(trim(reject_counter), '-?\\d+') THEN CAST(trim(reject_counter) AS BIGINT) END AS reject_counter, "
        f"nullif(trim(title), '') AS title FROM {source} WHERE trim(task_id) <> '' "
        "QUALIFY row_number() OVER (PARTITION BY trim(task_id) ORDER BY ord) = 1"
    )


_WORK_OLD = f"(SELECT * FROM ({duck(_ORDERS_TEXT)}) WHERE issued < TIMESTAMP '1998-01-01')"
_WORK_NEW = f"(SELECT * FROM ({duck(_ORDERS_TEXT)}) WHERE issued >= TIMESTAMP '1996-01-01')"
_WORK_COLUMNS = ("task_id", "createtime", "complete_time", "reject_counter", "title")


def _run_work_orders(spark, sf, feed):
    landing = derive(spark, sf, _ORDERS_TEXT)
    store = Table(spark, scratch_path(spark, "work-orders"), feed.schema())
    for batch in (landing.where("issued < '1998-01-01'"), landing.where("issued >= '1996-01-01'")):
        loads.run_feed(spark, batch, feed, store, None, _STAMP)
    return store.read().select(*_WORK_COLUMNS)


@query(
    "work_order_load",
    f"WITH a AS ({_work(_WORK_OLD)}), b AS ({_work(_WORK_NEW)}) "
    "SELECT * FROM b UNION ALL SELECT * FROM a WHERE task_id NOT IN (SELECT task_id FROM b)",
)
def work_order_load(spark, sf):
    return _run_work_orders(spark, sf, feeds.WORK_ORDERS)


@query(
    "work_order_insert",
    f"WITH a AS ({_work(_WORK_OLD)}), b AS ({_work(_WORK_NEW)}) "
    "SELECT * FROM a UNION ALL SELECT * FROM b WHERE task_id NOT IN (SELECT task_id FROM a)",
)
def work_order_insert(spark, sf):
    return _run_work_orders(spark, sf, feeds.WORK_ORDERS_INSERT)


_FIELD = """
SELECT o_orderkey AS ord, CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE ' N' || cast(o_custkey as string) END AS nro_toa,
  cast(o_orderkey as string) || CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'b' END AS id_recurso,
  '05/03/' || substring(cast(year(o_orderdate) as string), 3, 2) AS fecha_de_cita,
  CASE WHEN o_orderkey % 8 = 0 THEN 'soon' ELSE lpad(cast(day(o_orderdate) as string), 2, '0') || '/' ||
    lpad(cast(month(o_orderdate) as string), 2, '0') || '/' || substring(cast(year(o_orderdate) as string), 3, 2) || ' ' ||
    cast(1 + o_orderkey % 12 as string) || ':15 PM' END AS fecha_de_registro_de_actividad_toa,
  '-' || cast(o_orderkey % 90 as string) || ',25' AS direccion_polar_x, ' ' || o_orderstatus AS estado
FROM {orders}
"""


@query(
    "field_service_load",
    f"WITH t AS (SELECT *, {q.timestamp_field('fecha_de_registro_de_actividad_toa')} AS ts FROM ({duck(_FIELD)})) "
    "SELECT trim(nro_toa) AS nro_toa, CASE WHEN regexp_full_match(trim(id_recurso), '[0-9]+') THEN CAST(trim(id_recurso) AS INTEGER) END AS id_recurso, "
    f"{q.iso(q.date_short_year('fecha_de_cita'))} AS fecha_de_cita, CAST(ts AS VARCHAR) AS registered, "
    "CAST(replace(direccion_polar_x, ',', '.') AS DOUBLE) AS direccion_polar_x, trim(estado) AS estado "
    "FROM t WHERE trim(nro_toa) <> '' QUALIFY row_number() OVER (PARTITION BY trim(nro_toa) ORDER BY ts DESC NULLS LAST, ord) = 1",
)
def field_service_load(spark, sf):
    landing, feed = derive(spark, sf, _FIELD), feeds.FIELD_SERVICE
    store = Table(spark, scratch_path(spark, "field"), feed.schema())
    loads.run_feed(spark, landing, feed, store, None, _STAMP)
    return store.read().select(
        "nro_toa", "id_recurso", "fecha_de_cita", F.col(feed.latest_by).alias("registered"), "direccion_polar_x", "estado"
    )


_SITES = """
SELECT c_custkey AS ord, CASE WHEN c_custkey % 9 = 0 THEN '  ' ELSE ' S' || cast(c_custkey as string) END AS codigo_unico,
  ' ' || c_name AS nombre_local, '-' || cast(c_custkey % 90 as string) || ',046412345' AS latitud,
  cast(c_custkey % 90 as string) || '.25' || CASE WHEN c_custkey % 4 = 0 THEN ' W' ELSE '' END AS longitud,
  CASE WHEN c_custkey % 2 = 0 THEN '2021-07-15' ELSE '15/07/2021 ' END AS fecha_puesta_en_servicio,
  c_mktsegment || c_mktsegment AS ubigeo, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE ' 12345678' END AS base
FROM {customer}
"""


@query(
    "site_load",
    "SELECT trim(codigo_unico) AS codigo_unico, trim(nombre_local) AS nombre_local, "
    "CAST(CAST(replace(latitud, ',', '.') AS DECIMAL(11,8)) AS DOUBLE) AS latitud, "
    "CASE WHEN regexp_full_match(trim(longitud), '[+-]?\\d+([.,]\\d+)?') THEN CAST(trim(longitud) AS DOUBLE) END AS longitud, "
    f"{q.iso(q.date_exact('fecha_puesta_en_servicio'))} AS en_servicio, left(ubigeo, 10) AS ubigeo FROM ({duck(_SITES)})",
)
def site_load(spark, sf):
    landing, feed = derive(spark, sf, _SITES), feeds.SITES
    store = Table(spark, scratch_path(spark, "sites"), feed.schema())
    for _ in range(2):  # a second refresh replaces the first
        loads.run_feed(spark, landing, feed, store, None, _STAMP)
    return store.read().select(
        "codigo_unico", "nombre_local", "latitud", "longitud", F.col("fecha_puesta_en_servicio").alias("en_servicio"), "ubigeo"
    )


@query(
    "site_change_load",
    "SELECT nullif(trim(codigo_unico), '') AS codigo_unico, "
    "CAST(CAST(replace(latitud, ',', '.') AS DECIMAL(11,8)) AS DOUBLE) AS latitud, "
    "CASE WHEN longitud LIKE '% W' THEN -CAST(replace(longitud, ' W', '') AS DOUBLE) ELSE CAST(longitud AS DOUBLE) END AS longitud, "
    f"coalesce(left(trim(base), 6), '') AS base FROM ({duck(_SITES)})",
)
def site_change_load(spark, sf):
    staged = loads.stage(derive(spark, sf, _SITES), feeds.SITE_CHANGES)
    return staged.select("codigo_unico", "latitud", "longitud", "base")


# --- checklist history ---------------------------------------------------------------------------

_ANSWERS = """
SELECT event_type AS form, cast(event_id as string) AS task_id, cast(user_id as string) AS site_id,
  'w' || cast(event_id % 7 as string) AS sub_wo_id, 'q1' AS question, props AS answer
FROM {events}
"""


@query(
    "checklist_load",
    f"SELECT form, task_id, site_id, sub_wo_id, answer, '2024-01-31 17:00:00' AS fechacarga FROM ({duck(_ANSWERS)})",
)
def checklist_load(spark, sf):
    """The same answers delivered twice in a day: only the later batch stays."""
    answers = derive(spark, sf, _ANSWERS)
    history = checklist.history(spark, scratch_path(spark, "checklist"))
    forms = ["click", "error", "purchase", "signup", "view"]
    for hour in (9, 17):
        checklist.append_batch(answers, history, forms, datetime(2024, 1, 31, hour))
    checklist.clean_day(history, datetime(2024, 1, 31).date())
    return history.read().select("form", "task_id", "site_id", "sub_wo_id", "answer", "fechacarga")


# --- direct loads ----------------------------------------------------------------------------------


@query(
    "direct_load",
    "SELECT CAST(c_custkey AS VARCHAR) AS suministro_actual, c_name AS direccion, CAST(NULL AS VARCHAR) AS ceco FROM customer",
)
def direct_load(spark, sf):
    """A sheet straight into the typed supply table: loose headers, absent columns NULL."""
    sheet = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("SUMINISTRO  Actual"), F.col("c_name").alias("Dirección"),
        F.col("c_mktsegment").alias("otra"),
    )
    store = Table(spark, scratch_path(spark, "supplies"), loads.supply_schema())
    loads.load_direct(sheet, store, {"suministro_actual": "suministro actual", "direccion": "direccion", "ceco": "CECO"})
    return store.read().select("suministro_actual", "direccion", "ceco")


@query("manual_load", "SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS nombre, CAST(NULL AS VARCHAR) AS nota FROM supplier")
def manual_load(spark, sf):
    path = scratch_path(spark, "manual")
    rows = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("Id"), F.col("s_name").alias(" NOMBRE"), "s_acctbal")
    rows.write.option("header", True).csv(path)
    store = Table(spark, scratch_path(spark, "manual-table"), "id string, nombre string, nota string")
    exports.manual_load(spark, path, store, mapping={"id": "Id", "nombre": "Nombre"})
    return store.read()
