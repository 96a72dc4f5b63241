"""Whole jobs at their edges: bad keys, empty batches, two sources, failing forms, logged errors."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import functions as F

from catalog import sqltext as q
from catalog.loading import _DUP, _FIRST_BATCH, _FREE, _NEW, _OLD, _RULES, _SITES, _STAMP, _bill, _days
from catalog.registry import BILLS, READINGS_TEXT, RUNS, derive, duck, query, table
from lakeops.operators import dedup, quarantine, schema
from lakeops.operators.stats import group_stats
from lakeops.plans import checklist, feeds, loads, meter, runlog, sqlapi
from lakeops.plans.serving import union_view
from lakeops.session import scratch_path
from lakeops.sources.tables import Table, load_frame

_LATER = datetime(2024, 2, 2, 8)

# --- free clients: keys that no number can hold -----------------------------------------------

# The id of some rows has letters, more digits than a number may have, a null token, or nothing.
_SPOILT = _FREE.replace(
    "' ' || cast(o_orderkey - o_orderkey % 2 as string) AS num_recibo",
    "CASE WHEN o_orderkey % 53 = 0 THEN 'A' || cast(o_orderkey as string) WHEN o_orderkey % 43 = 0 THEN 'nan' "
    "WHEN o_orderkey % 47 = 0 THEN ' Null ' WHEN o_orderkey % 61 = 0 THEN '  ' WHEN o_orderkey % 59 = 0 "
    "THEN '99999999999999999' || cast(o_orderkey as string) "
    "ELSE ' ' || cast(o_orderkey - o_orderkey % 2 as string) END AS num_recibo",
)
_PARTS = {"old": "issued < TIMESTAMP '1998-01-01'", "new": "issued >= TIMESTAMP '1996-01-01'"}
_TYPED = "TRY_CAST(trim(num_recibo) AS BIGINT) IS NOT NULL"


def _free_part(when: str) -> str:
    good = f"(SELECT * FROM ({duck(_SPOILT)}) WHERE {when} AND {_TYPED})"
    return (
        "SELECT CAST(trim(num_recibo) AS BIGINT) AS num_recibo, left(nullif(trim(per_consumo), ''), 50) AS per_consumo, "
        f"{q.iso(q.date_exact('fec_emision'))} AS fec_emision, "
        "CAST(TRY_CAST(nullif(replace(trim(total_a_pagar), ',', '.'), '') AS DECIMAL(18,2)) AS DOUBLE) AS total_a_pagar "
        f"FROM ({q.marked(good, (), _DUP)}) WHERE reason IS NULL"
    )


def _free_rejects(when: str) -> str:
    rows = f"(SELECT * FROM ({duck(_SPOILT)}) WHERE {when})"
    good = f"(SELECT * FROM {rows} WHERE {_TYPED} OR trim(num_recibo) = '')"  # blank ones are left out without a reject
    return (
        f"SELECT num_recibo, per_consumo, 'untyped' AS reason FROM {rows} WHERE NOT ({_TYPED}) AND trim(num_recibo) <> '' UNION ALL "
        f"SELECT num_recibo, per_consumo, reason FROM ({q.marked(good, (), _DUP)}) WHERE reason IS NOT NULL"
    )


def _run_free(spark, sf):
    """Two overlapping batches, a day apart and by two users, into a store of periods."""
    landing, feed = derive(spark, sf, _SPOILT), feeds.FREE_CLIENTS
    store = Table(spark, scratch_path(spark, "free"), feed.schema(), partition_by=["per_consumo"])
    rejects = Table(spark, scratch_path(spark, "free-rejects"), loads.reject_schema(landing.schema))
    for when, stamp, user in (("issued < '1998-01-01'", _STAMP, "one"), ("issued >= '1996-01-01'", _LATER, "two")):
        loads.run_feed(spark, landing.where(when), feed, store, rejects, stamp, user)
    return store, rejects


@query(
    "free_client_run",
    f"WITH a AS ({_free_part(_PARTS['old'])}), b AS ({_free_part(_PARTS['new'])}) "
    "SELECT num_recibo, per_consumo, CASE WHEN b.n IS NULL THEN a.fec_emision ELSE b.fec_emision END AS fec_emision, "
    "CASE WHEN b.n IS NULL THEN a.total_a_pagar ELSE b.total_a_pagar END AS total_a_pagar, "
    "CASE WHEN a.n IS NULL THEN 'two' ELSE 'one' END AS creation_user, "
    "CASE WHEN a.n IS NULL THEN '2024-02-02 08:00:00' ELSE '2024-02-01 08:00:00' END AS creation_date "
    "FROM (SELECT *, 1 AS n FROM a) a FULL JOIN (SELECT *, 1 AS n FROM b) b USING (num_recibo, per_consumo)",
)
def free_client_run(spark, sf):
    """Updated and unchanged rows keep who stored them and when."""
    store, _ = _run_free(spark, sf)
    return store.read().select("num_recibo", "per_consumo", "fec_emision", "total_a_pagar", *feeds.AUDIT)


@query(
    "free_client_rejects",
    f"SELECT num_recibo, per_consumo, reason, day, count(*) AS copies FROM (SELECT *, '2024-02-01' AS day FROM "
    f"({_free_rejects(_PARTS['old'])}) UNION ALL SELECT *, '2024-02-02' AS day FROM ({_free_rejects(_PARTS['new'])})) GROUP BY ALL",
)
def free_client_rejects(spark, sf):
    _, rejects = _run_free(spark, sf)
    return rejects.read().groupBy(
        "num_recibo", "per_consumo", F.col("_reason").alias("reason"), F.to_date("_batch_ts").cast("string").alias("day")
    ).agg(F.count(F.lit(1)).alias("copies"))


# --- empty batches ----------------------------------------------------------------------------

_ALL_SPOILT = _FREE.replace("' ' || cast(o_orderkey - o_orderkey % 2 as string) AS num_recibo", "'A' || cast(o_orderkey as string) AS num_recibo")


@query(
    "feed_empty_batch",
    "SELECT CAST(0 AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS updated, count(*) AS rejected, CAST(0 AS BIGINT) AS stored "
    f"FROM ({duck(_ALL_SPOILT)})",
)
def feed_empty_batch(spark, sf):
    """No row of the batch can be stored."""
    landing, feed = derive(spark, sf, _ALL_SPOILT), feeds.FREE_CLIENTS
    store = Table(spark, scratch_path(spark, "free"), feed.schema(), partition_by=["per_consumo"])
    rejects = Table(spark, scratch_path(spark, "free-rejects"), loads.reject_schema(landing.schema))
    done = loads.run_feed(spark, landing, feed, store, rejects, _STAMP)
    counted = rejects.read().agg(F.count(F.lit(1)).alias("rejected"))
    return counted.select(
        F.lit(done["inserted"]).cast("long").alias("inserted"), F.lit(done["updated"]).cast("long").alias("updated"), "rejected",
        F.lit(store.read().count()).cast("long").alias("stored"),
    )


@query(
    "meter_load_empty",
    f"SELECT count(*) AS stored, CAST(0 AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS updated FROM ({_days(_FIRST_BATCH)})",
)
def meter_load_empty(spark, sf):
    """A second batch that lies wholly after the day the job runs for."""
    text = derive(spark, sf, READINGS_TEXT)
    days = meter.day_table(spark, scratch_path(spark, "days"))
    months = meter.month_table(spark, scratch_path(spark, "months"))
    meter.load_readings(spark, text.where(F.col("delivered") < "2024-01-20"), days, months, date(2024, 1, 31))
    done = meter.load_readings(spark, text.where(F.col("delivered") >= "2024-01-20"), days, months, date(2023, 12, 1))
    counted = days.read().agg(F.count(F.lit(1)).alias("stored"))
    return counted.select("stored", *[F.lit(done[c]).cast("long").alias(c) for c in ("inserted", "updated")])


# --- two sources, one store -------------------------------------------------------------------

_HALF = {"a": f"(SELECT * FROM ({duck(BILLS)}) WHERE ord % 200 < 120)", "b": f"(SELECT * FROM ({duck(BILLS)}) WHERE ord % 200 >= 80)"}
_BILL_IDS = (
    "SELECT trim(num_recibo) AS num_recibo FROM ({}) WHERE reason IS NULL "
    "QUALIFY row_number() OVER (PARTITION BY trim(num_recibo) ORDER BY ord) = 1"
)


@query(
    "bills_two_sources",
    f"WITH a AS ({_BILL_IDS.format(q.marked(_HALF['a'], _RULES, _DUP))}), b AS ({_BILL_IDS.format(q.marked(_HALF['b'], _RULES, _DUP))}) "
    "SELECT 'store' AS place, 'one' AS what, count(*) AS n FROM a UNION ALL "
    "SELECT 'store', 'two', count(*) FROM b WHERE num_recibo NOT IN (SELECT num_recibo FROM a) UNION ALL "
    f"SELECT 'raw.bills', reason, count(*) FROM ({q.marked(_HALF['a'], _RULES, _DUP)}) WHERE reason IS NOT NULL GROUP BY 2 UNION ALL "
    f"SELECT 'raw.bills_other', reason, count(*) FROM ({q.marked(_HALF['b'], _RULES, _DUP)}) WHERE reason IS NOT NULL GROUP BY 2",
)
def bills_two_sources(spark, sf):
    """Two feeds fill one store; their rejects stay apart, also where both reject one key."""
    landing = derive(spark, sf, BILLS)
    store = Table(spark, scratch_path(spark, "bills"), feeds.BILLS.schema())
    rejects = Table(spark, scratch_path(spark, "rejects"), loads.reject_schema(landing.schema))
    other = replace(feeds.BILLS, source="raw.bills_other")
    for rows, feed, user in ((landing.where("ord % 200 < 120"), feeds.BILLS, "one"), (landing.where("ord % 200 >= 80"), other, "two")):
        loads.run_feed(spark, rows, feed, store, rejects, _STAMP, user)
    stored = store.read().groupBy(F.lit("store").alias("place"), F.col("creation_user").alias("what"))
    bad = rejects.read().groupBy(F.col("_source").alias("place"), F.col("_reason").alias("what"))
    n = F.count(F.lit(1)).alias("n")
    return stored.agg(n).unionByName(bad.agg(n))


@query(
    "bills_union_stores",
    f"SELECT num_recibo, 'one' AS creation_user, '2024-02-01 08:00:00' AS creation_date, 'bills' AS tabla_origen "
    f"FROM ({_bill(q.date_slash_or_iso, _RULES, _OLD)}) UNION ALL "
    f"SELECT num_recibo, 'two', '2024-02-02 08:00:00', 'web' FROM ({_bill(q.date_any_separator, (), _NEW)}) UNION ALL "
    f"SELECT left(num_recibo, 255), NULL, NULL, 'landing' FROM ({duck(BILLS)})",
)
def bills_union_stores(spark, sf):
    """The view over loaded stores shows who stored a row and when; a landing table has neither."""
    landing, stores = derive(spark, sf, BILLS), {}
    for label, feed, rows, stamp, user in (
        ("bills", feeds.BILLS, landing.where("issued < '1998-01-01'"), _STAMP, "one"),
        ("web", feeds.WEB_BILLS, landing.where("issued >= '1996-01-01'"), _LATER, "two"),
    ):
        store = Table(spark, scratch_path(spark, label), feed.schema())
        loads.run_feed(spark, rows, feed, store, None, stamp, user)
        stores[label] = store.read()
    view = union_view(stores | {"landing": landing.drop("ord", "issued")})
    return view.select("num_recibo", "creation_user", "creation_date", "tabla_origen")


# --- forms ------------------------------------------------------------------------------------

_ANSWERS = "SELECT event_id, event_type, user_id, props, ts FROM {events}"


@query(
    "form_outcomes",
    "SELECT event_type AS form, count(*) AS n_rows, 200 AS code, CAST(NULL AS VARCHAR) AS message, 207 AS overall FROM events "
    "WHERE event_type IN ('click', 'view') GROUP BY 1 UNION ALL "
    "SELECT 'empty', 0, 204, NULL, 207 UNION ALL SELECT 'error', 0, 500, 'missing: answer, sub_wo_id', 207",
)
def form_outcomes(spark, sf):
    """One form lacks columns: it is recorded, and the others load."""
    events = derive(spark, sf, _ANSWERS)
    row = events.select(
        "event_type", F.col("event_id").alias("task_id"), F.col("user_id").alias("site_id"), F.lit("w").alias("sub_wo_id"),
        F.lit("q").alias("question"), F.col("props").alias("answer"),
    )
    frames = {f: row.where(F.col("event_type") == f).drop("event_type") for f in ("click", "view", "error", "empty")}
    frames["error"] = frames["error"].drop("answer", "sub_wo_id")
    history = checklist.history(spark, scratch_path(spark, "checklist"))
    report, overall = checklist.append_forms(frames, history, ["click", "view", "error", "empty"], datetime(2024, 1, 31, 9))
    stored = history.read().groupBy("form").agg(F.count(F.lit(1)).alias("_stored"))
    checked = report.join(stored.withColumnRenamed("form", "_form"), F.col("form") == F.col("_form"), "left")
    return checked.where(F.coalesce("_stored", F.lit(0)) == F.col("n_rows")).select(
        "form", "n_rows", "code", "message", F.lit(overall).alias("overall")
    )


@query(
    "forms_apart",
    "SELECT event_type AS form, CASE WHEN event_type = 'error' THEN 0 ELSE count(*) END AS n_rows, "
    "CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 404 ELSE 200 END AS code, "
    "CASE WHEN event_type = 'error' THEN 'spoilt sheet' END AS message, 207 AS overall FROM events GROUP BY 1",
)
def forms_apart(spark, sf):
    """One form fails while it is read, and nobody expects another: the others are stored."""
    events = derive(spark, sf, _ANSWERS)
    answer = F.when((F.col("event_type") == "error") & (F.col("event_id") >= 0), F.raise_error(F.lit("spoilt sheet")).cast("string"))
    row = events.select(
        "event_type", F.col("event_id").alias("task_id"), F.col("user_id").alias("site_id"), F.lit("w").alias("sub_wo_id"),
        F.lit("q").alias("question"), answer.otherwise(F.col("props")).alias("answer"),
    )
    frames = {f: row.where(F.col("event_type") == f).drop("event_type") for f in ("click", "view", "error", "purchase", "signup")}
    history = checklist.history(spark, scratch_path(spark, "checklist"))
    report, overall = checklist.append_forms(frames, history, ["click", "error", "purchase", "view"], datetime(2024, 1, 31, 9))
    stored = history.read().groupBy(F.col("form").alias("_form")).agg(F.count(F.lit(1)).alias("_stored"))
    checked = report.join(stored, F.col("form") == F.col("_form"), "left")
    right = F.coalesce("_stored", F.lit(0)) == F.when(F.col("code") == 404, 0).otherwise(F.col("n_rows"))
    message = F.when(F.contains("message", F.lit("spoilt sheet")), "spoilt sheet").otherwise(F.col("message"))
    return checked.where(right).select("form", "n_rows", "code", message.alias("message"), F.lit(overall).alias("overall"))


def _lost(source: str) -> str:
    """Values of the rows that a batch stores that are no number."""
    stored = (
        f"(SELECT * FROM ({q.marked(source, _RULES, _DUP)}) WHERE reason IS NULL "
        "QUALIFY row_number() OVER (PARTITION BY trim(num_recibo) ORDER BY ord) = 1)"
    )
    fails = {
        "fec_emision": q.date_slash_or_iso("fec_emision"), "ea_pu_hp": q.try_numeric("ea_pu_hp"),
        "dias_punta": q.try_numeric("dias_punta"), "total_a_pagar": q.try_numeric("total_a_pagar"),
    }
    parts = [f"SELECT '{c}' AS columna, {c} AS valor FROM {stored} WHERE NOT {q.missing(c)} AND {x} IS NULL" for c, x in fails.items()]
    return " UNION ALL ".join(parts)


@query(
    "lost_values",
    f"SELECT day, columna, valor, count(*) AS n FROM (SELECT '2024-02-01' AS day, * FROM ({_lost(_OLD)}) UNION ALL "
    f"SELECT '2024-02-02', * FROM ({_lost(_NEW)})) GROUP BY ALL",
)
def lost_values(spark, sf):
    """Texts that cleaning makes NULL, by column and batch; the first batch comes twice on its day and counts once."""
    landing, feed = derive(spark, sf, BILLS), feeds.BILLS
    store = Table(spark, scratch_path(spark, "bills"), feed.schema())
    rejects = Table(spark, scratch_path(spark, "rejects"), loads.reject_schema(landing.schema))
    losses = Table(spark, scratch_path(spark, "losses"), loads.LOSSES)
    old, new = landing.where("issued < '1998-01-01'"), landing.where("issued >= '1996-01-01'")
    for batch, stamp in ((old, _STAMP), (old, _STAMP), (new, _LATER)):
        loads.run_feed(spark, batch, feed, store, rejects, stamp, losses=losses)
    day = F.to_date("_batch_ts").cast("string").alias("day")
    return losses.read().groupBy(day, "columna", "valor").agg(F.count(F.lit(1)).alias("n"))


@query(
    "unknown_forms",
    "SELECT event_type AS form, count(*) AS n_rows, CASE WHEN event_type IN ('click', 'view') THEN 200 ELSE 404 END AS code "
    "FROM events GROUP BY 1",
)
def unknown_forms(spark, sf):
    """Answers of a form nobody expects are reported, not dropped in silence."""
    events = derive(spark, sf, _ANSWERS)
    answers = events.select(F.col("event_type").alias("form"), *[F.lit("x").alias(c) for c in checklist.ROW[1:]])
    history = checklist.history(spark, scratch_path(spark, "checklist"))
    return checklist.append_batch(answers, history, ["click", "view"], datetime(2024, 1, 31, 9))


_NULLS = (
    "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS form, "
    "CASE WHEN event_id % 11 = 0 THEN NULL ELSE date_trunc('hour', ts) END AS fechacarga FROM {events}"
)


@query(
    "keep_last_batch_nulls",
    f"WITH t AS ({duck(_NULLS)}) SELECT event_id, form, CAST(fechacarga AS VARCHAR) AS fechacarga FROM t "
    "QUALIFY fechacarga IS NULL OR fechacarga = max(fechacarga) OVER (PARTITION BY form, CAST(fechacarga AS DATE))",
)
def keep_last_batch_nulls(spark, sf):
    """Rows without a form are judged as a form of their own, rows without a stamp stay."""
    kept = dedup.keep_last_batch(derive(spark, sf, _NULLS), ["form"], "fechacarga", spread_by=["event_id"])
    return kept.select("event_id", "form", F.col("fechacarga").cast("timestamp_ntz").alias("fechacarga"))


# --- keys that hold a third of all rows ---------------------------------------------------------

_HOT = "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE cast(user_id as string) END AS site, value FROM {events}"
# Some sites have a single row.
_HOT_AND_ALONE = _HOT.replace("ELSE cast(user_id", "WHEN event_id % 5 = 1 THEN 'only ' || cast(event_id as string) ELSE cast(user_id")


@query(
    "hot_site_stats",
    f"SELECT site, count(*) AS n, round(median(value), 6) AS median, round(stddev_samp(value), 6) AS std FROM ({duck(_HOT)}) GROUP BY 1",
)
def hot_site_stats(spark, sf):
    """A hot site's median is located, and its bracket joined back with salts."""
    rows = derive(spark, sf, _HOT).withColumn("value", F.col("value").cast("double"))
    stats = group_stats(rows, ["site"], "value", spread_by=["event_id"])
    return stats.select("site", "n", F.round("median", 6).alias("median"), F.round("std", 6).alias("std"))


@query(
    "hot_duplicates",
    f"SELECT event_id, CASE WHEN count(*) OVER (PARTITION BY site) > 1 THEN 'duplicate' END AS reason FROM ({duck(_HOT_AND_ALONE)})",
)
def hot_duplicates(spark, sf):
    """Repeats of a hot key are marked row by row, spread over tasks."""
    rows = derive(spark, sf, _HOT_AND_ALONE)
    marked = quarantine.mark_rejects(rows, {}, {"site": F.col("site")}, spread_by=["event_id"])
    return marked.select("event_id", F.col("_reason").alias("reason"))


# --- tables, schemas, log, SQL ----------------------------------------------------------------


@query(
    "site_change_run",
    "SELECT nullif(trim(codigo_unico), '') AS codigo_unico, CAST(CAST(replace(latitud, ',', '.') AS DECIMAL(11,8)) AS DOUBLE) AS latitud, "
    f"coalesce(left(trim(base), 6), '') AS base, 'two' AS creation_user FROM ({duck(_SITES)}) WHERE ord % 2 = 0",
)
def site_change_run(spark, sf):
    """A refresh through the whole load replaces the one before."""
    landing, feed = derive(spark, sf, _SITES), feeds.SITE_CHANGES
    store = Table(spark, scratch_path(spark, "site-changes"), feed.schema())
    loads.run_feed(spark, landing, feed, store, None, _STAMP, "one")
    loads.run_feed(spark, landing.where("ord % 2 = 0"), feed, store, None, _STAMP, "two")
    return store.read().select("codigo_unico", "latitud", "base", "creation_user")


@query(
    "schema_diff",
    "SELECT 'c_acctbal' AS \"column\", 'extra' AS status, count(*) AS n FROM customer UNION ALL SELECT 'nota', 'missing', count(*) FROM customer",
)
def schema_diff(spark, sf):
    found = table(spark, sf, "customer")
    target = [c for c in found.columns if c not in ("c_acctbal", "c_name")] + ["nombre", "nota"]
    difference = schema.schema_diff(found, target, mapping={"nombre": "c_name"})
    return difference.withColumn("n", F.lit(found.count()).cast("long"))


@query(
    "load_policies",
    "SELECT count(*) AS stored, 'exists' AS second, 'empty' AS third FROM supplier",
)
def load_policies(spark, sf):
    """``fail`` writes a new table and refuses one that is there; an empty frame is refused by all."""
    rows = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("id"))
    store = Table(spark, scratch_path(spark, "policies"), "id string")
    load_frame(rows, store, "fail")
    said = []
    for frame, mode in ((rows, "fail"), (rows.where("id is null"), "replace")):
        try:
            load_frame(frame, store, mode)
            said.append("loaded")
        except ValueError as refusal:
            said.append("exists" if "exists" in str(refusal) else "empty" if "no rows" in str(refusal) else str(refusal))
    return store.read().agg(F.count(F.lit(1)).alias("stored")).select("stored", F.lit(said[0]).alias("second"), F.lit(said[1]).alias("third"))


@query(
    "logged_runs",
    f"WITH m AS (SELECT reason FROM ({q.marked(f'({duck(BILLS)})', _RULES, _DUP)}) WHERE reason IS NULL), "
    f"ids AS ({_BILL_IDS.format(q.marked(f'({duck(BILLS)})', _RULES, _DUP))}) "
    "SELECT 'bills' AS sp, 'DONE' AS estado, (SELECT count(*) FROM ids) AS inserted, CAST(NULL AS VARCHAR) AS error UNION ALL "
    "SELECT 'broken', 'ERROR', NULL, 'no such period'",
)
def logged_runs(spark, sf):
    """A job that loads and a job that fails; the error is raised again after it is logged."""
    log = Table(spark, scratch_path(spark, "runlog"), runlog.SCHEMA)
    landing = derive(spark, sf, BILLS)
    store = Table(spark, scratch_path(spark, "bills"), feeds.BILLS.schema())

    def broken():
        raise LookupError("no such period")

    runlog.run_job(log, "bills", lambda: loads.run_feed(spark, landing, feeds.BILLS, store, None, _STAMP))
    try:
        runlog.run_job(log, "broken", broken)
    except LookupError:
        pass
    error = F.when(F.col("estado") == runlog.ERROR, F.col("msj_error")).alias("error")
    return log.read().select("sp", "estado", "inserted", error)


@query(
    "sql_functions",
    f"WITH r AS (SELECT * FROM ({duck(RUNS)}) WHERE sp = 'load_3' ORDER BY coalesce(fin, inicio) DESC, id DESC LIMIT 1) "
    f"SELECT id, CAST({q.try_numeric("'S/ ' || CAST(id AS VARCHAR) || '.25'")} AS DOUBLE) AS amount FROM r",
)
def sql_functions(spark, sf):
    """The registered SQL functions, called from SQL."""
    derive(spark, sf, RUNS).createOrReplaceTempView("logged")
    sqlapi.register(spark, log_view="logged")
    return spark.sql("SELECT id, try_numeric('S/ ' || cast(id AS string) || '.25') AS amount FROM latest_run('load_3')")


@query(
    "sql_latest_rejects",
    f"SELECT ord, reason FROM ({q.marked(f'({duck(BILLS)})', _RULES, _DUP)}) WHERE reason IS NOT NULL AND ord % 2 = 1",
)
def sql_latest_rejects(spark, sf):
    """The newest batch of a day's rejects, by SQL; the source's name ignores case and spaces."""
    marked = quarantine.mark_rejects(
        derive(spark, sf, BILLS), {"invalid": quarantine.invalid_id(F.col("num_recibo")), "missing": quarantine.missing_id(F.col("num_recibo"))},
        {c: F.col(c) for c in _DUP}, spread_by=["ord"],
    )
    stamp = F.when(F.col("ord") % 2 == 1, F.lit(_LATER)).otherwise(F.lit(datetime(2024, 2, 2, 7))).cast("timestamp_ntz")
    quarantine.rejected(marked, "raw.bills", stamp).createOrReplaceTempView("held")
    sqlapi.register(spark, rejects_view="held")
    return spark.sql("SELECT ord, _reason AS reason FROM latest_rejects(' RAW.Bills', DATE '2024-02-02')")
