import glob
import json
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from catalog.registry import BILLS, READINGS_TEXT, derive
from lakeops.operators import forms, load, quarantine, rollup
from lakeops.plans import checklist, exports, feeds, gaps, loads, meter, runlog
from lakeops.plans.serving import union_view
from lakeops.session import shared_dir, written
from lakeops.sources import files
from lakeops.sources.tables import Table

SF = "/root/testdata/sf0.001"
STAMP = datetime(2024, 2, 1, 8)


@pytest.fixture
def bills(spark):
    return derive(spark, SF, BILLS)


@pytest.fixture
def stores(spark, bills, tmp_path):
    def make(feed):
        store = Table(spark, str(tmp_path / "store"), feed.schema())
        return store, Table(spark, str(tmp_path / "rejects"), loads.reject_schema(bills.schema))

    return make


def test_rejects_and_accepted_make_the_input(bills):
    marked = loads.mark(bills, feeds.BILLS)
    assert marked.count() == bills.count()
    good, bad = quarantine.accepted(marked), marked.where("_reason is not null")
    assert good.count() + bad.count() == bills.count()
    assert good.select("ord").intersect(bad.select("ord")).isEmpty()


def test_bills_job_is_idempotent(spark, bills, stores):
    store, rejects = stores(feeds.BILLS)
    first = loads.run_feed(spark, bills, feeds.BILLS, store, rejects, STAMP)
    rows, bad = store.read().count(), rejects.read().count()
    assert first["inserted"] == rows > 0 and bad > 0
    again = loads.run_feed(spark, bills, feeds.BILLS, store, rejects, STAMP)
    assert again["inserted"] == 0
    assert (store.read().count(), rejects.read().count()) == (rows, bad)
    next_day = datetime(2024, 2, 2, 8)
    loads.run_feed(spark, bills, feeds.BILLS, store, rejects, next_day)
    assert rejects.read().count() == 2 * bad
    assert store.read().groupBy("num_recibo").count().where("count > 1").isEmpty()
    assert len([c for c in store.read().columns if c not in feeds.AUDIT]) == 86
    reasons = Counter(r._reason for r in rejects.read().where(F.col("_batch_ts") == STAMP).collect())
    assert first["message"].endswith(
        f"rejected {bad} (invalid: {reasons['invalid']}, missing: {reasons['missing']}, duplicate: {reasons['duplicate']})"
    )


def test_upsert_twice_is_upsert_once(spark, bills, stores):
    store, rejects = stores(feeds.WEB_BILLS)
    loads.run_feed(spark, bills, feeds.WEB_BILLS, store, rejects, STAMP)
    once = {tuple(r) for r in store.read().collect()}
    again = loads.run_feed(spark, bills, feeds.WEB_BILLS, store, rejects, STAMP)
    assert again["inserted"] == 0 and again["updated"] == len(once)
    assert {tuple(r) for r in store.read().collect()} == once


def test_upsert_changed_keeps_equal_rows(spark):
    old = spark.createDataFrame([(1, "a", None, "old"), (2, "b", 1, "old"), (3, "c", 1, "old")], "k int, x string, y int, audit string")
    new = spark.createDataFrame([(1, "a", None), (2, "b", 2), (4, "d", 1)], "k int, x string, y int")
    got = {r.k: (r.x, r.y, r.audit, r._action) for r in load.upsert_changed(old, new, ["k"]).collect()}
    assert got == {
        1: ("a", None, "old", "same"), 2: ("b", 2, "old", "update"), 3: ("c", 1, "old", "keep"), 4: ("d", 1, None, "insert"),
    }


def test_insert_new_twice_adds_nothing(spark):
    old, new = spark.range(5).toDF("k"), spark.range(3, 8).toDF("k")
    added = load.insert_new(old, new, ["k"])
    assert sorted(r.k for r in added.collect()) == [5, 6, 7]
    assert load.insert_new(old.union(added), new, ["k"]).isEmpty()


def test_refresh_counts(spark, tmp_path):
    landing = spark.createDataFrame(
        [(1, " N1", "05/03/24 1:07 PM"), (2, "N1", "05/03/2024 14:00"), (3, "N1", "x"), (4, " ", None), (5, "N2", None)],
        "ord int, nro_toa string, fecha_de_registro_de_actividad_toa string",
    )
    store = Table(spark, str(tmp_path / "f"), feeds.FIELD_SERVICE.schema())
    for deleted in (0, 2):
        out = loads.run_feed(spark, landing, feeds.FIELD_SERVICE, store, None, STAMP)
        assert (out["deleted"], out["nulls"], out["inserted"]) == (deleted, 1, 2)
    row = store.read().where("nro_toa = 'N1'").first()
    assert row.fecha_de_registro_de_actividad_toa == datetime(2024, 3, 5, 14)


def test_load_direct(spark, tmp_path):
    table = Table(spark, str(tmp_path / "s"), loads.supply_schema())
    source = spark.createDataFrame([("S1", "BT5B", "9")], "`Suministro  Actual` string, `Tarifa` string, `otro` string")
    mapping = {"suministro_actual": "suministro actual", "tarifa": "Tarifa", "ceco": "CECO"}
    loads.load_direct(source, table, mapping)
    row = table.read().first()
    assert (row.suministro_actual, row.tarifa, row.ceco) == ("S1", "BT5B", None) and len(row) == 28


@pytest.mark.parametrize("source, february", [("daily", 29), ("batch", 2)])
def test_partial_batch_and_month(spark, tmp_path, source, february):
    """A batch of two days must not shrink the month, unless asked to."""
    def landing(days):
        rows = [("s", "n", "o", f"2024-02-{d:02d} 10:00:00", "1", "1", "1") for d in days]
        return spark.createDataFrame(rows, "site_name string, subnet string, manage_object string, start_time string, " + ", ".join(f"{c} string" for c in rollup.HOURLY))

    days = meter.day_table(spark, str(tmp_path / "d"))
    months = meter.month_table(spark, str(tmp_path / "m"))
    meter.load_readings(spark, landing(range(1, 30)), days, months, date(2024, 3, 1), source)
    out = meter.load_readings(spark, landing([28, 29]), days, months, date(2024, 3, 1), source)
    assert (out["inserted"], out["updated"]) == (0, 3)
    assert months.read().first()[rollup.MONTHLY[0]] == february
    assert days.read().count() == 29


def test_readings_after_as_of_are_left_out(spark, tmp_path):
    text = derive(spark, SF, READINGS_TEXT)
    days = meter.day_table(spark, str(tmp_path / "d"))
    months = meter.month_table(spark, str(tmp_path / "m"))
    meter.load_readings(spark, text, days, months, date(2024, 1, 10))
    assert days.read().agg(F.max("fecha")).first()[0] == date(2024, 1, 10)
    with pytest.raises(ValueError):
        meter.load_readings(spark, text, days, months, date(2024, 1, 10), "weekly")


def test_checklist(spark, tmp_path):
    history = checklist.history(spark, str(tmp_path / "c"))
    answers = spark.createDataFrame([("a", "t1", "s", "w", "q", "1"), ("b", "t2", "s", "w", "q", "2")], ", ".join(f"{c} string" for c in checklist.ROW))
    for hour in (8, 9):
        status = checklist.append_batch(answers, history, ["a", "b", "c"], datetime(2024, 1, 5, hour))
        assert {(r.form, r.n_rows, r.code) for r in status.collect()} == {("a", 1, 200), ("b", 1, 200), ("c", 0, 204)}
    checklist.append_batch(answers.where("form = 'a'"), history, ["a"], datetime(2024, 1, 6, 7))
    report = {r.form: (r.kept_stamp, r.rows_removed) for r in checklist.clean_day(history, date(2024, 1, 5)).collect()}
    assert report == {f: (datetime(2024, 1, 5, 9), 1) for f in "ab"}
    assert history.read().count() == 3
    assert {r.rows_removed for r in checklist.clean_day(history, date(2024, 1, 5)).collect()} == {0}
    assert history.read().count() == 3


def test_run_log(spark, tmp_path):
    log = Table(spark, str(tmp_path / "log"), runlog.SCHEMA)
    row = runlog.run_job(log, "load", lambda: {"inserted": 3, "updated": 0, "message": "ok"}).first()
    assert (row.sp, row.estado, row.inserted, row.msj_error) == ("load", "DONE", 3, "ok")

    def boom():
        raise RuntimeError("bad file")

    with pytest.raises(RuntimeError):
        runlog.run_job(log, "load", boom)
    last = runlog.latest_run(log.read(), "load").first()
    assert (last.estado, last.msj_error) == ("ERROR", "bad file")
    stats = runlog.run_stats(log.read()).first()
    assert (stats.runs, stats.succeeded, stats.failed, stats.success_pct) == (2, 1, 1, 50.0)
    assert runlog.job_count(log.read()).first().jobs == 1


def test_latest_run_falls_back_to_start(spark):
    at = lambda d: datetime(2024, 1, d)
    rows = [(1, "j", at(5), None), (2, "j", at(1), at(3)), (3, "j", None, None), (4, "other", at(9), at(9))]
    runs = spark.createDataFrame(rows, "id bigint, sp string, inicio timestamp_ntz, fin timestamp_ntz")
    assert runlog.latest_run(runs, "j").first().id == 1


def test_export_rejects(spark, tmp_path):
    rows = [("r1", "raw.a", datetime(2024, 1, 5, 8)), ("r2", "raw.A ", datetime(2024, 1, 5, 9)), ("r3", "raw.b", datetime(2024, 1, 5, 10))]
    stored = spark.createDataFrame(rows, "num string, _source string, _batch_ts timestamp_ntz")
    path = exports.export_rejects(stored, " RAW.a", date(2024, 1, 5), str(tmp_path))
    assert [r.num for r in spark.read.option("header", True).csv(path).collect()] == ["r2"]
    assert exports.export_rejects(stored, "raw.a", date(2024, 1, 6), str(tmp_path)) is None


def test_union_view_keeps_filters_close_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "u")
    spark.createDataFrame([("1", "x" * 300), ("2", "y")], "num_recibo string, tarifa string").write.parquet(path)
    view = union_view({"a": spark.read.parquet(path), "b": spark.read.parquet(path).drop("tarifa")})
    assert view.columns[-1] == "tabla_origen" and len(view.columns) == 90
    got = {(r.num_recibo, r.tarifa and len(r.tarifa), r.tabla_origen) for r in view.collect()}
    assert got == {("1", 255, "a"), ("2", 1, "a"), ("1", None, "b"), ("2", None, "b")}
    one = view.where("tabla_origen = 'b'")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in one
    with pytest.raises(ValueError):
        union_view({})


def test_sql_functions(spark):
    from lakeops.plans import sqlapi

    at = lambda d, h=0: datetime(2024, 1, d, h)
    rejects = [("r1", "raw.a", at(5, 8)), ("r2", "RAW.A ", at(5, 9)), ("r3", "raw.a", at(6, 9)), ("r4", "raw.b", at(5, 10))]
    spark.createDataFrame(rejects, "num string, _source string, _batch_ts timestamp_ntz").createOrReplaceTempView("sql_rejects")
    runs = [(1, "j", at(5), None), (2, "j", at(1), at(3)), (3, "k", at(9), at(9))]
    spark.createDataFrame(runs, "id bigint, sp string, inicio timestamp_ntz, fin timestamp_ntz").createOrReplaceTempView("sql_runs")
    sqlapi.register(spark, "sql_rejects", "sql_runs")
    row = spark.sql("SELECT try_numeric('S/ 1,234.50') AS a, try_numeric('12,5') AS b, try_numeric('1e5') AS c").first()
    assert (float(row.a), row.b, float(row.c)) == (1234.5, None, 15.0)
    assert [r.num for r in spark.sql("SELECT * FROM latest_rejects(' raw.A', DATE '2024-01-05')").collect()] == ["r2"]
    assert [r.id for r in spark.sql("SELECT * FROM latest_run('j')").collect()] == [1]


def test_store_partitioned_by_key_column_is_rewritten_in_part(spark, tmp_path):
    feed = feeds.FREE_CLIENTS
    rows = [(i, str(i), "202401" if i < 3 else "202402", "1,5") for i in range(6)]
    landing = spark.createDataFrame(rows, "ord int, num_recibo string, per_consumo string, igv string")
    store = Table(spark, str(tmp_path / "s"), feed.schema(), partition_by=["per_consumo"])
    assert loads.run_feed(spark, landing, feed, store, None, STAMP)["inserted"] == 6
    parts = lambda: {p.name for p in (tmp_path / "s" / "per_consumo=202401").iterdir()}
    before = parts()
    late = landing.where("ord >= 4").withColumn("igv", F.when(F.col("ord") == 5, F.lit("9")).otherwise(F.col("igv")))
    out = loads.run_feed(spark, late, feed, store, None, STAMP)
    assert (out["inserted"], out["updated"]) == (0, 1)
    assert parts() == before
    assert sorted((r.num_recibo, float(r.igv)) for r in store.read().collect()) == [(0, 1.5), (1, 1.5), (2, 1.5), (3, 1.5), (4, 1.5), (5, 9.0)]


def _workbook(path, sheets):
    path.write_text(json.dumps(sheets))
    return str(path)


def test_checklist_from_workbook(spark, tmp_path):
    path = _workbook(
        tmp_path / "book.json",
        {"CLIMA - Condensador": [["Task ID", "Site-Id", "¿Ruido?", "Foto"], ["t1", "s1", "no", None]], "Vacía": [["Task Id"]]},
    )
    rows = checklist.read_answers(spark, path, parse=json.loads)
    got = {tuple(r) for r in rows.collect()}
    assert got == {("clima_condensador", "t1", "s1", None, "¿Ruido?", "no"), ("clima_condensador", "t1", "s1", None, "Foto", None)}
    history = checklist.history(spark, str(tmp_path / "h"))
    status = checklist.append_batch(rows, history, ["clima_condensador", "vacia"], STAMP)
    assert {(r.form, r.code) for r in status.collect()} == {("clima_condensador", 200), ("vacia", 204)}


def test_free_clients_from_forms(spark, tmp_path):
    grid = lambda code, period, amount: [[None], [code, None, amount], [period]]
    path = _workbook(
        tmp_path / "forms.json",
        {"1": grid("184977.0", "Setiembre 2024", "1,5"), "2": grid("7", "10/2024", "x"), "3": grid("9", "sin", "2")},
    )
    fields = {
        "tarifa": {"type": "str", "const": "CL"}, "cod_suministro": {"type": "int", "cell": "A2"},
        "per_consumo": {"type": "str", "cell": "A3"}, "igv": {"type": "decimal", "cell": "C2"},
    }
    cells = files.read_form_cells(spark, path, parse=json.loads)
    records = forms.number_receipts(forms.forms_to_records(cells, fields, group=("archivo", "sheet")))
    landing = forms.as_landing(records, ("archivo", "sheet"))
    store = Table(spark, str(tmp_path / "s"), feeds.FREE_CLIENTS.schema())
    out = loads.run_feed(spark, landing, feeds.FREE_CLIENTS, store, None, STAMP)
    assert out["inserted"] == 2
    got = {(r.num_recibo, r.per_consumo, r.cod_suministro, float(r.igv)) for r in store.read().collect()}
    assert got == {(202409184977, "Setiembre 2024", "184977", 1.5), (2024107, "10/2024", "7", 0.0)}


def test_export_report_cleans_up(spark, tmp_path):
    def build():
        rows = spark.createDataFrame([("S1_a", date(2024, 1, 20))], "site string, day date")
        return gaps.gap_report(written(rows, "export-test"), "site", "day", date(2024, 1, 31))

    before = set(glob.glob(shared_dir(spark).removeprefix("file:") + "/export-test-*"))
    path = exports.export_report(spark, build, str(tmp_path / "r"), gaps.HEADINGS)
    row = spark.read.option("header", True).csv(path).first()
    assert (row["Codigo Sitio"], row["Dias Faltantes Semana - Ayer"], row["Riesgo Actual"]) == ("S1", "9", "ALTO")
    assert set(glob.glob(shared_dir(spark).removeprefix("file:") + "/export-test-*")) == before


def _bytes_below(path):
    import pathlib

    return sum(f.stat().st_size for f in pathlib.Path(path).rglob("*.parquet"))


def test_an_update_writes_the_batch_not_the_store(spark, tmp_path):
    """Deltas: what an update adds to the folder follows the batch; compaction leaves the same rows."""
    store = Table(spark, f"{tmp_path}/store", "k long, v long, w string", key=["k"])
    rows = spark.range(200_000).select(F.col("id").alias("k"), F.col("id").alias("v"), F.uuid().alias("w"))
    store.replace(rows)
    before = _bytes_below(tmp_path)
    batch = spark.range(199_990, 200_010).select(F.col("id").alias("k"), (-F.col("id")).alias("v"), F.lit("new").alias("w"))
    for _ in range(3):
        store.upsert(batch)
    assert _bytes_below(tmp_path) - before < before / 100
    whole = store.read()
    assert whole.count() == 200_010 and whole.where("w = 'new'").count() == 20
    assert whole.groupBy("k").count().where("count > 1").isEmpty()
    with pytest.raises(ValueError, match="key"):
        Table(spark, f"{tmp_path}/store", store.schema).read()
    with pytest.raises(ValueError, match="compact"):
        store.append(batch)
    store.compact()
    assert not store._deltas() and sorted(map(tuple, store.read().where("k > 199980").collect())) == sorted(
        map(tuple, whole.where("k > 199980").collect())
    )
    store.upsert(batch.withColumn("v", F.lit(1)))
    store.replace(batch)  # leaves the old generation's deltas behind
    assert store.read().count() == 20


def test_a_folder_without_the_marker_is_not_read(spark, tmp_path):
    store = Table(spark, f"{tmp_path}/store", "k long", key=["k"])
    store.replace(spark.range(5).toDF("k"))
    spark.range(9).toDF("k").write.parquet(f"{tmp_path}/store/gen-00000002")
    spark.range(9).toDF("k").write.parquet(f"{tmp_path}/store/delta-00000001-00000001")
    assert store.read().count() == 5


def test_insert_only_reduces_the_store_first(spark):
    from lakeops.operators import load

    target = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    staged = spark.range(990, 1010).select(F.col("id").alias("k"), F.lit("y").alias("v"))
    found = load.insert_new(target, staged, ["k"])
    assert sorted(r.k for r in found.collect()) == list(range(1000, 1010))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = load.insert_new(target, staged, ["k"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 * 1024 * 1024)
    # Printed top down: the anti join reads what the semi join has left of the store's keys.
    assert plan.index("LeftAnti") < plan.index("LeftSemi")


def test_null_partition_is_read_and_kept(spark, tmp_path):
    store = Table(spark, f"{tmp_path}/store", "k long, p string", partition_by=["p"])
    store.append(spark.createDataFrame([(1, None), (2, "a"), (3, "b")], store.schema))
    batch = spark.createDataFrame([(4, None), (5, "a")], store.schema)
    assert sorted(r.k for r in store.read_touched(batch).collect()) == [1, 2]
    assert store.read_touched(batch.limit(0)).count() == 0


# --- jobs side by side, and what cleaning loses ------------------------------------------------------


def _form(spark, form, n, spoilt=False):
    answer = F.when(F.col("id") >= 0, F.raise_error(F.lit(f"no {form}")).cast("string")) if spoilt else F.lit(None).cast("string")
    columns = {"task_id": F.col("id"), "site_id": F.lit("s"), "sub_wo_id": F.lit("w"), "question": F.lit("q"), "answer": answer.otherwise("a") if spoilt else F.lit("a")}
    return spark.range(n).select(*[c.cast("string").alias(k) for k, c in columns.items()])


def test_a_form_that_fails_is_alone(spark, tmp_path):
    history = checklist.history(spark, str(tmp_path / "history"))
    frames = {"good": _form(spark, "good", 5), "bad": _form(spark, "bad", 3, True), "short": _form(spark, "short", 2).drop("answer")}
    frames |= {"stray": _form(spark, "stray", 4), "spoilt stray": _form(spark, "x", 1, True).where("answer <> 'b'"), "none": _form(spark, "none", 0)}
    report, overall = checklist.append_forms(frames, history, ["bad", "good", "short", "none", "absent"], STAMP, at_once=2)
    got = {r.form: (r.n_rows, r.code, r.message) for r in report.collect()}
    assert overall == 207 and {f: v[:2] for f, v in got.items()} == {
        "good": (5, 200), "bad": (0, 500), "short": (0, 500), "none": (0, 204), "absent": (0, 204), "stray": (4, 404), "spoilt stray": (0, 404),
    }
    assert "no bad" in got["bad"][2] and "\n" not in got["bad"][2] and got["short"][2] == "missing: answer" and got["good"][2] is None
    assert [tuple(r) for r in history.read().groupBy("form").count().collect()] == [("good", 5)]
    _, nothing = checklist.append_forms({"bad": frames["bad"]}, history, ["bad"], STAMP)
    _, fine = checklist.append_forms({"good": frames["good"]}, history, ["good"], STAMP)
    assert (nothing, fine) == (500, 200)


def test_jobs_have_pools_of_their_own(spark):
    from lakeops.plans.pools import POOL, message_of, run_each

    pool = lambda: spark.sparkContext.getLocalProperty(POOL)
    assert run_each(spark, {"a": pool, "b": pool, "c": lambda: spark.range(7).count()}, 2) == {"a": "a", "b": "b", "c": 7}
    failed = run_each(spark, {"d": lambda: 1 / 0})["d"]
    assert isinstance(failed, ZeroDivisionError) and message_of(failed) == "division by zero" and pool() is None
    assert run_each(spark, {}) == {} and message_of(ValueError()) == "ValueError"


def test_null_tokens_are_rejected_as_keys(spark, tmp_path):
    columns = "ord int, num_recibo string, per_consumo string"
    landing = spark.createDataFrame([(1, "nan", "p"), (2, " NULL", "p"), (3, " ", "p"), (4, "A2", "p"), (5, "17", "p")], columns)
    for feed, stored in ((feeds.FREE_CLIENTS, 1), (feeds.WEB_BILLS, 2)):
        store = Table(spark, f"{tmp_path}/{stored}", feed.schema())
        rejects = Table(spark, f"{tmp_path}/{stored}r", loads.reject_schema(landing.schema))
        out = loads.run_feed(spark, landing, feed, store, rejects, STAMP)
        assert out["inserted"] == stored == store.read().count()
        assert rejects.read().where("_reason = 'untyped'").count() == 4 - stored


def test_lost_values_are_kept_once(spark, tmp_path):
    landing = spark.createDataFrame(
        [(1, "R-1", "p", "1,5", "x"), (2, "R-2", "p", " ", "2024-01-01"), (3, "R-3", None, "7", "NaN"), (4, "bad", "p", "1,5", "x")],
        "ord int, num_recibo string, per_consumo string, total_a_pagar string, fec_emision string",
    )
    store = Table(spark, str(tmp_path / "s"), feeds.BILLS.schema())
    rejects = Table(spark, str(tmp_path / "r"), loads.reject_schema(landing.schema))
    losses = Table(spark, str(tmp_path / "l"), loads.LOSSES)
    for stamp, n in ((STAMP, 2), (STAMP, 2), (datetime(2024, 2, 2), 4)):
        out = loads.run_feed(spark, landing, feeds.BILLS, store, rejects, stamp, losses=losses)
        assert out["lost"] == 2 and losses.read().count() == n
    got = {(r.clave, r.columna, r.valor) for r in losses.read().collect()}
    assert got == {("R-1", "total_a_pagar", "1,5"), ("R-1", "fec_emision", "x")}
    assert "lost" not in loads.run_feed(spark, landing, feeds.BILLS, store, rejects, STAMP)


def _joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("SortMergeJoin"), plan.count("BroadcastHashJoin")


def test_keys_of_a_large_batch_stay_off_the_driver(spark, monkeypatch):
    """A few columns of well compressed files look small to Spark, however many rows they have."""
    from lakeops.operators import skew

    target, staged = (written(spark.range(50).selectExpr(f"id + {first} AS k", "'x' AS v", "'u' AS creation_user"), "rows") for first in (0, 40))
    plans = [
        load.stored_like(target, staged, ["k"]), load.stored_like_few(target, staged, ["k"], most=2), load.insert_new(target, staged, ["k"]),
        load.applied(target, staged, ["k"], ["creation_user"]), load.applied_changed(target, staged, ["k"]), load.with_rest(target, staged, ["k"]),
    ]
    assert [p.count() for p in plans] == [10, 10, 40, 50, 50, 90]
    assert all(_joins(p)[0] and not _joins(p)[1] for p in plans)
    assert _joins(load.insert_new(target, staged, ["k"], few=True)) == (0, 2)
    assert _joins(load.insert_new(target, staged, ["k"], few=True, reduced=True)) == (0, 1)
    facts = skew.write_facts(staged.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "n")
    assert facts.keys == 50 and _joins(skew.attach_facts(target, facts, ["k"], spread_by=["v"])) == (0, 1)
    monkeypatch.setattr(skew, "MOST_BROADCAST", 49)
    assert _joins(skew.attach_facts(target, facts, ["k"], spread_by=["v"])) == (1, 0)


def test_a_large_feed_loads_as_a_small_one(spark, bills, stores, monkeypatch):
    from lakeops import session

    for most in (session.MOST_BROADCAST, 0):
        monkeypatch.setattr(session, "MOST_BROADCAST", most)
        (store, rejects), rows = stores(feeds.FREE_CLIENTS), []
        store = Table(spark, f"{store.path}-{most}", store.schema, partition_by=["per_consumo"])
        typed = bills.withColumn("num_recibo", F.regexp_replace("num_recibo", "R-", ""))
        for part in ("ord % 3 <> 0", "ord % 3 <> 1"):
            out = loads.run_feed(spark, typed.where(part), feeds.FREE_CLIENTS, store, None, STAMP)
            rows.append((out["inserted"], out["updated"], store.read().count(), store.read().select("num_recibo", "per_consumo").distinct().count()))
        if most:
            first = rows
    assert first == rows and rows[1][0] > 0


def test_updates_of_a_large_table_are_not_broadcast(spark, tmp_path, monkeypatch):
    from lakeops.sources import tables

    store = Table(spark, str(tmp_path / "t"), "k long, v string", key=["k"])
    store.replace(spark.range(100).selectExpr("id AS k", "'old' AS v"))
    store.upsert(spark.range(90, 110).selectExpr("id AS k", "'new' AS v"))
    assert _joins(store.read()) == (0, 1)
    monkeypatch.setattr(tables, "MOST_BYTES", 0)
    assert _joins(store.read()) == (1, 0) and store.read().where("v = 'new'").count() == 20 and store.read().count() == 110
