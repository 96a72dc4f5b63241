import csv
import io
import os
import zipfile
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.plans.exports import manual_load
from lakeops.sources import files, records
from lakeops.sources.tables import Table, export_csv


def _file(folder, name, text, mtime=None):
    path = folder / name
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    if mtime:
        os.utime(path, (mtime, mtime))
    return str(path)


@pytest.fixture
def folder(tmp_path):
    _file(tmp_path, "consumo-PD-202401.xlsx", "a", 1000)
    _file(tmp_path, "consumo-PD-202401v2.XLSX", "b", 2000)
    _file(tmp_path, "consumo-PD-202402.xlsx", "c", 3000)
    _file(tmp_path, "consumo-PD-202401.csv", "d", 4000)
    _file(tmp_path, "Export Campo final.xlsx", "e", 5000)
    _file(tmp_path, "pagos_202401.xlsx", "f", 6000)
    _file(tmp_path, "libres-0124(e).xlsx", "g", 7000)
    return str(tmp_path)


def test_selection(spark, folder):
    listed, as_of = files.list_files(spark, folder), F.lit(date(2024, 2, 10))
    assert listed.count() == 7
    name = lambda df: df.first()["name"]
    assert name(files.newest_for_period(listed, "consumo-PD", as_of, ext="xlsx")) == "consumo-PD-202401v2.XLSX"
    assert name(files.newest_for_period(listed, "consumo-PD", as_of)) == "consumo-PD-202401.csv"
    assert name(files.newest_for_period(listed, "consumo", as_of, F.lit("202402"))) == "consumo-PD-202402.xlsx"
    assert name(files.newest_containing(listed, "campo")) == "Export Campo final.xlsx"
    assert name(files.exact_file(listed, files.period_file_name("pagos", as_of))) == "pagos_202401.xlsx"
    assert name(files.exact_file(listed, files.short_period_file_name("libres", as_of))) == "libres-0124(e).xlsx"
    assert files.path_of(files.newest_containing(listed, "campo")).endswith("final.xlsx")
    with pytest.raises(FileNotFoundError):
        files.path_of(files.newest_containing(listed, "nothing"))


def test_listing_reads_no_content(spark, folder):
    plan = files.list_files(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_preamble_is_skipped_once_per_file_even_when_split(spark, tmp_path):
    for n in range(3):
        body = "".join(f'{n * 1000 + i},"a, b {i}"\n' for i in range(1000))
        _file(tmp_path, f"f{n}.csv", f"title {n}\n\nid,note\n{body}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 2000)
    try:
        rows = files.read_delimited(spark, str(tmp_path), skip=2)
        assert rows.rdd.getNumPartitions() > 6
        got = rows.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(int(r.id) for r in got) == list(range(3000))
    assert {r.note for r in got} == {f"a, b {i}" for i in range(1000)}
    assert {r.archivo for r in got} == {"f0.csv", "f1.csv", "f2.csv"}


@pytest.mark.parametrize("skip", [0, 1])
def test_delimited_needs_one_header(spark, tmp_path, skip):
    _file(tmp_path, "a.csv", "title\n" * skip + "x,y\n1,2\n")
    assert files.read_delimited(spark, str(tmp_path), skip).count() == 1
    _file(tmp_path, "b.csv", "title\n" * skip + "x,z\n1,2\n")
    with pytest.raises(Exception, match="header"):
        files.read_delimited(spark, str(tmp_path), skip).collect()


def test_no_file_and_no_header(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_delimited(spark, str(tmp_path))
    _file(tmp_path, "a.csv", "only a title\n")
    with pytest.raises(ValueError, match="no header"):
        files.read_delimited(spark, str(tmp_path), skip=3)


@pytest.mark.parametrize("skip", [0, 1])
def test_byte_order_mark(spark, tmp_path, skip):
    path = _file(tmp_path, "a.csv", "\ufeff" + "title\n" * skip + "x,y\n1,2\n")
    rows = files.read_delimited(spark, path, skip)
    assert rows.columns == ["x", "y", "archivo"]
    assert [tuple(r)[:2] for r in rows.collect()] == [("1", "2")]


def test_missing_sheet_names_the_others(spark, tmp_path):
    path = _file(tmp_path, "w.csv", "x\n1\n")
    assert files.read_workbooks(spark, path, ["x"], sheet="0", parse=files.parse_csv).count() == 1
    with pytest.raises(Exception, match="sheet 'Hoja9' not found in w.csv; it has: 0"):
        files.read_workbooks(spark, path, ["x"], sheet="Hoja9", parse=files.parse_csv).collect()


def test_form_cells(spark, tmp_path):
    path = _file(tmp_path, "form.csv", "a,b\n,c\n")
    cells = files.read_form_cells(spark, path, parse=files.parse_csv)
    got = {(r.cell, r.value) for r in cells.collect() if r.value}
    assert got == {("A1", "a"), ("B1", "b"), ("B2", "c")}


def _zip(**members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for name, text in members.items():
            archive.writestr(name.replace("_", "."), text)
    return buffer.getvalue()


def test_archives(spark, tmp_path):
    _file(tmp_path, "one.zip", _zip(a_csv="id,v\n1,x\n", b_csv="v,id\ny,2\n", readme_txt="no"))
    rows = files.read_archives(spark, str(tmp_path), ["id", "v"], parse=files.parse_csv, suffixes=(".csv",))
    assert {(r.id, r.v, r.archivo) for r in rows.collect()} == {("1", "x", "a.csv"), ("2", "y", "b.csv")}


@pytest.mark.parametrize("content", [_zip(readme_txt="no"), b"not a zip"])
def test_bad_archive_fails(spark, tmp_path, content):
    _file(tmp_path, "bad.zip", content)
    with pytest.raises(Exception):  # noqa: B017
        files.read_archives(spark, str(tmp_path), ["id"], parse=files.parse_csv, suffixes=(".csv",)).collect()


def test_consolidate(spark, tmp_path):
    _file(tmp_path, "a.csv", "skip\nRecibo,Total\nr1,1\n,2\n")
    _file(tmp_path, "b.csv", "skip\nTotal,Otro,Recibo\n3,x,r2\n")
    _file(tmp_path, "c.csv", "skip\nRecibo\nr3\n")
    mapping = {"recibo": "Recibo", "total_pagado": "Total", "archivo": "archivo"}
    rows, verdicts = files.consolidate(spark, str(tmp_path), mapping, "Recibo", skip=1)
    assert sorted(tuple(r) for r in rows.collect()) == [("r1", "1", "a.csv"), ("r2", "3", "b.csv")]
    got = {r.path.rsplit("/", 1)[-1]: (r.accepted, r.missing) for r in verdicts.collect()}
    assert got == {"a.csv": (True, ""), "b.csv": (True, ""), "c.csv": (False, "Total")}
    nothing, _ = files.consolidate(spark, str(tmp_path), {"z": "Z"}, "Recibo", skip=1)
    assert nothing is None


def test_payload_kinds(spark, tmp_path):
    _file(tmp_path, "ok.xlsx", _zip(a_txt="1"))
    _file(tmp_path, "login.xlsx", "<!DOCTYPE html>" + " " * 200)
    got = {r.path.rsplit("/", 1)[-1]: r.kind for r in files.payload_kinds(spark, str(tmp_path)).collect()}
    assert got == {"ok.xlsx": "zip", "login.xlsx": "html"}


def test_manual_load(spark, tmp_path):
    path = _file(tmp_path, "in.csv", "Id,Nombre,x\n1,a,9\n2,b,9\n")
    table = Table(spark, str(tmp_path / "t"), "id string, nombre string, nota string")
    out = manual_load(spark, path, table, mapping={"id": "Id", "nombre": "nombre"}, then=lambda: {"inserted": 2})
    assert out["code"] == 200 and out["then"] == {"inserted": 2}
    assert sorted(tuple(r) for r in table.read().collect()) == [("1", "a", None), ("2", "b", None)]
    with pytest.raises(ValueError, match="unsupported format"):
        manual_load(spark, _file(tmp_path, "in.pdf", "x"), table)


def test_export_shows_local_time(spark, tmp_path):
    rows = spark.sql("SELECT TIMESTAMP '2024-01-01 03:00:00Z' AS at, TIMESTAMP_NTZ '2024-01-01 03:00:00' AS plain")
    path = export_csv(rows, str(tmp_path / "e"))
    row = spark.read.option("header", True).csv(path).first()
    assert row["at"].startswith("2023-12-31T22:00") and row["plain"].startswith("2024-01-01T03:00")
    with pytest.raises(Exception, match="exists"):
        export_csv(rows, path, overwrite=False)


def test_headers_need_no_scan(spark, tmp_path):
    """Only paths come from the listing; a task opens the files and reads their beginnings."""
    for k in range(3):
        body = "\n".join(["x" * 70_000, "second", f"id,n{k}", *(f"{i},{i}" for i in range(100_000))])
        (tmp_path / f"f {k}.csv").write_text(body)
    found = files.headers_of(spark, str(tmp_path), skip=2)
    assert sorted(r.headers for r in found.collect()) == [["id", "n0"], ["id", "n1"], ["id", "n2"]]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    assert files.headers_of(spark, str(tmp_path), skip=200_000).collect() == []


def test_rows_with_too_many_fields(spark, tmp_path):
    """They fail the scan by name of the file, or are kept whole; quoted line breaks need one piece."""
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text('a,b\n1,x\n2,y,EXTRA\n3\n')
    with pytest.raises(Exception, match="more fields than the header in .*x.csv"):
        files.read_delimited(spark, str(tmp_path / "a")).collect()
    kept = files.read_delimited(spark, str(tmp_path / "a"), ragged="keep").select("a", "b", files.RAGGED).collect()
    assert sorted(map(tuple, kept)) == [("1", "x", None), ("2", "y", "2,y,EXTRA"), ("3", None, None)]
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "x.csv").write_text('preamble\na,b\n1,x\n2,y,EXTRA\n')
    with pytest.raises(Exception, match="more fields than the header in .*x.csv"):
        files.read_delimited(spark, str(tmp_path / "p"), skip=1).collect()
    kept = files.read_delimited(spark, str(tmp_path / "p"), skip=1, ragged="keep").select("a", files.RAGGED).collect()
    assert sorted(map(tuple, kept)) == [("1", None), ("2", "2,y,EXTRA")]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "x.csv").write_text('a,b\n1,"line1\nline2"\n2,z\n')
    whole = files.read_delimited(spark, str(tmp_path / "m"), multiline=True).select("a", "b").collect()
    assert sorted(map(tuple, whole)) == [("1", "line1\nline2"), ("2", "z")]


def test_export_begins_with_a_mark(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'say "hi", é'), (2, "two\nlines")], "id int, note string").repartition(2, "id")
    marked, bare = export_csv(rows, str(tmp_path / "m")), export_csv(rows, str(tmp_path / "b"), mark=False)
    heads = lambda folder: {f.read_bytes()[:5] for f in (tmp_path / folder).glob("*.csv")}
    assert heads("m") == {b"\xef\xbb\xbfid"} and heads("b") == {b"id,no"}
    for path in (marked, bare):
        back = files.read_delimited(spark, path, multiline=True).drop("archivo").collect()
        assert sorted(map(tuple, back)) == [("1", 'say "hi", é'), ("2", "two\nlines")]


# --- quoted fields over line breaks -------------------------------------------------------------


def small_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)


@pytest.fixture
def splits(spark):
    yield lambda size: small_splits(spark, size)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _cells(rng, n, sep):
    picks = ["", "a", "é☃", "b c", "line1\nline2", "x\n\ny", 'say ""', '"', '""', "\n", f"in{sep}side", "long " * 30 + "\n" + "text " * 30, '5" pipe', "\r\n"]
    return [picks[k] for k in rng.integers(0, len(picks), n)]


@pytest.mark.parametrize("seed, sep, skip", [(1, ",", 0), (2, ";", 2), (3, ",", 1), (4, "\t", 3)])
def test_quoted_line_breaks_in_splits(spark, tmp_path, splits, seed, sep, skip):
    """Whatever the splits, the rows are those of a reader that goes through a file from its beginning."""
    rng, want = np.random.default_rng(seed), []
    for f in range(3):
        text = io.StringIO(newline="")
        text.write("".join(f'preamble "{k}\n' for k in range(skip)))
        writer = csv.writer(text, delimiter=sep, lineterminator="\n")
        writer.writerow(["id", "no\nte", "more"])
        for i in range(150):
            row = [f"{f}-{i}", *_cells(rng, 2, sep)]
            writer.writerow(row)
            want.append(tuple(None if c == "" else c for c in row))
        _file(tmp_path, f"f{f}.csv", text.getvalue())
    for size in (300, 2000, 1 << 20):
        splits(size)
        rows = files.read_delimited(spark, str(tmp_path), skip, sep, multiline=True)
        assert rows.columns == ["id", "no\nte", "more", "archivo"]
        assert sorted(map(tuple, rows.drop("archivo").collect()), key=str) == sorted(want, key=str)


def test_many_splits_inside_one_record(spark, tmp_path, splits, monkeypatch):
    long = "\n".join(f"line {k}" for k in range(400))
    path = _file(tmp_path, "a.csv", f'title\nid,note\n1,"{long}"\n2,"b"\n3,"{long}\n"\n')
    splits(256)
    want = [("1", long), ("2", "b"), ("3", long + "\n")]
    assert sorted(map(tuple, files.read_delimited(spark, path, 1, multiline=True).drop("archivo").collect())) == want
    found = records.records(spark, path, 1, most_broadcast=0)  # lines go to the splits instead
    assert found.count() == 4 and found.where("first").count() == 1
    assert found.where(F.col("line").startswith("3,")).first()["line"] == f'3,"{long}\n"'


def test_unclosed_quotes_fail(spark, tmp_path, splits):
    path = _file(tmp_path, "a.csv", "title\nid,note\n" + '1,"x\n' + "2,y\n" * 500)
    splits(256)
    with pytest.raises(ValueError, match="not closed in .*a.csv"):
        files.read_delimited(spark, path, 1, multiline=True)


def test_no_record_is_torn_in_silence(spark, tmp_path):
    path = _file(tmp_path, "a.csv", 'title "x\nid,note\n1,"a\nb"\n2,c\n')
    with pytest.raises(Exception, match="a quoted field spans lines in .*a.csv"):
        files.read_delimited(spark, path, 1).collect()
    rows = files.read_delimited(spark, path, 1, multiline=True).drop("archivo").collect()
    assert sorted(map(tuple, rows)) == [("1", "a\nb"), ("2", "c")]


@pytest.mark.parametrize(
    "line, closed, opened",
    [("a,b", False, True), ('a,"b', True, False), ('a,"b"', False, False), ('x",y', False, False), ('x","y', True, True),
     ('5" pipe,z', False, False), ('"a""b",c', False, False), ('""', False, True), ('"', True, False), ("", False, True),
     ('a,"b""', True, False), ('x"tail,"y"', False, False)],
)
def test_ends_open(line, closed, opened):
    assert (records.ends_open(line, False, ","), records.ends_open(line, True, ",")) == (closed, opened)


def test_consolidate_is_one_scan(spark, tmp_path, splits):
    """However many headers there are; and a row that is wider than its own header fails."""
    want = []
    for k in range(6):
        columns = ["Recibo", "Total"] if k % 2 else [f"x{k}"] * 0 + [f"x{j}" for j in range(k)] + ["Total", "Recibo"]
        body = "".join(",".join(f'"t\n{k}-{i}"' if c == "Total" else f"r{k}-{i}" if c == "Recibo" else "o" for c in columns) + "\n" for i in range(40))
        _file(tmp_path, f"f{k}.csv", "skip\n" + ",".join(columns) + "\n" + body)
        want += [(f"r{k}-{i}", f"t\n{k}-{i}", f"f{k}.csv") for i in range(40)]
    splits(200)
    mapping = {"recibo": "Recibo", "total": "Total", "archivo": "archivo"}
    rows, verdicts = files.consolidate(spark, str(tmp_path), mapping, "Recibo", skip=1, multiline=True)
    assert sorted(map(tuple, rows.collect())) == sorted(want) and verdicts.count() == 6
    plain, _ = files.consolidate(spark, str(tmp_path), mapping, "Recibo", skip=1)
    assert plain._jdf.queryExecution().executedPlan().toString().count("Scan text") == 1
    wide = tmp_path / "wide"
    wide.mkdir()
    _file(wide, "a.csv", "skip\nRecibo,Total\n1,2,3\n")
    _file(wide, "b.csv", "skip\nRecibo,Total,c,d\n1,2,3,4\n")
    rows, _ = files.consolidate(spark, str(wide), mapping, "Recibo", skip=1)
    with pytest.raises(Exception, match="more fields than the header in .*a.csv"):
        rows.collect()


def test_payload_kinds_read_beginnings(spark, tmp_path):
    _file(tmp_path, "big.html", "<html>" + "x" * 3_000_000)
    found = files.payload_kinds(spark, str(tmp_path))
    assert [r.kind for r in found.collect()] == ["html"]
    assert files._beginning(str(tmp_path / "big.html")) == b"<html>" + b"x" * 494
