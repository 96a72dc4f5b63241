from datetime import datetime

import pytest
from pyspark.sql.types import StructType

from lakeops.operators import forms, schema


@pytest.fixture
def sheet(spark):
    return spark.createDataFrame([(1, "a", 1.5), (2, "b", 2.5), (3, "c", 3.5)], "`Columna A` int, `Columna B` string, `Columna C` double")


def test_map_columns_keeps_source_order_and_types(sheet):
    out = schema.map_columns(sheet, {"c": "Columna C", "a": "Columna A"})
    assert out.dtypes == [("a", "int"), ("c", "double")]
    assert out.count() == 3


@pytest.mark.parametrize("header", ["columna a", "COLUMNA A", "  Columna A  "])
def test_map_columns_ignores_case_and_blanks(sheet, header):
    assert schema.map_columns(sheet, {"a": header}).columns == ["a"]


def test_map_columns_trims_source(spark):
    assert schema.map_columns(spark.createDataFrame([(1,)], "` Columna A ` int"), {"a": "Columna A"}).columns == ["a"]


def test_map_columns_partial_and_none(sheet):
    assert schema.map_columns(sheet, {"a": "Columna A", "x": "Otra"}).columns == ["a"]
    with pytest.raises(schema.SchemaMismatch):
        schema.map_columns(sheet, {"x": "Otra"})


def test_map_columns_first_entry_wins_ignoring_case(sheet):
    assert schema.map_columns(sheet, {"first": "COLUMNA A", "second": "columna a"}).columns == ["first"]


def test_map_columns_empty_frame(sheet):
    out = schema.map_columns(sheet.limit(0), {"a": "Columna A"})
    assert out.columns == ["a"] and out.isEmpty()


def test_flexible_mapping():
    headers = ["Código Suministro", "Fecha"]
    assert schema.flexible_mapping({"c": "Código Suministro"}, headers) == {"c": "Código Suministro"}
    assert schema.flexible_mapping({"c": "codigo suministro", "z": "zona"}, headers) == {"c": "Código Suministro"}


def test_strict_mapping(sheet):
    out = schema.strict_mapping(sheet, {"b": "Columna B", "a": "Columna A"})
    assert out.columns == ["b", "a"]
    assert schema.strict_mapping(sheet, {"b": "Columna B", "z": "Columna Z"}) is None
    assert schema.strict_mapping(sheet, {"z": "Columna Z"}) is None
    assert schema.strict_mapping(sheet.limit(0), {"a": "Columna A"}).isEmpty()


def test_align_to_target(spark):
    target = StructType.fromDDL("id int, name string, note string")
    rows = spark.createDataFrame([(1, "a", 9)], "ID int, NAME string, extra int")
    out = schema.align_to_target(rows, target)
    assert out.columns == ["id", "name", "note"] and tuple(out.first()) == (1, "a", None)
    assert schema.align_to_target(rows, target, fill_missing=False).columns == ["id", "name"]
    with pytest.raises(schema.SchemaMismatch):
        schema.align_to_target(rows.select("extra"), target)


def test_schema_diff(sheet):
    mapping = {"a": "Columna A"}
    found = {tuple(r) for r in schema.schema_diff(sheet, ["a", "z"], mapping).collect()}
    assert found == {("Columna B", "extra"), ("Columna C", "extra"), ("z", "missing")}
    with pytest.raises(schema.SchemaMismatch, match="z"):
        schema.schema_diff(sheet, ["a", "z"], mapping, strict=True)


def test_stamp_batch(sheet):
    stamp = datetime(2024, 1, 2, 3, 4, 5)
    assert "fechacarga" not in schema.stamp_batch(sheet, ["a"], stamp).columns
    assert {r.fechacarga for r in schema.stamp_batch(sheet, ["a", "FechaCarga"], stamp).collect()} == {stamp}


def test_forms(spark):
    cells = [("s1", "A6", "123.0"), ("s1", "A7", "Setiembre 2024"), ("s1", "B1", "1.234,5"), ("s2", "A6", "x"), ("s3", "A6", "9")]
    fields = {
        "num_recibo": {"type": "str", "const": ""}, "cod_suministro": {"type": "str", "cell": "A6"},
        "per_consumo": {"type": "str", "cell": "A7"}, "monto": {"type": "decimal", "cell": "B1"},
        "emision": {"type": "date", "const": None},
    }
    rows = forms.forms_to_records(spark.createDataFrame(cells, "sheet string, cell string, value string"), fields, ["s1", "s2", "gone"])
    got = {r.sheet: r for r in forms.number_receipts(rows).collect()}
    assert set(got) == {"s1", "s2"}
    assert got["s1"].num_recibo == "202409123" and got["s1"].monto == 1.2345
    assert got["s2"].num_recibo is None and got["s2"].cod_suministro is None and got["s2"].monto == 0.0


def test_overall_status():
    assert [forms.overall_status(*p) for p in ((0, 3), (1, 2), (3, 0))] == [200, 207, 500]
