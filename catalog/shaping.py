"""Header matching, target alignment, forms, the union view and table scans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from catalog.registry import derive, duck, query, table
from lakeops.functions.text import header_key
from lakeops.operators import forms, schema
from lakeops.plans.serving import union_view
from lakeops.sources.tables import run_query, scan

_HEADERS = {
    "c_custkey": "Código Cliente", "c_name": " Nombre ", "c_nationkey": "PAÍS-id", "c_acctbal": "Saldo S/.",
    "c_mktsegment": "otro",
}


def _spreadsheet(spark, sf):
    """Customers under spreadsheet headers."""
    return table(spark, sf, "customer").withColumnsRenamed(_HEADERS)


@query("map_columns", "SELECT c_custkey AS codigo, c_name AS nombre, c_acctbal AS saldo FROM customer")
def map_columns(spark, sf):
    mapping = {"saldo": "Saldo S/.", "codigo": "código cliente ", "nombre": "NOMBRE", "fax": "Fax"}
    return schema.map_columns(_spreadsheet(spark, sf), mapping)


@query("flexible_mapping", "SELECT c_custkey AS codigo, c_name AS nombre, c_nationkey AS pais FROM customer")
def flexible_mapping(spark, sf):
    sheet = _spreadsheet(spark, sf)
    wanted = {"codigo": "codigo_cliente", "nombre": "Nombre", "pais": "pais id", "fax": "Fax"}
    found = schema.flexible_mapping(wanted, sheet.columns)
    return sheet.select(*[F.col(f"`{header}`").alias(target) for target, header in found.items()])


@query("strict_mapping", "SELECT c_acctbal AS saldo, c_custkey AS codigo FROM customer")
def strict_mapping(spark, sf):
    return schema.strict_mapping(_spreadsheet(spark, sf), {"saldo": "Saldo S/.", "codigo": "Código Cliente"})


@query(
    "align_to_target",
    "SELECT CAST(NULL AS VARCHAR) AS fax, c_name AS \"C_Name\", c_custkey AS c_custkey, CAST(NULL AS DOUBLE) AS saldo FROM customer",
)
def align_to_target(spark, sf):
    target = StructType.fromDDL("fax string, C_Name string, c_custkey bigint, saldo double")
    return schema.align_to_target(table(spark, sf, "customer"), target)


@query("stamp_batch", "SELECT s_suppkey, s_name, '2024-01-31 05:00:00' AS fechacarga FROM supplier")
def stamp_batch(spark, sf):
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return schema.stamp_batch(rows, ["s_suppkey", "s_name", "fechacarga"], datetime(2024, 1, 31, 5))


_TITLES = """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN ' Código - ' || p_name WHEN 1 THEN 'FECHA  EMISIÓN (' || p_brand || ')'
  WHEN 2 THEN 'año/' || p_type || 'ü' ELSE NULL END AS header FROM {part}
"""


@query(
    "normalize_headers",
    "SELECT p_partkey, header, coalesce(regexp_replace(regexp_replace(translate(lower(trim(header)), 'áéíóúñ', 'aeioun'), "
    f"'[-\\s]+', '_', 'g'), '[^a-z0-9_]+', '', 'g'), '') AS name FROM ({duck(_TITLES)})",
)
def normalize_headers(spark, sf):
    return derive(spark, sf, _TITLES).select("p_partkey", "header", header_key(F.col("header")).alias("name"))


# One sheet per part: code, period, brand, price, size and a date at fixed cells.
_CELLS = """
SELECT sheet, cell, value FROM (
  SELECT cast(p_partkey as string) AS sheet, 'A6' AS cell, cast(p_partkey as string) || '.0' AS value FROM {part}
  UNION ALL SELECT cast(p_partkey as string), 'A7', CASE p_partkey % 3 WHEN 0 THEN 'Setiembre 2024' WHEN 1 THEN '03/2024' ELSE 'sin fecha' END FROM {part}
  UNION ALL SELECT cast(p_partkey as string), 'B2', ' ' || p_brand FROM {part}
  UNION ALL SELECT cast(p_partkey as string), 'AX10', replace(cast(cast(p_retailprice as decimal(18,2)) as string), '.', ',') FROM {part}
  UNION ALL SELECT cast(p_partkey as string), 'AX11', CASE WHEN p_size % 5 = 0 THEN 'n.d.' ELSE cast(p_size as string) || '.7' END FROM {part}
  UNION ALL SELECT cast(p_partkey as string), 'C9', '5/3/2024' FROM {part}
  UNION ALL SELECT cast(p_partkey as string), 'Z99', p_name FROM {part})
"""
_FIELDS = {
    "num_recibo": {"type": "str", "const": ""},
    "cod_suministro": {"type": "int", "cell": "A6"},
    "per_consumo": {"type": "str", "cell": "A7"},
    "tarifa": {"type": "str", "const": "CL"},
    "marca": {"type": "str", "cell": "B2"},
    "precio": {"type": "decimal", "cell": "AX10"},
    "piezas": {"type": "int", "cell": "AX11"},
    "emitido": {"type": "date", "cell": "C9"},
    "vacio": {"type": "decimal", "const": None},
}


@query(
    "forms_to_records",
    "SELECT CAST(p_partkey AS VARCHAR) AS sheet, CAST(NULL AS VARCHAR) AS num_recibo, p_partkey AS cod_suministro, "
    "CASE p_partkey % 3 WHEN 0 THEN 'Setiembre 2024' WHEN 1 THEN '03/2024' ELSE 'sin fecha' END AS per_consumo, "
    "'CL' AS tarifa, p_brand AS marca, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS precio, "
    "CASE WHEN p_size % 5 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(p_size AS BIGINT) END AS piezas, "
    "'2024-03-05' AS emitido, CAST(0 AS DOUBLE) AS vacio FROM part",
)
def forms_to_records(spark, sf):
    return forms.forms_to_records(derive(spark, sf, _CELLS), _FIELDS)


@query(
    "form_receipts",
    "SELECT CAST(p_partkey AS VARCHAR) AS cod_suministro, CASE p_partkey % 3 WHEN 0 THEN '202409' || CAST(p_partkey AS VARCHAR) "
    "WHEN 1 THEN '202403' || CAST(p_partkey AS VARCHAR) END AS num_recibo FROM part",
)
def form_receipts(spark, sf):
    records = forms.forms_to_records(derive(spark, sf, _CELLS), _FIELDS)
    return forms.number_receipts(records).select("cod_suministro", "num_recibo")


@query(
    "form_fanout_summary",
    "SELECT form, coalesce(n, 0) AS n_rows, CASE WHEN n > 0 THEN 200 ELSE 204 END AS code FROM "
    "(SELECT DISTINCT event_type || s AS form FROM events, (VALUES (''), (' extra')) v(s)) "
    "LEFT JOIN (SELECT event_type AS form, count(*) AS n FROM events GROUP BY 1) USING (form)",
)
def form_fanout_summary(spark, sf):
    answers = table(spark, sf, "events").select(F.col("event_type").alias("form"))
    kinds = answers.distinct()
    expected = kinds.union(kinds.select(F.concat("form", F.lit(" extra"))))
    return forms.fanout_status(answers, expected)


_BILL_STORES = {
    "web": "SELECT cast(o_orderkey as string) AS num_recibo, cast(o_custkey as string) AS cod_suministro, o_orderdate AS ts, "
    "cast(o_totalprice as decimal(18,2)) AS total FROM {orders}",
    "market": "SELECT 'L' || cast(l_orderkey as string) AS num_recibo, cast(l_suppkey as string) AS cod_suministro, l_shipdate AS ts, "
    "cast(l_extendedprice as decimal(18,2)) AS total FROM {lineitem}",
    "clients": "SELECT c_name AS num_recibo, cast(c_custkey as string) AS cod_suministro, cast(c_acctbal as decimal(18,2)) AS total FROM {customer}",
    "landing": "SELECT s_name AS num_recibo, cast(s_acctbal as decimal(18,2)) AS total FROM {supplier}",
}


@query(
    "bills_union",
    " UNION ALL ".join(
        f"SELECT num_recibo, {'cod_suministro' if 'cod_suministro' in recipe else 'CAST(NULL AS VARCHAR)'} AS cod_suministro, "
        f"{'CAST(CAST(ts AS DATE) AS VARCHAR)' if 'AS ts' in recipe else 'CAST(NULL AS VARCHAR)'} AS fec_emision, "
        f"CAST(total AS VARCHAR) AS total_a_pagar, CAST(NULL AS VARCHAR) AS creation_user, '{label}' AS tabla_origen FROM ({duck(recipe)})"
        for label, recipe in _BILL_STORES.items()
    ),
)
def bills_union(spark, sf):
    """Four stores with different columns behind one text view."""
    stores = {}
    for label, recipe in _BILL_STORES.items():
        store = derive(spark, sf, recipe).withColumnRenamed("total", "total_a_pagar")
        if "ts" in store.columns:
            store = store.withColumn("fec_emision", F.to_date("ts")).drop("ts")
        stores[label] = store
    view = union_view(stores)
    return view.select("num_recibo", "cod_suministro", "fec_emision", "total_a_pagar", "creation_user", "tabla_origen")


@query(
    "scan_project_filter",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000",
)
def scan_project_filter(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("scan_orders")
    return scan(spark, "scan_orders", ["o_orderkey", "o_totalprice"], "o_orderstatus = 'F' AND o_totalprice > 100000")


@query(
    "scan_top",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
)
def scan_top(spark, sf):
    """A limited scan of an ordered view."""
    rows = table(spark, sf, "orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    rows.createOrReplaceTempView("scan_ordered")
    return scan(spark, "scan_ordered", ["o_orderkey", "o_totalprice"], limit=25)


@query(
    "query_source",
    "SELECT o_orderpriority, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders "
    "WHERE o_orderdate >= '1997-01-01' GROUP BY 1",
)
def query_source(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("query_orders")
    text = (
        "SELECT o_orderpriority, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM query_orders "
        "WHERE o_orderdate >= :since GROUP BY o_orderpriority"
    )
    return run_query(spark, text, since="1997-01-01")
