"""File selection and scans, over files that Spark writes from the given tables."""

from __future__ import annotations

import io
import zipfile
from datetime import date

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.registry import derive, duck, query, table
from lakeops.session import scratch_path
from lakeops.sources import files
from lakeops.sources.tables import export_csv

# --- selection -------------------------------------------------------------------------------------

_LISTING = """
SELECT 'reporte-consumo-' || o_orderstatus || '-' || cast(year(o_orderdate) * 100 + month(o_orderdate) as string) || 'v' ||
  cast(o_orderkey as string) || CASE o_orderkey % 3 WHEN 0 THEN '.XLSX' WHEN 1 THEN '.csv' ELSE '.xlsx' END AS name,
  o_orderdate + (o_orderkey % 1000) * interval '1' minute AS modified
FROM {orders}
UNION ALL
SELECT 'recibos_' || cast(year(o_orderdate) * 100 + month(o_orderdate) as string) || '.xlsx', min(o_orderdate) FROM {orders} GROUP BY 1
UNION ALL
SELECT 'libres-' || lpad(cast(month(o_orderdate) as string), 2, '0') || substring(cast(year(o_orderdate) as string), 3, 2) || '(e).xlsx',
  min(o_orderdate) FROM {orders} GROUP BY 1
"""
_AS_OF = date(1998, 3, 14)


def _listing(spark, sf):
    rows = derive(spark, sf, _LISTING)
    return rows.select(F.col("name").alias("path"), "name", F.col("modified").cast("timestamp_ntz").alias("modified"))


_NEWEST = "ORDER BY modified DESC, name DESC LIMIT 1"


@query(
    "newest_file",
    f"SELECT name, CAST(modified AS VARCHAR) AS modified FROM ({duck(_LISTING)}) WHERE starts_with(name, 'reporte-consumo-F') "
    f"AND contains(name, '199802') AND lower(split_part(name, '.', -1)) = 'xlsx' {_NEWEST}",
)
def newest_file(spark, sf):
    found = files.newest_for_period(_listing(spark, sf), "reporte-consumo-F", F.lit(_AS_OF), ext="xlsx")
    return found.select("name", "modified")


@query(
    "newest_file_per_group",
    f"SELECT ext, name, CAST(modified AS VARCHAR) AS modified FROM (SELECT *, lower(split_part(name, '.', -1)) AS ext FROM ({duck(_LISTING)})) "
    "QUALIFY row_number() OVER (PARTITION BY ext ORDER BY modified DESC, name DESC) = 1",
)
def newest_file_per_group(spark, sf):
    listed = _listing(spark, sf).withColumn("ext", files.extension(F.col("name")))
    return files.newest(listed, by=["ext"]).select("ext", "name", "modified")


@query(
    "period_file",
    f"SELECT name, CAST(modified AS VARCHAR) AS modified FROM ({duck(_LISTING)}) WHERE name IN ('recibos_199802.xlsx', 'libres-0298(e).xlsx')",
)
def period_file(spark, sf):
    listed, as_of = _listing(spark, sf), F.lit(_AS_OF)
    full = files.exact_file(listed, files.period_file_name("recibos", as_of))
    short = files.exact_file(listed, files.short_period_file_name("libres", as_of))
    return full.unionByName(short).select("name", "modified")


@query(
    "newest_containing",
    f"SELECT name, CAST(modified AS VARCHAR) AS modified FROM ({duck(_LISTING)}) WHERE contains(upper(name), 'CONSUMO-P') "
    f"AND lower(name) LIKE '%.xlsx' {_NEWEST}",
)
def newest_containing(spark, sf):
    return files.newest_containing(_listing(spark, sf), "consumo-P").select("name", "modified")


# --- scans ---------------------------------------------------------------------------------------


def _spread(rows, key):
    """As many files as the session has shuffle partitions."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _csv_folder(rows, label, preamble=()):
    """Write rows as headed CSV files, each after ``preamble`` lines."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    if not preamble:
        rows.write.option("header", True).csv(path)
        return path
    header = ",".join(rows.columns)
    body = rows.select(F.to_csv(F.struct(*rows.columns)).alias("value"))

    def headed(batches):
        first = True
        for batch in batches:
            if first:
                yield pd.DataFrame({"value": [*preamble, header]})
                first = False
            yield batch

    body.mapInPandas(headed, "value string").write.text(path)
    return path


@query("delimited_scan", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier")
def delimited_scan(spark, sf):
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return files.read_delimited(spark, _csv_folder(rows, "plain")).drop("archivo")


@query(
    "delimited_preamble",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders",
)
def delimited_preamble(spark, sf):
    """Three preamble lines in each of several files."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    path = _csv_folder(_spread(rows, "o_orderkey"), "preamble", ("Report", "", "made, by hand"))
    return files.read_delimited(spark, path, skip=3).drop("archivo")


@query(
    "delimited_multiline",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(replace(text, chr(13), ' '), '') || '\"' AS body, lang FROM documents",
)
def delimited_multiline(spark, sf):
    """Texts with line breaks and quotes under a preamble that has a quote of its own; each file has many splits."""
    rows = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string"), F.concat(F.nullif(F.translate("text", "\r", " "), F.lit("")), F.lit('"')).alias("body"), "lang"
    )
    quoted = F.transform(F.array(*rows.columns), lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')))
    lines = _spread(rows, "doc_id").select(F.array_join(quoted, ";", "").alias("value"))
    folder = scratch_path(spark, "multiline")

    def headed(batches):
        yield pd.DataFrame({"value": ['Report of "all', "", "doc_id;body;lang"]})
        yield from batches

    lines.mapInPandas(headed, "value string").write.text(folder)
    return files.read_delimited(spark, folder, skip=2, sep=";", multiline=True).drop("archivo")


@query(
    "payload_kinds",
    "SELECT lot, CASE WHEN lot % 3 = 0 THEN 'zip' WHEN lot % 3 = 1 AND octet_length(encode(html)) >= 100 AND (contains(head, '<!doctype html') "
    "OR contains(head, '<html') OR contains(head, '<head')) THEN 'html' ELSE 'other' END AS kind "
    "FROM (SELECT page_id % 48 AS lot, arg_max(html, page_id) AS html, lower(left(arg_max(html, page_id), 500)) AS head FROM pages GROUP BY 1)",
)
def payload_kinds(spark, sf):
    """A file for each lot of pages: an archive's first bytes, a page as it is, or a page behind other text."""
    lot = table(spark, sf, "pages").groupBy((F.col("page_id") % 48).alias("lot")).agg(F.max_by("html", "page_id").alias("html"))
    before = F.when(F.col("lot") % 3 == 0, "PK\x03\x04").when(F.col("lot") % 3 == 2, "x" * 500).otherwise("")
    folder = scratch_path(spark, "payloads")
    lot.select("lot", F.concat(before, "html").alias("value")).write.partitionBy("lot").text(folder)
    kinds = files.payload_kinds(spark, folder)
    return kinds.select(F.regexp_extract("path", r"lot=(\d+)", 1).cast("bigint").alias("lot"), "kind")


@query(
    "workbook_scan",
    "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, CAST(NULL AS VARCHAR) AS fax, s_name FROM supplier",
)
def workbook_scan(spark, sf):
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    path = _csv_folder(_spread(rows, "s_suppkey"), "books", ("title", "subtitle"))
    books = files.read_workbooks(spark, path, ["s_suppkey", "fax", "s_name"], skip=2, parse=files.parse_csv)
    return books.drop("archivo")


@query("archive_scan", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name FROM part")
def archive_scan(spark, sf):
    """Archives of three members, at most 100 rows in each archive."""
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string"), "p_name", F.floor(F.col("p_partkey") / 100).cast("string").alias("archive"),
        (F.col("p_partkey") % 3).cast("string").alias("member"),
    )
    path = scratch_path(spark, "archives")

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as archive:
            for member, rows in group.groupby("member"):
                archive.writestr(f"m{member}.csv", rows[["p_partkey", "p_name"]].to_csv(index=False))
        return pd.DataFrame({"path": [f"mem/{group['archive'].iloc[0]}.zip"], "content": [buffer.getvalue()]})

    zipped = parts.groupBy("archive").applyInPandas(packed, "path string, content binary")
    zipped.write.parquet(path)
    found = files.rows_of_archives(
        spark.read.parquet(path), ["p_partkey", "p_name"], parse=files.parse_csv, suffixes=(".csv",)
    )
    return found.drop("archivo")


_KINDS = ("good", "moved", "short")


@query(
    "multi_file_consolidate",
    "SELECT 'R' || CAST(c_custkey AS VARCHAR) AS recibo, CAST(c_nationkey AS VARCHAR) AS pais FROM customer WHERE c_custkey % 3 < 2 AND c_custkey % 10 <> 0",
)
def multi_file_consolidate(spark, sf):
    """Files of three layouts: as mapped, reordered with more columns, and one column short."""
    whole, _ = files.consolidate(spark, _consolidate_folder(spark, sf), {"recibo": "Recibo", "pais": "Pais", "archivo": "archivo"}, "Recibo", skip=1)
    return whole.drop("archivo")


@query(
    "file_verdicts",
    "SELECT v.accepted, v.missing, n.nth, (SELECT count(*) FROM customer) AS customers FROM (VALUES (true, '', 4), (false, 'Pais', 2)) "
    "v(accepted, missing, files), (SELECT unnest([1, 2, 3, 4]) AS nth) n WHERE nth <= files",
)
def file_verdicts(spark, sf):
    """A row for each of two files of each layout."""
    mapping = {"recibo": "Recibo", "pais": "Pais", "archivo": "archivo"}
    heads = files.headers_of(spark, _consolidate_folder(spark, sf), skip=1)
    verdicts = files.file_verdicts(heads, mapping, "Recibo")
    nth = F.row_number().over(Window.partitionBy("accepted", "missing").orderBy("path")).alias("nth")
    return verdicts.select("accepted", "missing", nth, F.lit(table(spark, sf, "customer").count()).alias("customers"))


@query(
    "ragged_rows",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'n' || CAST(c_nationkey AS VARCHAR) END AS nation, "
    "CASE WHEN c_custkey % 7 = 0 THEN CAST(c_custkey AS VARCHAR) || CASE WHEN c_custkey % 5 = 0 THEN ',' ELSE ',n' || CAST(c_nationkey AS VARCHAR) END "
    "|| ',extra' END AS ragged FROM customer",
)
def ragged_rows(spark, sf):
    """Rows with fields missing have NULLs; rows with more fields than the header are kept whole."""
    people = table(spark, sf, "customer")
    nation = F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")))
    short = (F.col("c_custkey") % 5 == 0) & (F.col("c_custkey") % 7 != 0)
    line = F.concat(
        F.col("c_custkey").cast("string"), F.when(short, "").otherwise(F.concat(F.lit(","), nation)),
        F.when(F.col("c_custkey") % 7 == 0, ",extra").otherwise(""),
    )
    folder = scratch_path(spark, "ragged")

    def headed(batches):
        yield pd.DataFrame({"value": ["id,nation"]})
        yield from batches

    people.select(line.alias("value")).mapInPandas(headed, "value string").write.text(folder)
    found = files.read_delimited(spark, folder, ragged="keep")
    return found.select("id", F.nullif("nation", F.lit("")).alias("nation"), F.col(files.RAGGED).alias("ragged"))


def _consolidate_folder(spark, sf):
    people = table(spark, sf, "customer").select(
        F.when(F.col("c_custkey") % 10 != 0, F.concat(F.lit("R"), F.col("c_custkey").cast("string"))).alias("Recibo"),
        F.col("c_nationkey").cast("string").alias("Pais"),
        (F.col("c_custkey") % 3).alias("layout"),
    )
    folder = scratch_path(spark, "consolidate")
    layouts = (["Recibo", "Pais"], ["Nota", "Pais", "Recibo"], ["Recibo", "Nota"])
    for kind, (name, columns) in enumerate(zip(_KINDS, layouts)):
        rows = people.where(F.col("layout") == kind).withColumn("Nota", F.lit("x")).select(*columns)
        header = ",".join(columns)
        body = rows.select(F.to_csv(F.struct(*columns)).alias("value"))

        def headed(batches, header=header):
            yield pd.DataFrame({"value": ["preamble", header]})
            yield from batches

        body.repartition(2).mapInPandas(headed, "value string").write.mode("append").text(folder)
    return folder


@query(
    "csv_export",
    "SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts - interval 5 hour, '%Y-%m-%d %H:%M:%S') AS local_time FROM events",
)
def csv_export(spark, sf):
    """Zoned times are exported as local time of Lima, five hours behind UTC, then read back."""
    rows = table(spark, sf, "events").select("event_id", F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp").alias("ts"))
    path = export_csv(rows, scratch_path(spark, "export"))
    back = files.read_delimited(spark, path)
    local = F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")
    return back.select("event_id", local.alias("local_time"))
