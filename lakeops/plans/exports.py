"""Reports and rejects to files, and the manual load of any file into any table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.quarantine import latest_rejects
from lakeops.operators.schema import align_to_target, map_columns
from lakeops.session import scratch_scope
from lakeops.sources.files import read_delimited, read_workbooks
from lakeops.sources.tables import Table, export_csv, load_frame


def export_report(
    spark: SparkSession, build: Callable[[], DataFrame], path: str, headings: Mapping[str, str] | None = None
) -> str:
    """Build a report and write it as CSV under its headings; its intermediates are deleted after."""
    with scratch_scope(spark):
        return export_csv(build().withColumnsRenamed(dict(headings or {})), path)


def export_rejects(stored: DataFrame, source: str, as_of: date, folder: str) -> str | None:
    """The source's latest rejects of the day as CSV below ``folder``, one path per source, so that
    two feeds cannot overwrite each other; None when there are none."""
    rows = latest_rejects(stored, source, F.lit(as_of).cast("date"))
    if rows.isEmpty():
        return None
    return export_csv(rows, f"{folder.rstrip('/')}/source={source}")


def manual_load(
    spark: SparkSession,
    paths: Sequence[str] | str,
    table: Table,
    mode: str = "replace",
    mapping: Mapping[str, str] | None = None,
    sheet: str | int = 0,
    skip: int = 0,
    then: Callable[[], Mapping[str, object]] | None = None,
) -> dict[str, object]:
    """Load a file into a table by policy, then run a follow-up load when one is given."""
    first = paths if isinstance(paths, str) else paths[0]
    if first.lower().endswith((".xlsx", ".xls")):
        headers = list(mapping.values()) if mapping else table.schema.names
        rows = read_workbooks(spark, paths, headers, sheet, skip)
    elif first.lower().endswith(".csv") or "." not in first.rsplit("/", 1)[-1]:
        rows = read_delimited(spark, paths, skip)
    else:
        raise ValueError("unsupported format: use .csv, .xlsx or .xls")
    if mapping:
        rows = map_columns(rows, mapping)
    outcome = load_frame(align_to_target(rows, table.schema), table, mode)
    return outcome | {"then": dict(then())} if then else outcome
