"""Workbook forms: one sheet is one record, and one workbook may feed many tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.numbers import code_digits, form_value
from lakeops.functions.places import billing_period


def forms_to_records(
    cells: DataFrame,
    fields: Mapping[str, Mapping[str, object]],
    sheets: Sequence[str] | None = None,
    group: Sequence[str] = ("sheet",),
) -> DataFrame:
    """``(sheet, cell, value)`` to one row per sheet.

    A field is ``{"type": str|int|decimal|date, "cell": "A6"}`` or has ``"const"`` instead.
    Only cells a field asks for are shuffled, as partial maxima.
    """
    wanted = sorted({str(f["cell"]) for f in fields.values() if f.get("cell")})
    if sheets is not None:
        cells = cells.where(F.col("sheet").isin(list(sheets)))
    picked = cells.select(
        *group, *[F.when(F.col("cell") == c, F.col("value")).alias(f"_{c}") for c in wanted]
    )
    rows = picked.groupBy(*group).agg(*[F.max(f"_{c}").alias(f"_{c}") for c in wanted])

    def field(name: str, spec: Mapping[str, object]):
        const = spec.get("const")
        raw = F.col(f"_{spec['cell']}") if spec.get("cell") else F.lit(None if const is None else str(const))
        return form_value(raw.cast("string"), str(spec.get("type", "str"))).alias(name)

    return rows.select(*group, *[field(n, s) for n, s in fields.items()])


def number_receipts(records: DataFrame, period_text: str = "per_consumo", code: str = "cod_suministro") -> DataFrame:
    """Derive the clean code and the receipt number, period followed by code; NULL when either is."""
    clean = code_digits(F.col(code).cast("string"))
    return records.withColumns(
        {code: clean, "num_recibo": F.concat(billing_period(F.col(period_text)), clean)}
    )


def as_landing(records: DataFrame, arrival: Sequence[str] = ("sheet",)) -> DataFrame:
    """Records as an all-text landing table, with ``ord`` from the columns that tell them apart."""
    texts = [F.col(c).cast("string").alias(c) for c in records.columns if c not in arrival]
    return records.select(*texts, F.struct(*arrival).alias("ord"))


def fanout_status(rows: DataFrame, forms: DataFrame, column: str = "form") -> DataFrame:
    """Per expected form: rows found and status 200, or 204 when the tab is empty."""
    found = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    n = F.coalesce(F.col("n_rows"), F.lit(0))
    return forms.select(column).distinct().join(found, column, "left").select(
        column,
        n.cast("bigint").alias("n_rows"),
        F.when(n > 0, 200).otherwise(204).alias("code"),
    )


def overall_status(failed: int, loaded: int) -> int:
    """200 all loaded, 207 some failed, 500 all failed."""
    if not failed:
        return 200
    return 207 if loaded else 500
