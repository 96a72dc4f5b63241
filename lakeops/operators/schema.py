"""Matching a source's headers to a fixed target. Only names are looked at on the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeops.functions.dates import moment
from lakeops.functions.text import header_key_of


class SchemaMismatch(ValueError):
    """A source does not fit its target."""


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def map_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by a target -> source map, names compared trimmed, exactly, then ignoring case.
    Keeps matched columns in source order; raises when none matches."""
    exact = {source.strip(): target for target, source in mapping.items()}
    folded: dict[str, str] = {}
    for source, target in exact.items():
        folded.setdefault(source.lower(), target)
    chosen = []
    for name in df.columns:
        target = exact.get(name.strip()) or folded.get(name.strip().lower())
        if target:
            chosen.append(F.col(_quoted(name)).alias(target))
    if not chosen:
        raise SchemaMismatch("no source column matches the mapping")
    return df.select(*chosen)


def flexible_mapping(mapping: Mapping[str, str], headers: Sequence[str]) -> dict[str, str]:
    """Resolve each target to a real header, exactly or by comparable form; others are left out."""
    by_key = {header_key_of(h): h for h in headers}
    resolved = {}
    for target, wanted in mapping.items():
        found = wanted if wanted in headers else by_key.get(header_key_of(wanted))
        if found is not None:
            resolved[target] = found
    return resolved


def strict_mapping(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame | None:
    """Rename and keep map order; None when any source column is absent."""
    if set(mapping.values()) - set(df.columns):
        return None
    return df.select(*[F.col(_quoted(source)).alias(target) for target, source in mapping.items()])


def align_to_target(df: DataFrame, target: StructType, fill_missing: bool = True) -> DataFrame:
    """Target columns only, matched ignoring case and quotes, in target order; absent ones NULL."""
    have = {name.strip('"').lower(): name for name in df.columns}
    if not any(field.name.strip('"').lower() in have for field in target):
        raise SchemaMismatch("no source column exists in the target")
    columns = []
    for field in target:
        source = have.get(field.name.strip('"').lower())
        if source is not None:
            columns.append(F.col(_quoted(source)).alias(field.name))
        elif fill_missing:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*columns)


def schema_diff(
    df: DataFrame, target: Sequence[str], mapping: Mapping[str, str] | None = None, strict: bool = False
) -> DataFrame:
    """``(column, status)`` with status ``extra`` or ``missing``; strict raises on missing."""
    renames = {source: name for name, source in (mapping or {}).items()}
    have = {renames.get(c, c).strip('"') for c in df.columns}
    missing, extra = set(target) - have, have - set(target)
    if strict and missing:
        raise SchemaMismatch("columns not found in the source: " + ", ".join(sorted(missing)))
    rows = [(c, "extra") for c in sorted(extra)] + [(c, "missing") for c in sorted(missing)]
    schema = StructType([StructField("column", StringType()), StructField("status", StringType())])
    return df.sparkSession.createDataFrame(rows, schema)


def stamp_batch(df: DataFrame, target: Sequence[str], batch_ts: datetime | None) -> DataFrame:
    """Add ``fechacarga`` when the target has it; one run shares one stamp."""
    if batch_ts is None or "fechacarga" not in {c.lower() for c in target}:
        return df
    return df.withColumn("fechacarga", moment(batch_ts))
