"""Data-quality quarantine: one reason per rejected row, rejects kept, nothing lost."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.text import has_digits_after_dash, is_blank, is_missing, same_text
from lakeops.operators.skew import attach_facts, write_facts
from lakeops.session import merged

REASON = "_reason"
BATCH_TS = "_batch_ts"
SOURCE = "_source"
INVALID, MISSING, DUPLICATE, UNTYPED = "invalid", "missing", "duplicate", "untyped"


def invalid_id(c: Column) -> Column:
    """Not blank, but without digits after a dash. A literal ``nan`` is invalid, not missing."""
    return ~is_blank(c) & ~has_digits_after_dash(c)


def missing_id(c: Column) -> Column:
    return is_missing(c)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count ``copies``. NULLs group together."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def mark_rejects(
    rows: DataFrame,
    rules: Mapping[str, Column],
    dup_key: Mapping[str, Column] | None = None,
    *,
    spread_by: Sequence[str],
    rows_per_task: int | None = None,
) -> DataFrame:
    """Add ``_reason``: the first rule that holds, else ``duplicate``, else NULL.

    Duplicates are counted among rows no rule rejected, and every copy is rejected. The first
    part of ``dup_key`` must not be NULL; the others match NULL with NULL. With ``dup_key``, runs
    a job that writes the repeated keys.
    """
    reason = F.lit(None).cast("string")
    for name, test in reversed(rules.items()):
        reason = F.when(test, F.lit(name)).otherwise(reason)
    marked = rows.withColumn(REASON, reason)
    if not dup_key:
        return marked
    keys = [f"_k{i}" for i in range(len(dup_key))]
    marked = marked.withColumns(dict(zip(keys, dup_key.values())))
    candidate = F.col(REASON).isNull() & F.col(keys[0]).isNotNull()
    copies = duplicate_keys(marked.where(candidate).select(*keys), keys)
    flagged = attach_facts(
        marked,
        write_facts(copies, "copies"),
        keys,
        spread_by=spread_by,
        how="left",
        null_safe=keys[1:],
        eligible=candidate,
        rows_per_task=rows_per_task,
    )
    duplicate = F.when(F.col("copies").isNotNull(), F.lit(DUPLICATE))
    return flagged.withColumn(REASON, F.coalesce(REASON, duplicate)).drop("copies", *keys)


def accepted(marked: DataFrame) -> DataFrame:
    return marked.where(F.col(REASON).isNull()).drop(REASON)


def rejected(marked: DataFrame, source: str, batch_ts: Column) -> DataFrame:
    """Rejected rows with one stamp for the whole run and the name of their source."""
    return marked.where(F.col(REASON).isNotNull()).withColumns({BATCH_TS: batch_ts, SOURCE: F.lit(source)})


def reason_counts(marked: DataFrame) -> DataFrame:
    """Rows per reason; accepted rows count as ``accepted``."""
    return marked.groupBy(F.coalesce(REASON, F.lit("accepted")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def new_rejects(
    candidates: DataFrame,
    stored: DataFrame,
    keys: Sequence[str],
    *,
    spread_by: Sequence[str],
    rows_per_task: int | None = None,
) -> DataFrame:
    """Candidates whose key, NULL matching NULL, is not yet stored for the same source and day, so
    that a rerun adds none. Keys are compared once each, not once per copy. Runs a
    job that writes the new keys."""
    full = [*keys, SOURCE, "_day"]
    dated = candidates.withColumn("_day", F.to_date(BATCH_TS))
    known = stored.withColumn("_day", F.to_date(BATCH_TS)).select(*[F.col(k).alias(f"_s{k}") for k in full])
    counted = dated.groupBy(*full).agg(F.count(F.lit(1)).alias("_copies"))
    matches = F.lit(True)
    for k in full:
        matches &= F.col(k).eqNullSafe(F.col(f"_s{k}"))
    fresh = counted.join(merged(known.distinct()), matches, "left_anti")
    facts = write_facts(fresh, "_copies")
    joined = attach_facts(dated, facts, full, spread_by=spread_by, null_safe=full, rows_per_task=rows_per_task)
    return joined.drop("_copies", "_day")


def on_day(ts: Column, day: Column) -> Column:
    """Whether a timestamp falls on a day, as a range that reaches the file scan."""
    start = day.cast("timestamp_ntz")
    return (ts >= start) & (ts < start + F.expr("INTERVAL 1 DAY"))


def latest_rejects(stored: DataFrame, source: str, as_of: Column) -> DataFrame:
    """The newest batch of ``as_of``'s rejects of one source; the source name ignores case and spaces."""
    today = stored.where(same_text(F.col(SOURCE), F.lit(source)) & on_day(F.col(BATCH_TS), as_of))
    newest = today.agg(F.max(BATCH_TS).alias("_newest"))
    return today.join(F.broadcast(newest), F.col(BATCH_TS) == F.col("_newest"), "left_semi")


def missing_key_count(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count_if(is_blank(F.col(key))).alias("n_missing"))
