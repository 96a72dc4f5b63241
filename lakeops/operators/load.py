"""Load strategies as plans from (target, staged) to the next state of the target.

Parquet has no MERGE. The target is only ever filtered by the staged keys: when a caller knows that
those are ``few``, Spark may broadcast them (below its own size limit) and the target is not shuffled at
all; else they are never sent to every task, nor to the driver. What comes
of a batch is its own rows with their ``_action``; a caller writes those once, counts them and
puts them into the store.

``staged`` must hold one row per key; take it through ``first_arrival`` or ``latest_per_key``. A target
that is ``reduced`` has been through ``stored_like`` already; ``few`` then says so of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.session import merged

ACTION = "_action"
INSERT, UPDATE, SAME, KEEP = "insert", "update", "same", "keep"


#: Keys of a small batch go into the scan of the target as values, up to this many.
MOST_PUSHED = 1000


def _side(rows: DataFrame, few: bool) -> DataFrame:
    return rows if few else merged(rows)


def stored_like(target: DataFrame, staged: DataFrame, keys: Sequence[str], few: bool = False) -> DataFrame:
    """The target's rows that the batch has a key of."""
    return target.join(_side(staged.select(*keys), few), list(keys), "left_semi")


def stored_like_few(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], most: int = MOST_PUSHED, few: bool = False
) -> DataFrame:
    """``stored_like`` for a written batch; runs a job. The first key's values of a batch of up to ``most``
    come to the driver and filter the target's scan, which then opens only row groups whose bloom
    filter or range may have one of them."""
    found = [r[0] for r in staged.select(keys[0]).where(F.col(keys[0]).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        return stored_like(target, staged, keys, few)
    return stored_like(target.where(F.col(keys[0]).isin(found)), staged, keys, few)


def insert_new(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], few: bool = False, reduced: bool = False
) -> DataFrame:
    """Staged rows whose key the target lacks: the rows to append."""
    known = target.select(*keys) if reduced else stored_like(target.select(*keys), staged, keys, few)
    return staged.join(_side(known, few), list(keys), "left_anti")


def differs(columns: Sequence[str], left: str, right: str) -> Column:
    """Whether any column differs, NULL equal to NULL, between two aliased frames."""
    pack = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in columns])
    return ~pack(left).eqNullSafe(pack(right))


def applied(
    target: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    keep: Sequence[str] = (),
    few: bool = False,
    reduced: bool = False,
) -> DataFrame:
    """The batch's rows, each an insert or an update. Columns ``keep`` of an updated row stay as stored."""
    stored = {c: f"_t_{c}" for c in keep}
    known = target.select(*keys, *keep)
    known = (known if reduced else stored_like(known, staged, keys, few)).withColumnsRenamed(stored).withColumn("_known", F.lit(True))
    joined = staged.join(_side(known, few), list(keys), "left").withColumns(
        {c: F.when(F.col("_known"), F.col(t)).otherwise(F.col(c)) for c, t in stored.items()}
    )
    action = F.when(F.col("_known"), F.lit(UPDATE)).otherwise(F.lit(INSERT))
    return joined.withColumn(ACTION, action).drop("_known", *stored.values())


def applied_changed(
    target: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
    keep: Sequence[str] = (),
    few: bool = False,
    reduced: bool = False,
) -> DataFrame:
    """The batch's rows, each an insert, an update if a compared column differs, or else the stored
    row. Columns ``keep`` are not compared, and stay as stored."""
    keys = list(keys)
    compare = list(compare or [c for c in staged.columns if c not in (*keys, *keep)])
    matched = (target if reduced else stored_like(target, staged, keys, few)).withColumn("_known", F.lit(True))
    changed = differs(compare, "s", "t")
    action = F.when(F.col("t._known").isNull(), F.lit(INSERT)).when(changed, F.lit(UPDATE)).otherwise(F.lit(SAME))
    on = [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys]
    joined = staged.alias("s").join(_side(matched.alias("t"), few), on, "left").withColumn(ACTION, action)
    stays = lambda c: F.col(ACTION) != INSERT if c in keep else F.col(ACTION) == SAME
    columns = [
        F.when(stays(c), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c)
        if c in staged.columns
        else F.col(f"t.{c}").alias(c)
        for c in target.columns
    ]
    return joined.select(*columns, ACTION)


def with_rest(target: DataFrame, batch: DataFrame, keys: Sequence[str], few: bool = False) -> DataFrame:
    """Applied rows and the target's rows that they don't touch: the target's next state."""
    untouched = target.join(_side(batch.select(*keys), few), list(keys), "left_anti").withColumn(ACTION, F.lit(KEEP))
    return untouched.unionByName(batch, allowMissingColumns=True)


def upsert(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows replaced even when equal, new rows added."""
    return with_rest(target, applied(target, staged, keys), keys)


def upsert_changed(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None
) -> DataFrame:
    """Matched rows replaced only when a compared column differs; equal rows keep the stored row."""
    return with_rest(target, applied_changed(target, staged, keys, compare), keys)


def next_state(merged: DataFrame) -> DataFrame:
    return merged.drop(ACTION)


def action_counts(merged: DataFrame) -> DataFrame:
    """One row: inserted, updated, unchanged, kept."""
    tally = lambda name: F.count_if(F.col(ACTION) == name)
    return merged.agg(
        tally(INSERT).alias("inserted"),
        tally(UPDATE).alias("updated"),
        tally(SAME).alias("unchanged"),
        tally(KEEP).alias("kept"),
    )
