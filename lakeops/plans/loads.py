"""Feed jobs: landing table -> rejects and typed store.

``mark``, ``stage`` and ``merge`` are plain plans; ``run_feed`` writes. What several outputs or
counts need is written once to the shared folder instead of computed twice.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.functions.dates import moment
from lakeops.functions.text import is_blank, is_missing
from lakeops.operators import dedup, load, quarantine
from lakeops.operators.schema import align_to_target, flexible_mapping, stamp_batch
from lakeops.plans.feeds import AUDIT, SUPPLY, Feed
from lakeops.session import few, merged, scratch_scope, written
from lakeops.sources.tables import Table, load_frame

ORD = "ord"
#: A value that cleaning made NULL, of a row that was stored: its key, column and text.
LOSSES = "source string, clave string, columna string, valor string, _batch_ts timestamp_ntz"
LOST = "_lost"


def _rules(feed: Feed) -> dict[str, Column]:
    """The feed's rules, and last the one that a key must keep its type: such a row could not be stored."""
    known = {quarantine.INVALID: quarantine.invalid_id, quarantine.MISSING: quarantine.missing_id}
    rules = {name: known[name](F.col(feed.key[0])) for name in feed.rules}
    return rules | ({quarantine.UNTYPED: feed.untyped()} if feed.key else {})


def _dup_key(feed: Feed) -> dict[str, Column]:
    if not feed.dup_normalised:
        return {k: F.col(k) for k in feed.dup_key}
    # A null token has no normalised form, so it can never be a duplicate.
    shape = lambda c: F.when(~is_missing(c), F.lower(F.left(F.trim(c), F.lit(255))))
    return {k: shape(F.col(k)) for k in feed.dup_key}


def mark(landing: DataFrame, feed: Feed, rows_per_task: int | None = None) -> DataFrame:
    """Landing rows with the reason each is rejected for, if any."""
    return quarantine.mark_rejects(
        landing, _rules(feed), _dup_key(feed), spread_by=[ORD], rows_per_task=rows_per_task
    )


def stage(good: DataFrame, feed: Feed, lost: bool = False) -> DataFrame:
    """Accepted rows typed, one per key unless the feed keeps all; with ``lost``, what cleaning made NULL."""
    carry = [LOST] if lost else []
    if lost:
        good = good.withColumn(LOST, feed.lost(good))
    if not feed.key:
        return feed.clean(good, *carry)
    usable = good
    for k in feed.key:
        usable = usable.where(~is_blank(F.col(k)))
    typed = feed.clean(usable, ORD, *carry)
    if feed.latest_by:
        one = dedup.latest_per_key(typed, feed.key, feed.latest_by, ORD)
    else:
        one = dedup.first_arrival(typed, feed.key, ORD)
    return one.drop(ORD)


def merge(store: DataFrame, staged: DataFrame, feed: Feed, few: bool = False, reduced: bool = False) -> DataFrame:
    """The batch's rows by the feed's strategy, with their ``_action``. Audit columns of stored rows stay.
    ``few`` and ``reduced`` are those of ``operators.load``."""
    keep = [c for c in AUDIT if c in staged.columns]
    if feed.strategy == "insert_new":
        return load.insert_new(store, staged, feed.key, few, reduced).withColumn(load.ACTION, F.lit(load.INSERT))
    if feed.strategy == "upsert":
        return load.applied(store, staged, feed.key, keep, few, reduced)
    if feed.strategy == "upsert_changed":
        return load.applied_changed(store, staged, feed.key, keep=keep, few=few, reduced=reduced)
    return staged.withColumn(load.ACTION, F.lit(load.INSERT))


def run_feed(
    spark: SparkSession,
    landing: DataFrame,
    feed: Feed,
    store: Table,
    rejects: Table | None,
    batch_ts: datetime,
    user: str | None = None,
    losses: Table | None = None,
) -> dict[str, object]:
    """Quarantine, clean, deduplicate and load one batch; returns counts and a message. Values that
    cleaning makes NULL are kept in ``losses`` (``LOSSES``) and counted as ``lost``, if it is given.

    A store partitioned by columns of the feed's key is read and rewritten only in the partitions
    the batch touches. Any other updated store gets the batch's rows as a delta. Counts are taken
    from what was written, so a repeated task doesn't count twice and an empty batch counts 0.
    """
    with scratch_scope(spark):
        return _run_feed(landing, feed, store, rejects, batch_ts, user or spark.sparkContext.sparkUser(), losses)


def keep_losses(staged: DataFrame, feed: Feed, losses: Table, batch_ts: datetime) -> int:
    """Append what the staged rows have lost, without what is kept of that day already; returns how much they lost."""
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in feed.key]) if feed.key else F.lit(None).cast("string")
    found = staged.select(key.alias("clave"), F.inline(LOST)).select(
        F.lit(feed.source).alias("source"), "clave", "columna", "valor", moment(batch_ts).alias(quarantine.BATCH_TS)
    )
    found = written(found, "losses")
    known = losses.read().where(quarantine.on_day(F.col(quarantine.BATCH_TS), F.lit(batch_ts.date())))
    same = ["source", "clave", "columna"]
    matches = [F.col(f"n.{c}").eqNullSafe(F.col(f"k.{c}")) for c in same]
    losses.append(found.alias("n").join(merged(known.select(*same).distinct().alias("k")), matches, "left_anti"))
    return found.count()


def _run_feed(
    landing: DataFrame, feed: Feed, store: Table, rejects: Table | None, batch_ts: datetime, user: str, losses: Table | None
) -> dict[str, object]:
    by_partition = bool(store.partition_by) and set(store.partition_by) <= set(feed.key)
    outcome: dict[str, object] = {"inserted": 0, "updated": 0, "deleted": None, "nulls": None}
    reasons: dict[str, int] = {}
    good = landing
    if feed.dup_key or (feed.key and rejects is not None):
        marked = written(mark(landing, feed), "marked")
        good = quarantine.accepted(marked)
        if rejects is not None:
            bad = quarantine.rejected(marked, feed.source, moment(batch_ts))
            same_day = rejects.read().where(quarantine.on_day(F.col(quarantine.BATCH_TS), F.lit(batch_ts.date())))
            fresh = written(quarantine.new_rejects(bad, same_day, feed.dup_key or feed.key, spread_by=[ORD]), "rejects")
            reasons = {r[0]: r[1] for r in fresh.groupBy(quarantine.REASON).count().collect()}
            rejects.append(fresh)
    if feed.latest_by:
        outcome["nulls"] = quarantine.missing_key_count(landing, feed.key[0]).first()["n_missing"]
    if feed.strategy.startswith("refresh"):
        outcome["deleted"] = store.read().count()

    stamps = {"creation_user": F.lit(user), "creation_date": moment(batch_ts)}
    staged = written(stage(good, feed, losses is not None).withColumns(stamps), "staged")
    if losses is not None:
        outcome["lost"] = keep_losses(staged, feed, losses, batch_ts)
        staged = staged.drop(LOST)
    if feed.strategy.startswith("refresh"):
        store.replace(staged)
        outcome["inserted"] = staged.count()
    else:
        if not by_partition:
            store.key = store.key or list(feed.key)
        stored = store.read_touched(staged) if by_partition else store.read()
        needed = {"insert_new": feed.key, "upsert": [*feed.key, *AUDIT]}.get(feed.strategy, stored.columns)
        # One pass over the store; what it has of the batch's keys is as small as the batch.
        like = load.stored_like_few if store.exists() else load.stored_like
        small = few(staged)
        known = written(like(stored.select(*needed), staged, feed.key, few=small), "known")
        done = merge(known, staged, feed, few(known), reduced=True)
        if by_partition:  # counted, and read twice for the next state
            done = written(done, "applied")
        counts = load.action_counts(done).first()
        outcome |= {"inserted": counts["inserted"], "updated": counts["updated"]}
        if feed.strategy == "insert_new":
            store.append(load.next_state(done))
        elif by_partition:
            store.replace_partitions(load.next_state(load.with_rest(stored, done, feed.key, small)))
        else:
            store.upsert(load.next_state(done.where(F.col(load.ACTION) != load.SAME)))
    named = [*feed.rules, *([quarantine.UNTYPED] if reasons.get(quarantine.UNTYPED) else []), *([quarantine.DUPLICATE] if feed.dup_key else [])]
    shown = ", ".join(f"{r}: {reasons.get(r, 0)}" for r in named)
    outcome["message"] = "%s: inserted %s, updated %s, rejected %s%s" % (
        feed.source, outcome["inserted"], outcome["updated"], sum(reasons.values()),
        f" ({shown})" if shown and rejects is not None else "",
    )
    return outcome


def reject_schema(landing: StructType) -> StructType:
    """Schema of the reject table of a landing table."""
    extra = f"{quarantine.REASON} string, {quarantine.BATCH_TS} timestamp_ntz, {quarantine.SOURCE} string"
    return StructType([f for f in landing if f.name != ORD] + list(StructType.fromDDL(extra)))


def supply_schema() -> StructType:
    return StructType.fromDDL(", ".join(f"`{c}` string" for c in SUPPLY))


def load_direct(
    source: DataFrame, table: Table, mapping: dict[str, str], mode: str = "replace", batch_ts: datetime | None = None
) -> dict[str, object]:
    """Load a source straight into a typed table: headers matched loosely, absent columns NULL."""
    found = flexible_mapping(mapping, source.columns)
    named = source.select(*[F.col(f"`{header}`").alias(target) for target, header in found.items()])
    aligned = align_to_target(named, table.schema)
    return load_frame(stamp_batch(aligned, table.schema.names, batch_ts), table, mode)
