"""Joining per-key facts back to rows when one key may hold a large share of all rows.

Adaptive skew-join cannot split this join: the facts side is an aggregate that already has
the join's partitioning, so it is no bare shuffle stage. Instead hot keys are salted: those with
more than 1 / HOT_SHARE of all rows (and LEAST_HOT of them), of which there are fewer than
HOT_SHARE, however large the data. Rows learn their key's salts by broadcast of these keys alone.
A key with ``n`` of ``total`` rows is spread over ``ceil(n * HOT_SHARE / total)`` salts at most, so
the replicated facts never exceed the number of keys + HOT_SHARE, and no salt holds more than
1 / HOT_SHARE of the rows. Where no key is hot the join is a plain one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.session import MOST_BROADCAST, merged, written

HOT_SHARE, LEAST_HOT = 10_000, 1_000


class Facts(NamedTuple):
    """A written table with one row per key, the rows of the largest key and of all, and the number of keys, if counted."""

    rows: DataFrame
    weight: str
    largest: int
    total: int
    keys: int = 0

    def limit(self, rows_per_task: int | None = None) -> int:
        """Rows beyond which a key is hot."""
        return rows_per_task or max(LEAST_HOT, -(-self.total // HOT_SHARE))


def write_facts(facts: DataFrame, weight: str, label: str = "facts") -> Facts:
    """Write facts whose column ``weight`` counts each key's rows."""
    rows = written(facts, label)
    largest, total, keys = rows.agg(F.max(weight), F.sum(weight), F.count(F.lit(1))).head()
    return Facts(rows, weight, largest or 0, total or 0, keys)


def heaviest(facts: DataFrame, keys: Sequence[str], weight: str, limit: int) -> DataFrame:
    """Keys whose weight exceeds ``limit``, with the salts of each."""
    hot = facts.where(F.col(weight) > limit)
    return hot.select(*keys, F.ceil(F.col(weight) / limit).cast("int").alias("_salts"))


def _on(left: Sequence[str], right: Sequence[str], null_safe: Sequence[str]) -> Column:
    pairs = [
        F.col(a).eqNullSafe(F.col(b)) if a in null_safe else F.col(a) == F.col(b) for a, b in zip(left, right)
    ]
    return reduce(lambda x, y: x & y, pairs)


def attach_facts(
    rows: DataFrame,
    facts: Facts,
    keys: Sequence[str],
    *,
    spread_by: Sequence[str],
    how: str = "inner",
    null_safe: Sequence[str] = (),
    eligible: Column | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Join ``facts`` to ``rows`` on ``keys``.

    ``facts`` must hold every key that has many rows. ``spread_by`` names columns that tell rows of
    one key apart; they choose the salt, so they must be stable under task retries. With
    ``how='left'``, rows that fail ``eligible`` pass through unmatched and are spread over all
    partitions, so that neither rejected rows nor NULL keys gather in one of them. ``rows_per_task``
    takes the place of the share that makes a key hot.
    """
    limit = facts.limit(rows_per_task)
    right = {k: f"_f_{k}" for k in keys}
    weight, largest, many = facts.weight, facts.largest, facts.keys > MOST_BROADCAST
    facts = facts.rows.withColumnsRenamed(right)
    condition = _on(keys, list(right.values()), null_safe)

    if largest <= limit and eligible is None:
        return rows.join(merged(facts) if many else facts, condition, how).drop(*right.values())

    noise = F.xxhash64(*spread_by)
    salt, salts = F.lit(0), F.lit(1)
    if largest > limit:
        hot_keys = [f"_h_{k}" for k in keys]
        hot = heaviest(facts.withColumnsRenamed(dict(zip(right.values(), hot_keys))), hot_keys, weight, limit)
        rows = rows.join(F.broadcast(hot), _on(keys, hot_keys, null_safe), "left").drop(*hot_keys)
        salt = F.pmod(noise, F.coalesce("_salts", F.lit(1))).cast("int")
        salts = F.ceil(F.col(weight) / limit).cast("int")
    if eligible is not None:
        astray = -1 - F.pmod(noise, F.lit(1_000_003)).cast("int")
        salt = F.when(F.coalesce(eligible, F.lit(False)), salt).otherwise(astray)
    rows = rows.withColumn("_salt", salt).drop("_salts")
    facts = facts.withColumn("_f_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    joined = rows.join(merged(facts) if many else facts, condition & (F.col("_salt") == F.col("_f_salt")), how)
    return joined.drop("_salt", "_f_salt", *right.values())
