"""Exact per-group statistics for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.skew import Facts, attach_facts, write_facts
from lakeops.session import written

_ACCURACY = 10_000
_SLACK = 2 / _ACCURACY
# Brackets around the median, as ranks; the last holds every value.
_WIDER = (0.05, 0.5)


def group_stats(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    spread_by: Sequence[str] | None = None,
    rows_per_task: int | None = None,
    weights: tuple[int, int] | None = None,
) -> DataFrame:
    """``keys``, count ``n``, exact ``median`` and sample ``std`` of a non-null double; runs jobs.

    No group is held in one place. A mergeable quantile sketch brackets each group's median; values
    below and above the bracket are only counted, values inside are counted each. The counts prove
    where the median lies. A group whose bracket missed it gets a wider one. ``weights``, the rows of
    the largest group and of all, or about, save a written table.
    """
    return group_facts(rows, keys, value, spread_by=spread_by, rows_per_task=rows_per_task, weights=weights).rows


def group_facts(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    spread_by: Sequence[str] | None = None,
    rows_per_task: int | None = None,
    weights: tuple[int, int] | None = None,
) -> Facts:
    """``group_stats`` as facts to join, weighted by ``n``."""
    keys, found, rest, largest, total = list(keys), [], rows, 0, 0
    for slack in (_SLACK, *_WIDER):
        located = written(_around_median(rest, keys, value, slack, spread_by or [value], rows_per_task, weights), "medians")
        found.append(located.where("median is not null"))
        told = located.agg(F.count_if(F.col("median").isNull()).alias("missed"), F.max("n").alias("largest"), F.sum("n").alias("total")).first()
        if not found[1:]:
            largest, total = told["largest"] or 0, told["total"] or 0
        if not told["missed"]:
            break
        rest = rest.join(located.where("median is null").select(*keys), keys, "left_semi")
    return Facts(reduce(DataFrame.unionByName, found), "n", largest, total)


def _around_median(
    rows: DataFrame, keys: list[str], value: str, slack: float, spread_by: Sequence[str], rows_per_task: int | None,
    weights: tuple[int, int] | None,
) -> DataFrame:
    """``keys``, ``n``, ``std`` and the exact median, or NULL where the bracket of ``slack`` around it missed."""
    v = F.col(value)
    sketch = F.percentile_approx(v, [max(0.0, 0.5 - slack), min(1.0, 0.5 + slack)], _ACCURACY)
    whole = F.array(F.min(v), F.max(v))
    bracket = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.stddev_samp(value).alias("_std"), (whole if slack >= 0.5 else sketch).alias("_q")
    )
    joined = attach_facts(
        rows.select(*dict.fromkeys([*keys, value, *spread_by])),
        Facts(bracket, "_n", *weights) if weights else write_facts(bracket, "_n", "brackets"), keys,
        spread_by=spread_by, rows_per_task=rows_per_task,
    )
    low, high = F.col("_q")[0], F.col("_q")[1]
    counted = joined.groupBy(
        *keys,
        F.when(v < low, -1).when(v > high, 1).otherwise(0).alias("_side"),
        F.when(v.between(low, high), v).alias("_value"),
    ).agg(F.count(F.lit(1)).alias("_c"), F.any_value("_n").alias("_n"), F.any_value("_std").alias("_std"))
    seen = F.sum("_c").over(Window.partitionBy(*keys).orderBy("_side", "_value").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.withColumn("_seen", seen)
    # NULL where the rank lies outside the bracket
    first = lambda rank: F.min_by("_value", F.when(F.col("_seen") > rank, F.col("_seen")))
    middle = ranked.groupBy(*keys).agg(
        F.any_value("_n").alias("n"), F.any_value("_std").alias("std"),
        first(F.floor((F.col("_n") - 1) / 2)).alias("_a"), first(F.floor(F.col("_n") / 2)).alias("_b")
    )
    return middle.select(*keys, "n", ((F.col("_a") + F.col("_b")) / 2).alias("median"), "std")
