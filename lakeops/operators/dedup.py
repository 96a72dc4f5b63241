"""One row, or one batch, per key.

``row_number() = 1`` is cut inside every map task before the shuffle (Spark plans a partial
window group limit for it), so a key that holds most rows still sends few to its reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.skew import attach_facts, write_facts


def _keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def first_arrival(df: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """The earliest row of each key by ``arrival``. Rows with a NULL in the key go."""
    return _keep_first(df.dropna(subset=list(keys)), keys, [F.col(arrival).asc()])


def latest_per_key(df: DataFrame, keys: Sequence[str], stamp: str, tie: str) -> DataFrame:
    """The row with the greatest ``stamp`` (NULL last), ties to the smallest ``tie``."""
    order = [F.col(stamp).desc_nulls_last(), F.col(tie).asc()]
    return _keep_first(df.dropna(subset=list(keys)), keys, order)


def keep_last_batch(
    df: DataFrame,
    group: Sequence[str],
    stamp: str,
    *,
    spread_by: Sequence[str],
    day: Column | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Of each group and day, every row that carries the day's greatest stamp.

    With ``day`` only that day is judged; rows of other days stay as they are, and so do rows
    without a stamp. A NULL in the group is a group like any other. Runs a job that writes the
    greatest stamps.
    """
    dated = df.withColumn("_day", F.to_date(stamp))
    mine = F.col("_day").isNotNull() if day is None else F.col("_day").eqNullSafe(day)
    judged = dated.where(mine)
    keys = [*group, "_day"]
    last = judged.groupBy(*keys).agg(F.max(stamp).alias("_last"), F.count(F.lit(1)).alias("_n"))
    facts = write_facts(last, "_n")
    joined = attach_facts(judged, facts, keys, spread_by=spread_by, null_safe=group, rows_per_task=rows_per_task)
    kept = joined.where(F.col(stamp) == F.col("_last")).drop("_last", "_n")
    return kept.unionByName(dated.where(~mine)).drop("_day")


def batch_summary(df: DataFrame, group: Sequence[str], stamp: str, day: Column) -> DataFrame:
    """Per group on ``day``: the stamp kept and the number of rows of older batches."""
    counted = df.where(F.to_date(stamp) == day).groupBy(*group, stamp).agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(*group).agg(
        F.max(stamp).alias("kept_stamp"),
        (F.sum("_n") - F.max_by("_n", stamp)).alias("rows_removed"),
    )
