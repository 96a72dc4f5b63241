"""Run log: one row per job run, and statistics over it."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.sources.tables import Table

SCHEMA = (
    "id bigint, sp string, inicio timestamp_ntz, fin timestamp_ntz, inserted bigint, updated bigint, "
    "deleted bigint, nulls bigint, estado string, msj_error string, usr_cre string"
)
DONE, ERROR = "DONE", "ERROR"
COUNTS = ("inserted", "updated", "deleted", "nulls")


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)


def record(
    log: Table,
    job: str,
    started: datetime | None = None,
    ended: datetime | None = None,
    state: str | None = None,
    message: str | None = None,
    user: str | None = None,
    **counts: int | None,
) -> None:
    """Append one run; missing times default to now."""
    row = (
        time.time_ns() // 1000, job, started or _now(), ended or _now(),
        *[counts.get(c) for c in COUNTS], state, message, user or log.spark.sparkContext.sparkUser(),
    )
    log.append(log.spark.createDataFrame([row], SCHEMA).coalesce(1))


def run_job(log: Table, job: str, work: Callable[[], Mapping[str, object]]) -> DataFrame:
    """Run ``work``, log its counts or its error, and return the logged row. Errors are re-raised
    after they are logged."""
    started = _now()
    try:
        outcome = dict(work())
    except Exception as error:
        record(log, job, started, state=ERROR, message=str(error))
        raise
    counts = {c: outcome.get(c) for c in COUNTS}
    record(log, job, started, state=DONE, message=outcome.get("message"), **counts)
    return latest_run(log.read(), job)


def latest_run(runs: DataFrame, job: str) -> DataFrame:
    """The job's run that ended last (else began last), ties to the greatest id."""
    when = F.coalesce("fin", "inicio", F.lit("1970-01-01").cast("timestamp_ntz"))
    return runs.where(F.col("sp") == job).orderBy(when.desc(), F.col("id").desc()).limit(1)


def run_stats(runs: DataFrame, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """Per job: runs, outcomes, success rate in percent, mean and longest duration in seconds."""
    if since is not None:
        runs = runs.where(F.col("inicio") >= since)
    if until is not None:
        runs = runs.where(F.col("inicio") < until)
    seconds = F.timestamp_diff("SECOND", F.col("inicio"), F.col("fin"))
    done = F.count_if(F.col("estado") == DONE)
    return runs.groupBy("sp").agg(
        F.count(F.lit(1)).alias("runs"),
        done.alias("succeeded"),
        F.count_if(F.col("estado") == ERROR).alias("failed"),
        F.round(100 * done / F.count(F.lit(1)), 2).alias("success_pct"),
        F.round(F.avg(seconds), 3).alias("mean_seconds"),
        F.max(seconds).alias("longest_seconds"),
        F.max("fin").alias("last_end"),
    )


def run_history(runs: DataFrame, since: Column, until: Column) -> DataFrame:
    """Runs per day, job and state that ended in ``[since, until)``."""
    kept = runs.where((F.col("fin") >= since) & (F.col("fin") < until))
    return kept.groupBy(F.to_date("fin").alias("day"), "sp", "estado").agg(F.count(F.lit(1)).alias("runs"))


def job_count(runs: DataFrame) -> DataFrame:
    return runs.agg(F.count_distinct("sp").alias("jobs"))
