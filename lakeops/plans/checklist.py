"""Checklist history: all forms in one table, one stamp per run, same-day reruns cleaned up."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeops.functions.dates import moment
from lakeops.functions.text import header_key
from lakeops.operators.dedup import batch_summary, keep_last_batch
from lakeops.operators.forms import fanout_status, overall_status
from lakeops.operators.schema import SchemaMismatch, align_to_target
from lakeops.plans.pools import AT_ONCE, message_of, run_each
from lakeops.session import scratch_scope, written
from lakeops.sources.files import Workbook, parse_xlsx, read_tabs
from lakeops.sources.tables import Table

SCHEMA = (
    "form string, task_id string, site_id string, sub_wo_id string, question string, answer string, "
    "fechacarga timestamp_ntz, dia date"
)
ROW = ("form", "task_id", "site_id", "sub_wo_id", "question", "answer")
UNKNOWN = 404
_ROW_TYPE = StructType([StructField(c, StringType()) for c in ROW[1:]])


def history(spark: SparkSession, path: str) -> Table:
    return Table(spark, path, SCHEMA, partition_by=["dia"])


def read_answers(
    spark: SparkSession, paths: Sequence[str] | str, parse: Callable[[bytes], Workbook] = parse_xlsx
) -> DataFrame:
    """Answers of all tabs of a checklist workbook; a form is named by its tab in comparable form."""
    tabs = read_tabs(spark, paths, ["task_id", "site_id", "sub_wo_id"], parse)
    return tabs.withColumn("form", header_key(F.col("tab"))).select(*ROW)


def append_batch(answers: DataFrame, table: Table, forms: Sequence[str], batch_ts: datetime) -> DataFrame:
    """Append every form's answers under one stamp; returns each form's row count and status.
    Answers of a form that is not expected are not stored, but have a row of status 404."""
    stamp = moment(batch_ts)
    expected = F.col("form").isin(list(forms))
    known = answers.where(expected)
    table.append(known.withColumns({"fechacarga": stamp, "dia": F.to_date(stamp)}))
    wanted = answers.sparkSession.createDataFrame([(f,) for f in forms], "form string")
    other = answers.where(~F.coalesce(expected, F.lit(False)))
    unknown = other.groupBy("form").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("code", F.lit(UNKNOWN))
    return fanout_status(known, wanted).unionByName(unknown)


def _answers_of(frame: DataFrame, form: str) -> DataFrame:
    """A form's frame as rows of the history; raises if columns are missing."""
    rows = align_to_target(frame, _ROW_TYPE, fill_missing=False)
    if len(rows.columns) < len(_ROW_TYPE):
        raise SchemaMismatch("missing: " + ", ".join(sorted(set(_ROW_TYPE.names) - set(rows.columns))))
    return rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns]).withColumn("form", F.lit(form))


def append_forms(
    frames: Mapping[str, DataFrame], table: Table, forms: Sequence[str], batch_ts: datetime, at_once: int = AT_ONCE
) -> tuple[DataFrame, int]:
    """Append one frame per form, each on its own: a form whose columns don't fit, or that fails while
    it is read, is recorded with its error and the others are stored. Returns every form's rows, code and
    message, and the overall code. A frame that nobody expects has a row of status 404 and isn't stored.

    Each form is read by a job of its own and committed to a table of its own; what has been committed
    goes into the history in one write, so a reader never sees half a batch.
    """
    spark = table.spark
    with scratch_scope(spark):
        jobs = {f: lambda f=f: written(_answers_of(frames[f], f), "form") for f in forms if f in frames}
        others = {f: lambda f=f: frames[f].count() for f in frames if f not in forms}
        done = run_each(spark, jobs | others, at_once)
        failed = [(f, 0, 500, message_of(e)) for f, e in done.items() if f in jobs and isinstance(e, Exception)]
        unknown = [
            (f, 0, UNKNOWN, message_of(n)) if isinstance(n, Exception) else (f, n, UNKNOWN, None) for f, n in done.items() if f in others
        ]
        stored = [rows for f, rows in done.items() if f in jobs and not isinstance(rows, Exception)]
        answers = reduce(DataFrame.unionByName, stored, spark.createDataFrame([], StructType([*_ROW_TYPE, StructField("form", StringType())])))
        report = append_batch(answers, table, [f for f in forms if f not in {x[0] for x in failed}], batch_ts)
        report = report.withColumn("message", F.lit(None).cast("string"))
        told = report.unionByName(spark.createDataFrame(failed + unknown, "form string, n_rows long, code int, message string"))
        rows = [tuple(r) for r in told.collect()]  # one for each form
    return spark.createDataFrame(rows, told.schema), overall_status(len(failed) + len(unknown), len(stored))


def clean_day(table: Table, as_of: date) -> DataFrame:
    """Drop the day's older batches, form by form; returns what was kept and how many rows went.

    Only that day's partition is read and rewritten, and not at all when nothing is stale.
    """
    day = F.lit(as_of).cast("date")
    rows = table.read(place="_place").where(F.col("dia") == day)
    summary = batch_summary(rows, ["form"], "fechacarga", day)
    report = [tuple(r) for r in summary.orderBy("form").collect()]  # one row per form
    if any(r[2] for r in report):
        table.replace_partitions(keep_last_batch(rows, ["form"], "fechacarga", spread_by=["_place"]))
    return table.spark.createDataFrame(report, summary.schema)
