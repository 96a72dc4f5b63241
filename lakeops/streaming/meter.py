"""The meter job as a stream: readings as they land -> hours, days and months.

Hours are the stream's windows: a streaming aggregation by site, object and time keeps each column's
greatest value, and the watermark lets the state of old hours go. Every micro-batch brings the hours
that have changed; they are merged into a table of hours by day, by the greater value, and the days and
months that they touch are summed again from that table.

So the stores are what the batch job makes of all rows at once, whatever the order of arrival: a late
reading (within the watermark) adds to its day, and a reading, file or micro-batch that comes again
changes nothing, also when a failed run starts anew from its checkpoint. A reading that is later than
the watermark is left out, as its hour's state is gone; ``lateness`` says how long that takes.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeops.operators import rollup
from lakeops.plans import meter
from lakeops.session import scratch_scope, written
from lakeops.sources.tables import Table

LATENESS = "7 days"
HOUR_SCHEMA = (
    f"{rollup.SITE} string, {rollup.OBJECT} string, {rollup.START} timestamp_ntz, {rollup.SUBNET} string, "
    + ", ".join(f"{c} {rollup.AMOUNT}" for c in rollup.HOURLY)
    + ", fecha date"
)


def hour_table(spark: SparkSession, path: str) -> Table:
    """Hours are in partitions by day, so a micro-batch reads and rewrites only the days that it touches."""
    return Table(spark, path, HOUR_SCHEMA, partition_by=["fecha"])


def hours_of(landing: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Each hour's greatest values, as a streaming aggregation of all-text landing rows."""
    readings = rollup.clean_readings(landing).withColumn(rollup.START, F.col(rollup.START).cast("timestamp"))
    return rollup.hour_dedup(readings.withWatermark(rollup.START, lateness))


def take_hours(changed: DataFrame, hours: Table, days: Table, months: Table, as_of: date) -> dict[str, object]:
    """Merge changed hours into the stores; the same hours again change nothing. Runs jobs."""
    with scratch_scope(changed.sparkSession):
        start = F.col(rollup.START).cast("timestamp_ntz")
        new = changed.withColumn(rollup.START, start).withColumn("fecha", F.to_date(rollup.START))
        new = written(new.select(*hours.schema.names), "changed-hours")
        merged = rollup.hour_dedup(hours.read_touched(new).unionByName(new)).withColumn("fecha", F.to_date(rollup.START))
        hours.replace_partitions(merged.select(*hours.schema.names))
        # All hours of the touched days are in the store now, so their days are whole.
        touched = hours.read_touched(new).join(new.select(rollup.SITE, rollup.OBJECT, "fecha").distinct(), [rollup.SITE, rollup.OBJECT, "fecha"], "left_semi")
        return meter.load_hours(written(touched.drop("fecha"), "touched-hours"), days, months, F.lit(as_of).cast("date"), "daily")


def stream_readings(
    landing: DataFrame, hours: Table, days: Table, months: Table, checkpoint: str, as_of: Callable[[], date], lateness: str = LATENESS, **trigger
) -> StreamingQuery:
    """Start the job over a streaming ``landing``. ``trigger`` is as for ``writeStream.trigger``, by default
    all that has landed. ``as_of`` is asked at each micro-batch; readings of later days wait in the hours."""

    def take(changed: DataFrame, _: int) -> None:
        take_hours(changed, hours, days, months, as_of())

    writer = hours_of(landing, lateness).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(take).trigger(**(trigger or {"availableNow": True})).start()
