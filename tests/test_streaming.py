"""The meter stream against the batch job over all rows at once."""

from datetime import date, datetime
from pathlib import Path

import pytest

from lakeops.operators import rollup
from lakeops.plans import meter
from lakeops.streaming import meter as stream

END = date(2024, 3, 31)
COLUMNS = "site_name string, subnet string, manage_object string, start_time string, " + ", ".join(f"{c} string" for c in rollup.HOURLY)


def reading(site, day, hour, kwh, subnet="n"):
    at = datetime(2024, 3, day, hour)
    return (f" s{site}", subnet, "o", f"{at}", f"{kwh}", "1", f"{2 * kwh} kWh")


def rows(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


@pytest.fixture
def stores(spark, tmp_path):
    def make(name):
        return meter.day_table(spark, str(tmp_path / name / "days")), meter.month_table(spark, str(tmp_path / name / "months"))

    return make


@pytest.fixture
def landing(spark, tmp_path):
    folder, files = tmp_path / "landing", []

    def land(readings):
        spark.createDataFrame(readings, COLUMNS).coalesce(1).write.mode("append").parquet(str(folder))
        files.append(readings)

    land.folder, land.files = str(folder), files
    return land


def run(spark, landing, tmp_path, stores, lateness="20 days"):
    source = spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", 1).parquet(landing.folder)
    hours = stream.hour_table(spark, str(tmp_path / "hours"))
    query = stream.stream_readings(source, hours, *stores, str(tmp_path / "checkpoint"), lambda: END, lateness)
    query.awaitTermination()
    return query


def test_late_and_repeated_batches(spark, landing, tmp_path, stores):
    first = [reading(k % 3, 5 + k // 24, k % 24, k) for k in range(72)]
    late = [reading(k % 3, 5, 23, 500 + k) for k in range(3)] + [reading(7, 4, 1, 9)]
    streamed, batch = stores("stream"), stores("batch")
    landing(first)
    landing([reading(1, 20, h, h) for h in range(24)] + [reading(1, 20, 3, 1, "z")])
    landing(late)  # days after its time, within the watermark
    run(spark, landing, tmp_path, streamed)
    landing(first)  # the same readings land again, in a later run
    landing(late + [("NaN", "n", "o", "2024-03-05 01:00:00", "1", "1", "1"), (" s1", "n", "o", "-", "1", "1", "1")])
    run(spark, landing, tmp_path, streamed)
    everything = spark.createDataFrame([r for f in landing.files for r in f], COLUMNS)
    meter.load_readings(spark, everything, *batch, END)
    assert [rows(t) for t in streamed] == [rows(t) for t in batch] and len(rows(batch[0])) == 11


def test_a_micro_batch_twice_is_once(spark, landing, tmp_path, stores):
    days, months = stores("once")
    hours = stream.hour_table(spark, str(tmp_path / "hours"))
    changed = rollup.hour_dedup(rollup.clean_readings(spark.createDataFrame([reading(k % 2, 3, k, k) for k in range(20)], COLUMNS)))
    stream.take_hours(changed, hours, days, months, END)
    before = [rows(t) for t in (hours, days, months)]
    again = stream.take_hours(changed, hours, days, months, END)
    assert [rows(t) for t in (hours, days, months)] == before and again["inserted"] == 0
    stream.take_hours(changed.limit(0), hours, days, months, END)
    assert [rows(t) for t in (hours, days, months)] == before


def test_what_is_later_than_the_watermark_is_left_out(spark, landing, tmp_path, stores):
    streamed = stores("stream")
    landing([reading(1, 2, 5, 10)])
    landing([reading(1, 25, h, 1) for h in range(3)])
    landing([reading(1, 26, 0, 1)])
    landing([reading(1, 2, 6, 99)])  # more than two days behind
    query = run(spark, landing, tmp_path, streamed, "2 days")
    assert {r.fecha.day: float(r.energy_consumption_per_day_kwh) for r in streamed[0].read().collect()} == {2: 10.0, 25: 3.0, 26: 1.0}
    state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert state[-1] < 5  # old hours have left the state


def test_a_landing_is_written_by_many_tasks(spark, tmp_path):
    """The query's input grows with the events, so no single task may write it or read it back."""
    from catalog.loading import meter_stream_days
    from lakeops.session import scratch_path

    spark.range(240).selectExpr(
        "id AS event_id", "timestamp '2024-01-01' + make_interval(0, 0, 0, 0, id) AS ts", "id % 3 AS user_id", "'view' AS event_type",
        "cast(id as double) AS value", "'' AS props",
    ).repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    folder = Path(scratch_path(spark, "x")).parent
    before = set(folder.glob("landing-*"))
    assert meter_stream_days(spark, str(tmp_path)).count() == 30
    (landing,) = set(folder.glob("landing-*")) - before
    assert len(list(landing.glob("part-*"))) > 2
