"""Reports from kept state against the same reports from all rows."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lakeops.plans import anomaly, gaps
from lakeops.sources.tables import Table

AS_OF = date(2024, 2, 14)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- day sets ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def visits(spark):
    """(site, day): dense and sparse sites, one that is far busier, days before 1970 and after 2060, bad rows."""
    days = [(f" s{k % 9}_x{k % 2}", date(2023, 11, 20) + timedelta(days=(k * k) % 86)) for k in range(400)]
    days += [("hot", date(2024, 2, 1) + timedelta(days=k % 13)) for k in range(2000)]
    days += [("old", date(1969, 12, 31)), ("old", date(1960, 1, 1)), ("old", date(1970, 1, 1)), ("old", date(2061, 5, 5)), ("old", date(2024, 2, 6))]
    days += [(None, date(2024, 2, 1)), ("none", None), ("_", date(2024, 2, 1))]
    return spark.createDataFrame(days, "site string, day date").cache()


def test_sets_give_the_totals_of_all_rows(spark, visits, tmp_path):
    table = gaps.day_set_table(spark, str(tmp_path / "sets"))
    for k in range(5):  # batches by day, a late one and a repeated one
        gaps.load_days(visits.where(F.dayofmonth("day") % 5 == (k * 2) % 5), table, "site", "day")
    gaps.load_days(visits.where("day < '2024-01-01'"), table, "site", "day")
    want = gaps.gap_totals(visits, "site", "day", AS_OF)
    found = gaps.gap_totals_of_sets(table.read(), AS_OF)
    assert found.dtypes == want.dtypes and rows_of(found) == rows_of(want)
    report = gaps.gap_report_of_sets(table.read(), AS_OF)
    assert list(map(tuple, report.collect())) == list(map(tuple, gaps.gap_report(visits, "site", "day", AS_OF).collect()))


def test_every_day_of_the_week_counts_once(spark):
    """Whatever its place among the bits."""
    for shift in range(9):
        days = [date(2024, 1, 1) + timedelta(days=d) for d in range(0, 60, 1 + shift)]
        rows = spark.createDataFrame([("a", d) for d in days], "site string, day date")
        as_of = AS_OF + timedelta(days=shift)
        assert rows_of(gaps.gap_totals_of_sets(gaps.day_sets(rows, "site", "day"), as_of)) == rows_of(gaps.gap_totals(rows, "site", "day", as_of))


def test_report_reads_only_sets(spark, visits, tmp_path):
    table = gaps.day_set_table(spark, str(tmp_path / "sets"))
    gaps.load_days(visits, table, "site", "day")
    plan = gaps.gap_report_of_sets(table.read(), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "RDDScan" not in plan
    gaps.load_days(visits.limit(0), table, "site", "day")
    assert table.read().count() == 14  # s0 to s8, hot, a blank one, and old in three stretches


# --- anomalies from a kept state -----------------------------------------------------------------------


def daily(spark):
    """Sites whose last days differ by months, and one with most of the rows."""
    rows = []
    for k in range(30):
        end = date(2024, 1, 31) - timedelta(days=(k % 6) * 45)
        for d in range(60):
            day, spike = end - timedelta(days=d), 9 if d in (1, 3) and k % 2 else 1
            rows.append((f"s{k}", "o1", 10.0 * spike + (d * k) % 3, day))
            if k % 5 == 0:
                rows.append((f"s{k}", "o0", 4.0 + d % 2, day))
    rows += [("hot", f"o{j}", 10.0 + (j % 7) * (40 if d == 2 else 1), date(2024, 1, 31) - timedelta(days=d)) for j in range(60) for d in range(40)]
    return spark.createDataFrame(rows, "site_name string, manage_object string, kwh double, fecha date")


@pytest.fixture
def stores(spark, tmp_path):
    days = Table(spark, str(tmp_path / "days"), "site_name string, manage_object string, kwh double, fecha date", partition_by=["fecha"])
    return days, anomaly.state_table(spark, str(tmp_path / "state"))


def series(rows):
    return anomaly.series(rows, "site_name", "fecha", "kwh", "manage_object")


@pytest.mark.parametrize("settings", [anomaly.AnomalySettings(cv_max=2.0), anomaly.AnomalySettings(14, 0.5, 3.0, 5, 4, rows_per_task=50)])
def test_state_gives_the_report_of_all_rows(spark, stores, settings, monkeypatch):
    days, state = stores
    rows = daily(spark).cache()
    for month in (4, 5, 6, 7, 8, 9, 10, 11, 12, 1, 11):  # the last one is repeated
        batch = rows.where(F.month("fecha") == month)
        days.replace_partitions(batch)
        anomaly.update_state(state, series(batch))
    written = []
    write = anomaly.written
    monkeypatch.setattr(anomaly, "written", lambda df, label, **k: written.append((label, df)) or write(df, label, **k))
    found = anomaly.report_of_store(days, state, "kwh", "manage_object", settings)
    labels = [label for label, _ in written if label != "site-state"]
    assert labels == ["site-window", "site-activity"]  # and the medians, in stats
    plan = dict(written)["site-window"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fecha" in plan or "fecha" in plan.split("PartitionFilters: [")[1].split("]")[0]
    rounded = lambda df: [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()]
    got, want = rounded(found), rounded(anomaly.anomaly_report(series(rows), settings))
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) > 10
    last = {r.site_name: r.last_anomaly for r in state.read().collect()}
    assert last["s1"] is not None and last["s2"] is None


def test_only_windows_are_opened(spark, stores):
    days, state = stores
    days.replace_partitions(daily(spark))
    anomaly.update_state(state, series(days.read().where("site_name in ('s0', 's5')")))  # ends 225 days apart
    ends = [r[0] for r in state.read().select("last_day").distinct().collect()]
    opened = days.read().where(anomaly.in_windows(ends, 30)).select("fecha").distinct()
    assert opened.count() == 60 < days.read().select("fecha").distinct().count()
    assert days.read().where(anomaly.in_windows([], 30)).count() == 0


def test_empty_stores(spark, stores):
    days, state = stores
    assert anomaly.report_of_store(days, state, "kwh", "manage_object").count() == 0
