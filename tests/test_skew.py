"""The paths for hot keys, forced by tiny limits, against brute force."""

import random
import statistics
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeops.operators import dedup, quarantine
from lakeops.operators.skew import attach_facts, heaviest, write_facts
from lakeops.operators.stats import group_stats
from lakeops.plans import anomaly


@pytest.fixture(scope="module")
def hot_rows(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        k = "hot" if i % 3 == 0 else None if i % 29 == 0 else f"k{rng.randrange(200)}"
        rows.append((i, k, rng.choice([None, "p", "q"]), round(rng.gauss(50, 20), 2)))
    return rows


SCHEMA = "i int, k string, p string, v double"


@pytest.mark.parametrize("limit", [None, 50, 5, 1])
def test_attach_facts_equals_plain_join(spark, hot_rows, limit):
    df = spark.createDataFrame(hot_rows, SCHEMA)
    facts = df.groupBy("k", "p").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("top"))
    got = attach_facts(df, write_facts(facts, "n"), ["k", "p"], spread_by=["i"], null_safe=["k", "p"], rows_per_task=limit)
    count, top = Counter((r[1], r[2]) for r in hot_rows), defaultdict(lambda: -1e9)
    for _, k, p, v in hot_rows:
        top[k, p] = max(top[k, p], v)
    want = sorted((i, count[k, p], top[k, p]) for i, k, p, _ in hot_rows)
    assert sorted((r.i, r.n, r.top) for r in got.collect()) == want


def test_hot_key_is_spread(spark, hot_rows):
    df = spark.createDataFrame(hot_rows, SCHEMA).where("k is not null")
    facts = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert [r.k for r in heaviest(facts, ["k"], "n", 100).collect()] == ["hot"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = attach_facts(df, write_facts(facts, "n"), ["k"], spread_by=["i"], rows_per_task=100)
        tasks = joined.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 * 1024 * 1024)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["count"] for r in tasks) == 1000
    assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 600


@pytest.mark.parametrize("limit", [None, 100, 1])
def test_median_of_large_groups_is_exact(spark, hot_rows, limit):
    rows = [(k, v) for _, k, _, v in hot_rows if k] + [("one", 4.0), ("pair", 1.0), ("pair", 2.0)] + [("same", 3.0)] * 500
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r for r in group_stats(df, ["k"], "v", rows_per_task=limit).collect()}
    groups = defaultdict(list)
    for k, v in rows:
        groups[k].append(v)
    assert set(got) == set(groups)
    for k, values in groups.items():
        assert got[k].n == len(values)
        assert got[k].median == pytest.approx(statistics.median(values), abs=1e-9)
        if len(values) > 1:
            assert got[k]["std"] == pytest.approx(statistics.stdev(values), abs=1e-9)
        else:
            assert got[k]["std"] is None


def test_median_bracket_failure_is_still_exact(spark, monkeypatch):
    """A bracket that misses the median must not change the result."""
    from lakeops.operators import stats

    monkeypatch.setattr(stats, "_SLACK", -0.2)
    values = [float(i * i % 9973) for i in range(2001)]
    df = spark.createDataFrame([("g", v) for v in values], "k string, v double")
    row = group_stats(df, ["k"], "v", rows_per_task=10).first()
    assert row.median == statistics.median(values)


@pytest.mark.parametrize("limit", [None, 20, 1])
def test_mark_rejects_with_hot_copies(spark, hot_rows, limit):
    df = spark.createDataFrame(hot_rows, SCHEMA)
    rules = {"low": F.col("v") < 20}
    marked = quarantine.mark_rejects(df, rules, {"k": F.col("k"), "p": F.col("p")}, spread_by=["i"], rows_per_task=limit)
    kept = Counter((k, p) for _, k, p, v in hot_rows if v >= 20 and k is not None)
    want = {i: "low" if v < 20 else "duplicate" if kept[k, p] > 1 else None for i, k, p, v in hot_rows}
    got = {r.i: r._reason for r in marked.collect()}
    assert got == want
    assert marked.count() == len(hot_rows)
    assert marked.columns == [*df.columns, "_reason"]


@pytest.mark.parametrize("limit", [None, 10])
def test_keep_last_batch_with_hot_form(spark, limit):
    rows = [(i, "hot" if i % 3 else f"f{i % 5}", datetime(2024, 1, 1 + i % 2, i % 4)) for i in range(400)]
    df = spark.createDataFrame(rows, "i int, form string, at timestamp_ntz")
    last = defaultdict(lambda: datetime.min)
    for _, f, at in rows:
        last[f, at.date()] = max(last[f, at.date()], at)
    got = dedup.keep_last_batch(df, ["form"], "at", spread_by=["i"], rows_per_task=limit)
    assert sorted(r.i for r in got.collect()) == [i for i, f, at in rows if at == last[f, at.date()]]
    again = dedup.keep_last_batch(got, ["form"], "at", spread_by=["i"], rows_per_task=limit)
    assert again.count() == got.count()


def _series(days=40, sites=12, seed=3):
    rng = random.Random(seed)
    rows = []
    for s in range(sites):
        objects = 40 if s == 0 else 2  # one site holds most rows
        for d in range(days):
            for o in range(objects):
                if rng.random() < 0.9:
                    base = 100 + rng.gauss(0, 5)
                    value = base * (2.2 if rng.random() < 0.03 else 1)
                    rows.append((f"s{s}", f"o{o:02d}", date(2024, 1, 1) + timedelta(d), round(value, 3)))
    return rows + [("quiet", "o", date(2024, 1, 1), 5.0), ("zero", "o", date(2024, 1, 1), 0.0)]


def _brute_report(rows, s):
    by_site = defaultdict(list)
    for site, obj, day, value in rows:
        by_site[site].append((day, obj, value))
    report = []
    for site, items in by_site.items():
        end = max(d for d, _, _ in items)
        window = [x for x in items if x[0] >= end - timedelta(s.window_days - 1)]
        values = [v for _, _, v in window]
        median = statistics.median(values)
        std = statistics.stdev(values) if len(values) > 1 else None
        if median <= 0 or std is None or std / median > s.cv_max:
            continue
        hits = [x for x in window if (x[2] - median) / median * 100 >= s.pct_threshold * 100]
        if not hits:
            continue
        last = max(d for d, _, _ in hits)
        if s.normal_streak > 0 and sum(d > last for d, _, _ in window) >= s.normal_streak:
            continue
        first = {}
        for d, o, v in sorted(window):
            first.setdefault(d, v)
        recent = [first.get(end - timedelta(s.recent_days - i)) for i in range(1, s.recent_days + 1)]
        for d, _, v in hits:
            if v > median and (s.recent_days <= 0 or d >= end - timedelta(s.recent_days - 1)):
                report.append((site, d, v, round(median, 6), round(std, 6), len(window), *recent))
    return sorted(report, key=lambda r: (r[0], r[1], r[2]))


@pytest.mark.parametrize("limit", [None, 25])
@pytest.mark.parametrize("recent, streak", [(7, 30), (0, 0), (3, 3)])
def test_anomaly_report_brute_force(spark, limit, recent, streak):
    rows = _series()
    settings = anomaly.AnomalySettings(recent_days=recent, normal_streak=streak, rows_per_task=limit)
    df = spark.createDataFrame(rows, "site string, obj string, day date, value double")
    report = anomaly.anomaly_report(anomaly.series(df, "site", "day", "value", tie="obj"), settings)
    pivots = [c for c in report.columns if c.startswith(anomaly.RECENT_PREFIX)]
    got = [
        (r.site_name, r.fecha, r.consumo, round(r.median_30d, 6), round(r.std_30d, 6), r.window_samples, *[r[c] for c in pivots])
        for r in report.collect()
    ]
    want = _brute_report(rows, settings)
    assert want and sorted(got, key=lambda r: r[:3]) == want
    assert [g[:2] for g in got] == sorted(g[:2] for g in got)


def test_first_row_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ord"))
    plan = dedup.first_arrival(df, ["k"], "ord")._jdf.queryExecution().executedPlan().toString()
    # Printed top down: the final limit, the shuffle, then the limit inside each map task.
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert plan.count("WindowGroupLimit") >= 2


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    facts = write_facts(empty.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "n")
    assert facts.largest == 0
    assert attach_facts(empty, facts, ["k"], spread_by=["i"]).isEmpty()
    marked = quarantine.mark_rejects(empty, {}, {"k": F.col("k")}, spread_by=["i"])
    assert marked.isEmpty() and marked.columns == ["i", "k", "p", "v", "_reason"]
    none = spark.createDataFrame([], "site string, day date, value double")
    assert anomaly.anomaly_report(anomaly.series(none, "site", "day", "value")).isEmpty()


def test_hot_keys_are_bounded_by_their_share(spark):
    """However many keys there are, fewer than HOT_SHARE are hot, and none is left out."""
    from lakeops.operators.skew import HOT_SHARE

    keys = spark.range(20_000).select(F.col("id").alias("k"), F.when(F.col("id") < 30, 5000 + F.col("id")).otherwise(1 + F.col("id") % 9).alias("n"))
    facts = write_facts(keys, "n")
    limit = facts.limit()
    hot = {r.k for r in heaviest(facts.rows, ["k"], "n", limit).collect()}
    assert hot == {r.k for r in keys.where(F.col("n") > limit).collect()} >= set(range(30))
    assert len(hot) < HOT_SHARE


def test_keep_last_batch_keeps_nulls(spark):
    """Rows without a form are a form, rows without a stamp are never judged."""
    at = lambda d, h: datetime(2024, 1, d, h)
    rows = [(1, None, at(1, 1)), (2, None, at(1, 2)), (3, "a", None), (4, None, None), (5, "a", at(1, 1)), (6, "a", at(2, 1)), (7, "a", at(1, 3))]
    df = spark.createDataFrame(rows, "i int, form string, at timestamp_ntz")
    for day, want in ((None, [2, 3, 4, 6, 7]), (date(2024, 1, 1), [2, 3, 4, 6, 7]), (date(2024, 1, 2), [1, 2, 3, 4, 5, 6, 7])):
        kept = dedup.keep_last_batch(df, ["form"], "at", spread_by=["i"], day=None if day is None else F.lit(day))
        assert sorted(r.i for r in kept.collect()) == want
