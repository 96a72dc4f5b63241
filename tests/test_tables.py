import hashlib
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from lakeops.operators import load
from lakeops.sources import tables
from lakeops.sources.tables import Table, first_to_merge, load_frame, read_landing, run_query, scan


def _ids(spark, n, start=0):
    return spark.range(start, start + n).select("id", (F.col("id") % 3).alias("part"))


@pytest.fixture
def table(spark, tmp_path):
    return Table(spark, str(tmp_path / "t"), "id bigint, part bigint")


def test_missing_table_reads_empty(table):
    assert not table.exists() and table.read().count() == 0


def test_replace_then_append(spark, table):
    assert load_frame(_ids(spark, 250), table, "append")["code"] == 200
    load_frame(_ids(spark, 5), table, "replace")
    load_frame(_ids(spark, 3), table, "append")
    assert table.read().count() == 8


def test_fail_mode(spark, table):
    load_frame(_ids(spark, 1), table, "fail")
    with pytest.raises(ValueError, match="already exists"):
        load_frame(_ids(spark, 1), table, "fail")


def test_empty_and_unknown_mode_are_refused(spark, table):
    with pytest.raises(ValueError, match="no rows"):
        load_frame(_ids(spark, 0), table)
    with pytest.raises(ValueError, match="unknown mode"):
        load_frame(_ids(spark, 1), table, "upsert")
    assert not table.exists()


def test_replace_may_read_itself(spark, table):
    table.replace(_ids(spark, 10))
    for _ in range(3):
        table.replace(table.read().withColumn("id", F.col("id") + 1))
    assert table.read().agg(F.min("id"), F.max("id")).first()[:] == (3, 12)


def test_failed_replace_leaves_the_old_rows(spark, table):
    table.replace(_ids(spark, 4))
    broken = _ids(spark, 4).withColumn("id", F.expr("CASE WHEN id = 3 THEN raise_error('no') ELSE id END").cast("bigint"))
    with pytest.raises(Exception, match="no"):
        table.replace(broken)
    assert table.read().count() == 4


def test_unfinished_generation_is_not_read(spark, table, tmp_path):
    table.replace(_ids(spark, 4))
    (tmp_path / "t" / "gen-00000009").mkdir()
    assert table.read().count() == 4


def test_replace_partitions_touches_only_those(spark, tmp_path):
    table = Table(spark, str(tmp_path / "p"), "id bigint, part bigint", partition_by=["part"])
    assert not table.exists()
    table.replace_partitions(_ids(spark, 9))
    assert table.exists()
    table.replace_partitions(table.read().where("part = 1").withColumn("id", F.col("id") * 100))
    assert sorted(r.id for r in table.read().collect()) == [0, 2, 3, 5, 6, 8, 100, 400, 700]
    plan = table.read().where("part = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_partitioned_writes_make_few_files(spark, tmp_path):
    table = Table(spark, str(tmp_path / "p"), "id bigint, part bigint", partition_by=["part"])
    table.replace_partitions(_ids(spark, 3000).repartition(8, "id"))
    assert len(list((tmp_path / "p").glob("part=*/*.parquet"))) <= 6
    places = table.read(place="at").select("at").distinct()
    assert places.count() == 3000


def test_replace_partitions_needs_partitions(spark, table):
    with pytest.raises(ValueError, match="no partitions"):
        table.replace_partitions(_ids(spark, 1))


def test_landing_order_follows_files(spark, tmp_path):
    path = str(tmp_path / "landing")
    spark.range(100).repartition(1).write.parquet(path)
    rows = read_landing(spark, path).orderBy("ord").select("id", "ord.row").collect()
    assert [r.row for r in rows] == list(range(100))


def test_scan_pushes_down(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.range(50).withColumn("x", F.col("id") * 2).withColumn("y", F.lit("z")).write.parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("scan_test")
    rows = scan(spark, "scan_test", ["id"], "x > 20", 5)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(x,20)" in plan and "struct<id:bigint,x:bigint>" in plan
    assert rows.count() == 5


def test_run_query(spark):
    assert run_query(spark, "SELECT :a + 1 AS b", a=4).first().b == 5
    assert run_query(spark, lambda n: spark.range(n), n=3).count() == 3


# --- levels of updates ------------------------------------------------------------------------------


@pytest.fixture
def keyed(spark, tmp_path):
    return Table(spark, str(tmp_path / "k"), "k bigint, v bigint", key=["k"])


def _batch(spark, begin, end, v):
    return spark.range(begin, end).select(F.col("id").alias("k"), F.lit(v).cast("bigint").alias("v"))


def test_first_to_merge():
    assert [first_to_merge(x) for x in ([], [5], [5, 1], [5, 3], [40, 5, 3], [100, 30, 9, 2], [4, 4, 4, 4])] == [0, 1, 2, 0, 1, 4, 0]
    sizes = []
    for _ in range(1000):
        sizes.append(1)
        at = first_to_merge(sizes)
        sizes[at:] = [sum(sizes[at:])] if sizes[at:] else []
        assert len(sizes) <= 8 and sum(sizes) == _ + 1


def test_fifty_updates(spark, keyed, tmp_path, monkeypatch):
    """Deltas stay few, what is written stays near the batches, and the base is read without an exchange."""
    monkeypatch.setattr(tables, "BUCKET_BYTES", 100_000)
    keyed.replace(_batch(spark, 0, 60_000, -1))
    want = {k: -1 for k in range(60_000)}
    for n in range(50):
        begin = (n * 7919) % 50_000
        keyed.upsert(_batch(spark, begin, begin + 300, n))
        want |= {k: n for k in range(begin, begin + 300)}
    assert len(keyed._deltas()) <= 7
    assert {r.k: r.v for r in keyed.read().collect()} == want
    keyed.compact()
    assert not keyed._deltas() and {r.k: r.v for r in keyed.read().collect()} == want
    keyed.upsert(_batch(spark, 10, 20, 99))
    keyed.upsert(_batch(spark, 15, 25, 100))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = keyed.read()._jdf.queryExecution().executedPlan().toString()
        left = plan[plan.index("SortMergeJoin") :]
        assert "Bucketed: true" in left and "Exchange" not in left[: left.index("FileScan")]
        assert keyed.read().where("v in (99, 100)").count() == 15
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 * 1024 * 1024)
    assert len(list((tmp_path / "k").glob("gen-*"))) <= 2 and len(list((tmp_path / "k").glob("delta-*"))) < 40


def test_two_writers_take_two_numbers(spark, keyed):
    keyed.upsert(_batch(spark, 0, 5, 1))
    numbers = {Table(spark, keyed.path, keyed.schema, key=["k"])._claim() for _ in range(3)}
    assert numbers == {2, 3, 4}
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda n: Table(spark, keyed.path, keyed.schema, key=["k"]).upsert(_batch(spark, 100 * n, 100 * n + 7, n)), range(1, 9)))
    assert keyed.read().count() == 5 + 8 * 7


def test_unfinished_updates_hold_up_merges_only(spark, keyed, monkeypatch):
    keyed.replace(_batch(spark, 0, 10, 0))
    other = Table(spark, keyed.path, keyed.schema, key=["k"])
    number = other._claim()  # a writer that has not finished
    for n in range(1, 7):
        keyed.upsert(_batch(spark, n, n + 3, n))
    assert len(keyed._deltas()) == 6 and {r.k: r.v for r in keyed.read().collect()}[3] == 3
    other._conform(_batch(spark, 3, 4, 50)).write.parquet(f"{keyed.path}/delta-{number:08d}-{number:08d}")
    other._finish(f"{keyed.path}/delta-{number:08d}-{number:08d}")
    keyed.upsert(_batch(spark, 0, 1, 7))  # the late one is older than those that came after it
    assert len(keyed._deltas()) < 3 and {r.k: r.v for r in keyed.read().collect()} == {0: 7, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6, 8: 6, 9: 0}
    keyed._claim()  # one that never will
    monkeypatch.setattr(tables, "STALE_HOURS", -1)
    for n in range(4):
        keyed.upsert(_batch(spark, n, n + 1, 60 + n))
    assert len(keyed._deltas()) < 4


def test_failed_update_leaves_no_claim(spark, keyed):
    keyed.upsert(_batch(spark, 0, 3, 1))
    with pytest.raises(Exception, match="spoilt"):
        keyed.upsert(_batch(spark, 0, 3, 2).withColumn("v", F.raise_error(F.lit("spoilt")).cast("bigint")))
    assert keyed.read().where("v = 1").count() == 3 and keyed._claim() == 2


def test_appends_after_a_compaction(spark, keyed, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_BYTES", 100)
    for n in range(4):
        keyed.upsert(_batch(spark, n, n + 2, n))
    assert keyed._generations() == [1] and not keyed._deltas()
    keyed.append(_batch(spark, 50, 60, 9))
    assert keyed.read().count() == 15


# --- files that may hold a key -------------------------------------------------------------------------


def _rows_read(df):
    """Rows of the row groups that the scan has opened."""
    df.collect()
    plan, rows = df._jdf.queryExecution().executedPlan(), 0
    todo = [plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in plan.getClass().getName() else plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("Scan parquet"):
            rows += node.metrics().get("numOutputRows").get().value()
        if "QueryStage" in node.getClass().getName():
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return rows


def test_only_row_groups_that_may_hold_a_key(spark, tmp_path):
    store = Table(spark, str(tmp_path / "b"), "k string, v bigint", key=["k"])
    rows = spark.range(40_000).select(F.sha1(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    spark.conf.set("parquet.block.size", 1 << 17)
    try:
        store.append(rows.repartition(4, "v"))
    finally:
        spark.conf.unset("parquet.block.size")
    staged = spark.createDataFrame([(hashlib.sha1(str(i).encode()).hexdigest(),) for i in (17, 39_000)] + [("none",)], "k string")
    found = load.stored_like_few(store.read(), staged, ["k"])
    assert sorted(r.v for r in found.collect()) == [17, 39_000]
    assert _rows_read(found) < 40_000 / 3
    assert _rows_read(load.stored_like(store.read(), staged, ["k"])) == 40_000
    assert load.stored_like_few(store.read(), staged, ["k"], most=2).count() == 2
    assert load.stored_like_few(store.read(), staged.limit(0), ["k"]).count() == 0
