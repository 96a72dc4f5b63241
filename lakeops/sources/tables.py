"""Tables kept as parquet: scans, and writes that never leave a half-replaced table behind."""

from __future__ import annotations

import hashlib
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from lakeops.session import merged


def _place() -> Column:
    """Where a row lies: file, then row. Stable over rereads, and distinct even for equal rows."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def scan(
    spark: SparkSession,
    table: str,
    columns: Sequence[str] | None = None,
    where: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Projected, filtered rows of a table or view; filter and columns reach the file scan."""
    rows = spark.table(table)
    if where:
        rows = rows.where(where)
    if columns:
        rows = rows.select(*columns)
    return rows if limit is None else rows.limit(limit)


def read_landing(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A parquet landing table with ``ord``, each row's place of arrival (file, then row)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).select("*", _place().alias("ord"))


def scan_jdbc(
    spark: SparkSession, url: str, table: str, partition: tuple[str, int, int, int] | None = None, **options: str
) -> DataFrame:
    """A database table, read in parallel by ``partition`` = (column, lower, upper, parts)."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition:
        column, lower, upper, parts = partition
        reader = reader.options(
            partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(parts)
        )
    return reader.load()


def run_query(spark: SparkSession, query: str | Callable[..., DataFrame], **args: object) -> DataFrame:
    """A parameterised SQL text, or a function that returns a DataFrame."""
    return query(**args) if callable(query) else spark.sql(query, args=args)


#: A level stays apart while it has more than so many times the bytes of all newer ones together, and
#: the generation while it has more than so many times the bytes of all levels.
LEVEL_FACTOR, BASE_FACTOR = 2, 2
BUCKET_BYTES = 256 << 20
#: Fewer deltas than this are left as they are.
FEW_DELTAS = 4
#: Keys of updates with more bytes than this, as stored, are not sent to every task of a read.
MOST_BYTES = 1 << 20
#: Hours after which the number of a writer that never finished holds up others no longer.
STALE_HOURS = 24
_claiming = threading.Lock()  # a local file system may create one file for two threads


def first_to_merge(sizes: Sequence[int], factor: int = LEVEL_FACTOR) -> int:
    """Of levels, the oldest first, the first of those that become one; their number if none do. What
    is left grows by more than ``factor`` from level to level, so levels are few."""
    for k in range(len(sizes) - 1):
        if sizes[k] <= factor * sum(sizes[k + 1 :]):
            return k
    return len(sizes)


def _stale_before() -> float:
    return time.time() * 1000 - STALE_HOURS * 3_600_000


class _Delta(NamedTuple):
    """Updates ``first`` to ``last``; a merged one takes the place of those within its range."""

    first: int
    last: int
    folder: str


class Table:
    """A parquet table at ``path``.

    Without partitions, each replacement is written whole to a new generation folder, and the
    newest finished generation is the table: readers see the old rows until the write has
    committed, and a failed write is never read. With ``partition_by``, only the partitions
    present in new rows are replaced, staged and moved by Spark's commit.

    A table without partitions but with a ``key`` takes updates as deltas: ``upsert`` writes the new
    rows beside the generation, and a reader takes the latest row of each key. Once there are some,
    every update merges deltas of like size into one, and all into a new generation when they are half
    of it, so what is written follows the batch (times a logarithm), and what is read has few parts.
    If large, it is bucketed by key: reading and updating it don't shuffle it. Each update claims
    its number, and each new generation its own, by a file that only one writer can create (as HDFS and
    cloud stores do); unfinished updates hold up the merge of later ones, not their writing or reading.

    Files of a table with a key have bloom filters on it, but for deltas, which are small beside it.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType | str,
        partition_by: Sequence[str] = (),
        key: Sequence[str] = (),
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.partition_by = list(partition_by)
        self.key = list(key)

    # Listing goes through Hadoop, so the path may be on any file system Spark knows.
    def _fs(self):
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    # A folder counts once it has this file, written after Spark's commit: Spark's own marker can be
    # switched off.
    _DONE = "_finished"
    _BUCKETS, _UPTO = "_buckets-", "_upto-"

    def _names(self, folder: str = "") -> list[str]:
        fs, path = self._fs()
        place = path(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []

    def _is_finished(self, name: str) -> bool:
        fs, path = self._fs()
        return fs.exists(path(f"{self.path}/{name}/{self._DONE}"))

    def _told(self, name: str, prefix: str) -> int | None:
        """A number that a folder's marker of this prefix has."""
        return next((int(n[len(prefix) :]) for n in self._names(name) if n.startswith(prefix)), None)

    def _generations(self) -> list[int]:
        return sorted(int(n[4:]) for n in self._names() if n.startswith("gen-") and self._is_finished(n))

    def _finish(self, folder: str, *marks: str) -> None:
        fs, path = self._fs()
        for mark in (*marks, self._DONE):
            fs.create(path(f"{folder}/{mark}"), True).close()

    def _folder(self, generation: int) -> str:
        return f"{self.path}/gen-{generation:08d}"

    def _upto(self) -> int:
        """The last update that the newest generation has in it."""
        generations = self._generations()
        return (self._told(f"gen-{generations[-1]:08d}", self._UPTO) or 0) if generations else 0

    def _deltas(self) -> list[_Delta]:
        """Updates on top of the newest generation, the oldest first, none within another's range."""
        found, upto = [], self._upto()
        for name in self._names():
            if name.startswith("delta-") and self._is_finished(name):
                first, last = map(int, name.split("-")[1:3])
                if first > upto:
                    found.append(_Delta(first, last, f"{self.path}/{name}"))
        found.sort(key=lambda d: (d.first, -d.last, d.folder))
        kept: list[_Delta] = []
        for delta in found:
            if not kept or delta.last > kept[-1].last:
                kept.append(delta)
        return kept

    def _take(self, claim: str) -> bool:
        """Whether this writer is the one to get the claim; one that is stale is taken over."""
        fs, path = self._fs()
        place = path(f"{self.path}/claims/{claim}")
        with _claiming:
            fs.mkdirs(place.getParent())
            if fs.exists(place):
                if fs.getFileStatus(place).getModificationTime() >= _stale_before():
                    return False
                fs.delete(place, False)
            try:
                fs.create(place, False).close()
                return True
            except Py4JJavaError:
                if fs.exists(place):
                    return False
                raise

    def _claim(self) -> int:
        """The next update's number, which no other writer gets."""
        number = max([self._upto(), *(int(n) for n in self._names("claims") if n.isdigit())]) + 1
        while not self._take(f"{number:08d}"):
            number += 1
        return number

    def _settled(self, deltas: Sequence[_Delta]) -> list[_Delta]:
        """Deltas older than any update that a writer is still at."""
        fs, path = self._fs()
        place = path(f"{self.path}/claims")
        done = {n for d in deltas for n in range(d.first, d.last + 1)}
        found = [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(place)] if fs.exists(place) else []
        since, upto = _stale_before(), self._upto()
        still = [int(n) for n, at in found if n.isdigit() and int(n) > upto and int(n) not in done and at >= since]
        return [d for d in deltas if not still or d.last < min(still)]

    def exists(self) -> bool:
        if self.partition_by:
            return any("=" in name for name in self._names())
        return bool(self._generations() or self._deltas())

    def read(self, place: str | None = None) -> DataFrame:
        """Current rows, if wanted with their ``place``; an empty frame when there is no table."""
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        if self.partition_by:
            return self._scan(self.path, place)
        generations, deltas = self._generations(), self._deltas()
        base = self._scan(self._folder(generations[-1]), place) if generations else None
        if not deltas:
            return base
        return self._latest(base, deltas, place)

    def _latest(self, base: DataFrame | None, deltas: Sequence[_Delta], place: str | None = None) -> DataFrame:
        """The latest row of each key."""
        if not self.key:
            raise ValueError(f"table {self.path} has updates; name its key to read them")
        latest = self._scan(deltas[0].folder, place)
        if len(deltas) > 1:
            numbered = [self._scan(d.folder, place).withColumn("_delta", F.lit(d.last)) for d in deltas]
            newest = Window.partitionBy(*self.key).orderBy(F.desc("_delta"))
            latest = reduce(DataFrame.unionByName, numbered).withColumn("_nth", F.row_number().over(newest)).where("_nth = 1")
            latest = latest.drop("_delta", "_nth")
        if base is None:
            return latest
        keys = latest.select(*self.key)
        small = sum(self._size(d.folder) for d in deltas) <= MOST_BYTES
        return base.join(keys if small else merged(keys), self.key, "left_anti").unionByName(latest)

    def _scan(self, folder: str, place: str | None) -> DataFrame:
        buckets = None if folder == self.path else self._told(folder.rsplit("/", 1)[-1], self._BUCKETS)
        rows = self._bucketed(folder, buckets) if buckets and self.key else self.spark.read.schema(self.schema).parquet(folder)
        return rows.select("*", _place().alias(place)) if place else rows

    def _catalog_name(self, folder: str) -> str:
        return f"lakeops_{hashlib.md5(folder.encode()).hexdigest()}"

    def _bucketed(self, folder: str, buckets: int) -> DataFrame:
        """A bucketed folder, of which Spark only knows the buckets by a name in the session's catalog."""
        name = self._catalog_name(folder)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
            keys = ", ".join(f"`{k}`" for k in self.key)
            by = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS"
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {by} LOCATION '{folder}'")
        return self.spark.table(name)

    def _write_bucketed(self, df: DataFrame, folder: str, buckets: int) -> None:
        name = self._catalog_name(folder)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        rows = df.repartition(buckets, *[F.col(k) for k in self.key])
        writer = rows.write.bucketBy(buckets, *self.key).sortBy(*self.key).options(path=folder, **self._filters())
        writer.format("parquet").mode("overwrite").saveAsTable(name)

    def _filters(self) -> dict[str, str]:
        sized = {"parquet.bloom.filter.adaptive.enabled": "true"} if self.key else {}  # by the keys there are
        return sized | {f"parquet.bloom.filter.enabled#{k}": "true" for k in self.key}

    def _size(self, folder: str) -> int:
        fs, path = self._fs()
        return fs.getContentSummary(path(folder)).getLength()

    def read_touched(self, batch: DataFrame) -> DataFrame:
        """Current rows of the partitions that ``batch`` has rows for; all rows without partitions.

        Runs a job over ``batch``, which should be a written table. The values found name
        directories, so they are few; as literals they prune the scan.
        """
        rows = self.read()
        for column in self.partition_by:
            values = [r[0] for r in batch.select(column).distinct().collect()]
            among = F.col(column).isin([v for v in values if v is not None])
            rows = rows.where(among | F.col(column).isNull() if None in values else among)
        return rows

    def _conform(self, df: DataFrame) -> DataFrame:
        rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
        if not self.partition_by:
            return rows
        # Else every task would write a file into every partition. AQE splits a large partition
        # over several tasks and joins small ones.
        return rows.hint("rebalance", *[F.col(c) for c in self.partition_by])

    def append(self, df: DataFrame) -> None:
        df = self._conform(df)
        if self.partition_by:
            df.write.mode("append").options(**self._filters()).partitionBy(*self.partition_by).parquet(self.path)
            return
        if self._deltas():
            raise ValueError(f"table {self.path} has updates; compact it before plain rows are appended")
        generations = self._generations()
        folder = self._folder(generations[-1] if generations else 1)
        if generations and self._told(folder.rsplit("/", 1)[-1], self._BUCKETS):
            self.upsert(df)
            return
        df.write.mode("append").options(**self._filters()).parquet(folder)
        self._finish(folder)

    def upsert(self, df: DataFrame) -> None:
        """Add rows and replace those of equal key; ``df`` has one row per key and may read this very
        table. Merges what has become of like size."""
        if self.partition_by or not self.key:
            raise ValueError("updates need a key, and partitions are replaced whole")
        number = self._claim()
        folder = f"{self.path}/delta-{number:08d}-{number:08d}"
        try:
            self._conform(df).write.mode("overwrite").parquet(folder)
        except BaseException:
            self._delete([f"{self.path}/claims/{number:08d}", folder])
            raise
        self._finish(folder)
        self._settle()

    def _settle(self) -> None:
        """Merge deltas that have become of like size, or all into a generation once they are half of it."""
        deltas = self._settled(self._deltas())
        if len(deltas) < FEW_DELTAS:
            return
        sizes, generations = [self._size(d.folder) for d in deltas], self._generations()
        if not generations or BASE_FACTOR * sum(sizes) >= self._size(self._folder(generations[-1])):
            self._compact(deltas)
            return
        alike = deltas[first_to_merge(sizes) :]
        if alike:
            folder = f"{self.path}/delta-{alike[0].first:08d}-{alike[-1].last:08d}-{uuid.uuid4().hex[:8]}"
            self._latest(None, alike).write.parquet(folder)
            self._finish(folder)
            self._sweep()

    def compact(self) -> None:
        """Make one generation of the table and its finished updates."""
        deltas = self._settled(self._deltas())
        if deltas:
            self._compact(deltas)

    def _compact(self, deltas: Sequence[_Delta]) -> None:
        generations = self._generations()
        number = generations[-1] + 1 if generations else 1
        if not self._take(f"gen-{number:08d}"):
            return  # another writer is at it
        base = self._scan(self._folder(generations[-1]), None) if generations else None
        size = sum(self._size(d.folder) for d in deltas) + (self._size(self._folder(generations[-1])) if generations else 0)
        # Spark shuffles a table of fewer buckets than its shuffles have partitions; a small one may be.
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(tasks, -(-size // BUCKET_BYTES)) if size > BUCKET_BYTES else 0
        self._generate(self._latest(base, deltas), number, deltas[-1].last, buckets)

    def replace(self, df: DataFrame) -> None:
        """New content; ``df`` may read this very table."""
        if self.partition_by:
            self._conform(df).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
                *self.partition_by
            ).parquet(self.path)
            return
        deltas, number = self._deltas(), max([0, *self._generations()]) + 1
        while not self._take(f"gen-{number:08d}"):
            number += 1
        self._generate(df, number, deltas[-1].last if deltas else self._upto())

    def _generate(self, df: DataFrame, number: int, upto: int, buckets: int = 0) -> None:
        """A new generation, which has all updates up to ``upto`` in it. Its claim goes if it fails."""
        df, folder = self._conform(df), self._folder(number)
        try:
            if buckets:
                self._write_bucketed(df, folder, buckets)
            else:
                df.write.mode("overwrite").options(**self._filters()).parquet(folder)
        except BaseException:
            self._delete([f"{self.path}/claims/gen-{number:08d}"])
            raise
        self._finish(folder, f"{self._UPTO}{upto}", *([f"{self._BUCKETS}{buckets}"] if buckets else []))
        self._sweep()

    def _delete(self, paths: Iterable[str]) -> None:
        fs, path = self._fs()
        for name in paths:
            fs.delete(path(name), True)
            if "/gen-" in name:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._catalog_name(name)}")

    def _sweep(self) -> None:
        """Delete what is two steps behind: the previous generation with its updates, and deltas that were
        merged last, stay for readers that began before."""
        generations, names = self._generations(), self._names()
        old = [f"gen-{g:08d}" for g in generations[:-2]]
        before = (self._told(f"gen-{generations[-2]:08d}", self._UPTO) or 0) if len(generations) > 1 else 0
        ranges = {n: tuple(map(int, n.split("-")[1:3])) for n in names if n.startswith("delta-")}
        old += [n for n, (_, last) in ranges.items() if last <= before]
        whole = [r for n, r in ranges.items() if len(n.split("-")) > 3 and self._is_finished(n)]
        # within a merged delta that lies in another one
        inner = [a for a in whole if any(a != b and b[0] <= a[0] and a[1] <= b[1] for b in whole)]
        old += [n for n, r in ranges.items() if any(a != r and a[0] <= r[0] and r[1] <= a[1] for a in inner)]
        claims = [f"claims/{n}" for n in self._names("claims") if n.isdigit() and int(n) <= before or n[4:] in {o[4:] for o in old if o.startswith("gen-")}]
        self._delete(f"{self.path}/{n}" for n in dict.fromkeys([*old, *claims]))

    def replace_partitions(self, df: DataFrame) -> None:
        """Replace only the partitions present in ``df``, which may read this very table."""
        if not self.partition_by:
            raise ValueError("the table has no partitions")
        self._conform(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *self.partition_by
        ).parquet(self.path)


def load_frame(df: DataFrame, table: Table, mode: str = "replace") -> dict[str, object]:
    """Write a frame by policy ``replace``, ``append`` or ``fail``; an empty frame is refused."""
    if mode not in ("replace", "append", "fail"):
        raise ValueError(f"unknown mode {mode!r}")
    if df.isEmpty():
        raise ValueError("no rows to insert")
    if mode == "fail" and table.exists():
        raise ValueError(f"table {table.path} already exists")
    (table.append if mode == "append" else table.replace)(df)
    return {"status": "success", "code": 200}


def export_csv(df: DataFrame, path: str, zone: str = "America/Lima", overwrite: bool = True, mark: bool = True) -> str:
    """CSV with header; zoned timestamps are shown as local time of ``zone``. Every file begins with a
    byte order mark, by which spreadsheets know UTF-8, unless ``mark`` is off. A quote inside a field
    is doubled."""
    local = {
        f.name: F.convert_timezone(F.current_timezone(), F.lit(zone), F.col(f.name).cast("timestamp_ntz"))
        for f in df.schema
        if isinstance(f.dataType, TimestampType)
    }
    shown = df.withColumns(local) if local else df
    if mark and df.columns:
        shown = shown.toDF("\ufeff" + shown.columns[0], *shown.columns[1:])
    shown.write.mode("overwrite" if overwrite else "errorifexists").options(header=True, escape='"').csv(path)
    return path
