"""Session settings the operators rely on, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Results never depend on the machine's zone, and a skewed or tiny shuffle is re-planned at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Keys of a small batch are looked up one by one in files' bloom filters, not as a range.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
}

_local_dirs: dict[str, str] = {}
_own_folders: set[str] = set()
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scratch_scopes", default=())


def local_session(app: str, cores: str = "*", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without it; it gets a private scratch folder.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dirs.setdefault(context.applicationId, tempfile.mkdtemp(prefix="lakeops-"))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the application's folder in the shared one, which goes when the application ends."""
    folder = f"{shared_dir(spark)}/lakeops-{spark.sparkContext.applicationId}"
    if folder not in _own_folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _own_folders.add(folder)
    return f"{folder}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what ``written`` wrote inside the block once it ends. Every result must have been
    written or collected by then; ``written(..., outlives=True)`` writes one that the block around
    this one still reads."""
    paths: list[str] = []
    token = _scopes.set((*_scopes.get(), paths))
    try:
        yield
    finally:
        _scopes.reset(token)
        path_class = spark._jvm.org.apache.hadoop.fs.Path
        for path in map(path_class, paths):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside the block the files of a query's shuffles go when it ends, not when the driver happens to collect its
    garbage; for many large queries one after the other. What else the session runs meanwhile may have to shuffle anew
    if it is run twice."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


#: A side of a join with more rows than this is shuffled.
MOST_BROADCAST = 100_000


def few(df: DataFrame) -> bool:
    """Whether a written table has so few rows that a join may send them to every task; counts them by the files' footers."""
    return df.count() <= MOST_BROADCAST


def merged(side: DataFrame) -> DataFrame:
    """A side of a join that is shuffled and sorted. Spark guesses a side by its compressed files, of which a
    key's column is a small part, and would collect millions of keys on the driver."""
    return side.hint("merge")


def written(df: DataFrame, label: str, outlives: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with files that outlive any executor; use it when several outputs
    share one expensive input.
    """
    path = scratch_path(df.sparkSession, label)
    scopes = _scopes.get()[: -1 if outlives else None]
    if scopes:
        scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
