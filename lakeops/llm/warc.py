"""WARC archives: a deterministic sharded writer, and a reader.

The writer cuts the range of ids into shards of about equal payload, by the byte counts of CELLS
equal steps between the smallest and the largest id; sorts each shard by id; and streams it into
files, one compressed member per record, starting a new file when the compressed size reaches the
limit. Headers and digests are made anew from the payload. Of records with equal payloads of some
size, that of the smallest id is a response and the others are revisit records without payload.

A task writes to a temporary name of its attempt, and its rows of the manifest (final and temporary
name, digest, sizes) count only if Spark commits them. Then files get their final names, by tasks
that may be repeated, and last the manifest appears under its own name. A reader takes the files
that the manifest lists. What lost or repeated tasks left has a temporary name and is deleted.
The content of every file depends on the rows alone, not on partitions, attempts or the clock.

Folders are named by URI; tasks write through pyarrow's file systems, so the folder must be one
that all executors reach.

Defined cases: a null payload is empty; a very large one is a record of its task's memory, some times
over; null ids follow all others, in shards by their payloads, and such a record is revisited by others only if all its equals have none; rows may repeat, the first
of equal ones is the response; a null url gets no target header; an empty table makes an empty
archive; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import common
from lakeops.session import scratch_scope, written

FILE_BYTES, SHARD_BYTES, CELLS, LEAST, LEVEL = 256 << 20, 1 << 30, 65_536, 100, 4
DATE = "2024-01-01T00:00:00Z"  # not the clock, so that files repeat byte for byte
MANIFEST = "_manifest"
_MANIFEST_SCHEMA = "name string, temporary string, sha256 string, bytes long, records long"
_RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, file string"
)
_TYPES = {"long": pa.int64(), "string": pa.string()}


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _shard_bounds(pages: DataFrame, shards: int, cells: int = CELLS) -> list[int]:
    """First ids of all shards but the first; runs jobs over ids and sizes. Ids are counted in equal
    steps between the least and the greatest; a step that holds more than a shard is gone into again, so
    ids may lie as close or as far apart as they like."""
    known, size = pages.where("page_id is not null"), F.octet_length("payload")
    low, high, total = known.agg(F.min("page_id"), F.max("page_id"), F.sum(size)).head()
    if not total:
        return []
    most, todo, found = -(-total // shards), [(low, high + 1)], []
    while todo:
        steps = max(2, cells // len(todo))
        spans = [(a, b, -(-(b - a) // steps)) for a, b in sorted(todo)]
        at = common.range_of(F.col("page_id"), [a for a, _, _ in spans])
        of = lambda k: F.element_at(F.split(F.lit(",".join(str(s[k]) for s in spans)), ",").cast("array<decimal(20,0)>"), at)  # noqa: E731, B023
        inside = known.where(at > 0).withColumn("_id", F.col("page_id").cast("decimal(20,0)")).where(F.col("_id") < of(1))
        cell = F.floor((F.col("_id") - of(0)) / of(2))
        rows = inside.groupBy(at.alias("span"), cell.alias("cell")).agg(F.sum(size).alias("n")).collect()
        todo = []
        for r in rows:
            a, b, width = spans[r["span"] - 1]
            begin = a + int(r["cell"]) * width
            end = min(b, begin + width)
            (todo.append((begin, end)) if r["n"] > most and end - begin > 1 else found.append((begin, r["n"])))
    bounds, own = [], 0
    for begin, n in sorted(found):
        if own and own + n > most:
            bounds.append(begin)
            own = 0
        own += n
    return bounds


def _headers(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def _record_id(page_id: int | None, digest: str, nth: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}:{nth}')}>"


def _member(page_id: int | None, nth: int, url: str | None, payload: bytes, refers: tuple | None) -> bytes:
    """One record as a compressed member; ``refers`` is (id,) for a revisit, ``nth`` tells records of one id apart."""
    digest = hashlib.sha256(payload).hexdigest()
    own = 0 if refers is None and len(payload) >= LEAST else nth + 1
    fields = [
        ("WARC-Type", "revisit" if refers else "response"),
        ("WARC-Record-ID", _record_id(page_id, digest, own)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if url:
        fields.append(("WARC-Target-URI", "".join(c for c in url if c >= " " and c != "\x7f")))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers:
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.append(("WARC-Refers-To", _record_id(refers[0], digest, 0)))
        if refers[0] is not None:
            fields.append(("X-Refers-To-Page-ID", str(refers[0])))
    block = b"" if refers else payload
    fields += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(block)))]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(_headers(fields) + block + b"\r\n\r\n") + packer.flush()


class _Files:
    """Writes the members of one task; a file ends at its size limit and with its shard."""

    def __init__(self, uri: str, file_bytes: int) -> None:
        self._system, self._base = _file_system(uri)
        self._limit, self._shard, self._nth, self._size, self._out = file_bytes, None, 0, 0, None
        context = TaskContext.get()
        self._attempt = f"{context.taskAttemptId() if context else 0}-{uuid.uuid4().hex[:8]}"
        self.manifest: list[tuple] = []

    def add(self, shard: int, member: bytes) -> None:
        if shard != self._shard or self._size >= self._limit:
            self.close()
            self._nth = self._nth + 1 if shard == self._shard else 0
            self._shard, self._size, self._records, self._sum = shard, 0, 0, hashlib.sha256()
            self._name = f"part-{shard:06d}-{self._nth:05d}.warc.gz"
            self._temporary = f"_temporary/{self._name}.{self._attempt}"
            self._system.create_dir(f"{self._base}/_temporary", recursive=True)
            self._out = self._system.open_output_stream(f"{self._base}/{self._temporary}", compression=None)
        self._out.write(member)
        self._sum.update(member)
        self._size += len(member)
        self._records += 1

    def close(self) -> None:
        if self._out is not None:
            self._out.close()
            self.manifest.append((self._name, self._temporary, self._sum.hexdigest(), self._size, self._records))
            self._out = None


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def _write_task(uri: str, file_bytes: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(uri, file_bytes)
        present, nth, told, done = object(), 0, {}, set()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("_shard", "page_id", "_kind", "digest", "first", "url")]
            payloads = batch.column("payload").cast(pa.binary())
            for k, (shard, page_id, kind, digest, first, url) in enumerate(zip(*columns)):
                if (shard, page_id) != present:
                    present, nth, told, done = (shard, page_id), 0, {}, set()
                if kind == 0:
                    told[digest] = first
                    continue
                payload, refers = payloads[k].as_py(), None
                if len(payload) >= LEAST:
                    own = hashlib.sha256(payload).hexdigest()
                    if own in told and told[own] != page_id:
                        refers = (told[own],)
                    elif own in done:
                        refers = (page_id,)
                    elif page_id is not None or own in told:
                        done.add(own)
                files.add(shard, _member(page_id, nth, url, payload, refers))
                nth += 1
        files.close()
        yield _table(files.manifest, _MANIFEST_SCHEMA)

    return work


def _name_task(uri: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(uri)
        for batch in batches:
            for row in batch.to_pylist():
                here = system.get_file_info(f"{base}/{row['temporary']}").type == pafs.FileType.File
                if here:  # else an earlier attempt of this task has moved it
                    system.move(f"{base}/{row['temporary']}", f"{base}/{row['name']}")
                if system.get_file_info(f"{base}/{row['name']}").size != row["bytes"]:
                    raise OSError(f"{row['name']} is not what the manifest says")
            yield batch

    return work


def write(
    pages: DataFrame,
    uri: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    shards: int | None = None,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write an archive of ``pages`` to the folder ``uri``; runs jobs.

    By default there are as many shards as shuffle partitions, and more beyond SHARD_BYTES each.
    A folder that has a manifest is complete and refused; one without is written anew.
    """
    with scratch_scope(pages.sparkSession):
        rows = pages.select(
            F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
            F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"),
        )
        _write(rows, uri, shards, file_bytes)


def _write(rows: DataFrame, uri: str, shards: int | None, file_bytes: int) -> None:
    spark = rows.sparkSession
    system, base = _file_system(uri)
    if system.get_file_info(f"{base}/{MANIFEST}").type != pafs.FileType.NotFound:
        raise FileExistsError(f"{uri} has a complete archive")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bytes_of = F.octet_length("payload")
    total, loose = (n or 0 for n in rows.agg(F.sum(bytes_of), F.sum(F.when(F.col("page_id").isNull(), bytes_of))).head())
    if shards is None:
        shards = max(tasks, -(-total // SHARD_BYTES))
    bounds = _shard_bounds(rows, shards)

    digests = rows.where(F.octet_length("payload") >= LEAST).select("page_id", F.sha2("payload", 256).alias("digest"))
    digests = written(digests, "digests")
    firsts = digests.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = written(firsts.select(F.col("digest").alias("_of"), "first"), "firsts")
    repeats = digests.join(firsts, F.col("digest") == F.col("_of")).where("page_id is null or page_id > first")

    # What a record repeats comes right before it in its shard's order, so that one stream has both.
    none = lambda kind: F.lit(None).cast(kind)
    told = repeats.select("page_id", none("string").alias("url"), F.lit("").alias("payload"), "digest", "first", F.lit(0).alias("_kind"))
    own = rows.select("*", none("string").alias("digest"), none("long").alias("first"), F.lit(1).alias("_kind"))
    # Pages without an id are parted by their payloads; a repeat lies with the page that it tells of.
    unnamed = max(1, -(-shards * loose // max(1, total)))
    by_payload = F.pmod(F.xxhash64(F.coalesce("digest", F.sha2("payload", 256))), F.lit(unnamed)) + len(bounds) + 1
    shard = F.when(F.col("page_id").isNull(), by_payload).otherwise(common.range_of(F.col("page_id"), bounds))
    ranges = len(bounds) + 1 + unnamed
    dealt = own.unionByName(told).withColumn("_shard", shard.cast("int")).repartitionById(ranges, "_shard")
    order = ["_shard", F.col("page_id").asc_nulls_last(), "_kind", "digest", F.xxhash64("payload"), "url"]
    manifest = written(dealt.sortWithinPartitions(*order).mapInArrow(_write_task(uri, file_bytes), _MANIFEST_SCHEMA), "manifest")

    system.create_dir(base, recursive=True)
    waiting = f"{MANIFEST}-{uuid.uuid4().hex[:8]}"
    manifest.mapInArrow(_name_task(uri), _MANIFEST_SCHEMA).drop("temporary").write.json(f"{uri}/{waiting}")
    system.move(f"{base}/{waiting}", f"{base}/{MANIFEST}")
    if system.get_file_info(f"{base}/_temporary").type != pafs.FileType.NotFound:
        system.delete_dir(f"{base}/_temporary")


def members(stream: Iterator[bytes]) -> Iterator[bytes]:
    """The unpacked members of a compressed file, one at a time."""
    unpacker, parts = None, []
    for data in stream:
        while data:
            unpacker = unpacker or zlib.decompressobj(31)
            parts.append(unpacker.decompress(data))
            data = unpacker.unused_data
            if unpacker.eof:
                yield b"".join(parts)
                unpacker, parts = None, []
    if unpacker is not None:
        raise EOFError("the file ends within a record")


def parse(member: bytes) -> tuple:
    """page id, payload length, digest, type, page referred to, url and payload of a record; digests are checked."""
    head, _, rest = member.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if not version.startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    if fields["WARC-Type"] == "response" and hashlib.sha256(block).hexdigest() != digest:
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is not what its digest says")
    number = lambda name: int(fields[name]) if name in fields else None
    return (
        number("X-Page-ID"), number("X-Payload-Length"), digest, fields["WARC-Type"], number("X-Refers-To-Page-ID"),
        fields.get("WARC-Target-URI"), block,
    )


def read(spark: SparkSession, uri: str) -> DataFrame:
    """A row for each record of the files that the archive's manifest lists."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(uri)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows = []
                with system.open_input_stream(f"{base}/{name}", compression=None) as file:
                    for member in members(iter(lambda: file.read(1 << 20), b"")):
                        rows.append((*parse(member)[:-1], name))
                        if len(rows) == 4096:
                            yield _table(rows, _RECORDS)
                            rows = []
                yield _table(rows, _RECORDS)

    files = spark.read.schema("name string, bytes long").json(f"{uri}/{MANIFEST}").select("name")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks, "name").mapInArrow(work, _RECORDS)
