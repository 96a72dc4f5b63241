"""Records of delimited text whose quoted fields may span lines, read in splits.

A split begins at a line, but perhaps inside a quoted field. So each split is gone through from both
states at once, closed and open, which gives where it ends from either; per file these steps are put
together in order, from closed at the file's beginning, and tell how every split begins. Then each
split cuts its lines where records end. What a record has in several splits are fragments, put
together by the split in which the record begins. A file that ends inside a quoted field fails.

Quotes are as most programs write them: only a field that begins with one is quoted, and two inside
stand for one. Two passes read the files, and a third the splits that records cross, if there are any.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import written

#: Splits that begin inside a record are broadcast up to this many; beyond, lines are shuffled to them.
MOST_BROADCAST = 100_000
STATES = "path string, start long, from_closed boolean, from_open boolean, begins boolean"
PLACED = "path string, start long, open boolean, rec long, ends boolean"
RECORDS = "line string, path string, first boolean, rec long, start long"
_LINES = "line string, path string, start long, nth long"
# The rest of a quoted field with its closing quote.
_CLOSE = re.compile(r'[^"]*(?:""[^"]*)*"(?!")')


def ends_open(line: str, is_open: bool, sep: str) -> bool:
    """Whether the line ends inside a quoted field, given whether it begins inside one."""
    at = 0
    if is_open:
        closed = _CLOSE.match(line)
        if closed is None:
            return True
        at = line.find(sep, closed.end())
        if at < 0:
            return False
        at += len(sep)
    while True:
        if not line.startswith('"', at):
            at = line.find(sep + '"', at)
            if at < 0:
                return False
            at += len(sep)
        closed = _CLOSE.match(line, at + 1)
        if closed is None:
            return True
        at = line.find(sep, closed.end())
        if at < 0:
            return False
        at += len(sep)


def text_lines(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Lines with their file and where their split begins; a carriage return before a line's end stays."""
    return spark.read.text(paths, lineSep="\n").select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """Ranges of rows of one split: path, start of the split, first row, end."""
    path, start, n = batch.column("path"), batch.column("start"), batch.num_rows
    if not n:
        return
    other = [pc.not_equal(c.slice(1), c.slice(0, n - 1)) for c in (path, start)]
    cuts = [0, *(pc.indices_nonzero(pc.or_(*other)).to_numpy() + 1).tolist(), n]
    for low, high in zip(cuts, cuts[1:]):
        yield path[low].as_py(), start[low].as_py(), low, high


def _split_states(skip: int, sep: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """How each split ends from either state; ``begins``: whether a record begins in it if it begins open."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = {}
        for batch in batches:
            quoted = pc.match_substring(batch.column("line"), '"')
            for path, start, low, high in _runs(batch):
                state = found.setdefault((path, start), [0, False, True, None])  # lines, ends from closed, from open, where that closed
                first = max(0, skip - state[0]) if start == 0 else 0
                marked = pc.indices_nonzero(quoted.slice(low, high - low)).to_pylist()
                for k in marked:
                    if k < first:
                        continue
                    line = batch.column("line")[low + k].as_py()
                    closed, opened = state[1], state[2]
                    state[1] = ends_open(line, closed, sep)
                    state[2] = state[1] if opened == closed else ends_open(line, opened, sep)
                    if opened and not state[2] and state[3] is None:
                        state[3] = state[0] + k
                state[0] += high - low
        rows = [(*key, c, o, at is not None and n - 1 > at) for key, (n, c, o, at) in found.items()]
        columns = list(zip(*rows)) or [[]] * 5
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in STATES.split(", ")])

    return work


def _placed(splits: pd.DataFrame) -> pd.DataFrame:
    """How each split of one file begins and ends, and the split in which the record that is open there began."""
    rows, is_open, rec = [], False, -1
    for split in splits.sort_values("start").itertuples():
        ends = bool(split.from_open if is_open else split.from_closed)
        rows.append((split.path, split.start, is_open, rec, ends))
        rec = (rec if is_open and not split.begins else split.start) if ends else -1
        is_open = ends
    return pd.DataFrame(rows, columns=[c.split()[0] for c in PLACED.split(", ")])


def _cut(skip: int, sep: str, fragments: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Whole records of each split, or the fragments of those that cross its ends."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, seen, is_open, head, rec, held, begun = None, 0, False, False, -1, [], False
        out: list[tuple[str, str, bool, int | None, int]] = []

        def end_split() -> None:
            """What is still open goes on in the next split."""
            if held and fragments:
                out.append(("\n".join(held), key[0], False, rec if head else key[1], key[1]))

        def table() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[]] * 5
            kinds = (pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in RECORDS.split(", ")])

        for batch in batches:
            lines, quoted = batch.column("line").to_pylist(), pc.match_substring(batch.column("line"), '"').to_pylist()
            opens, recs = batch.column("open"), batch.column("rec")
            for path, start, low, high in _runs(batch):
                if (path, start) != key:
                    end_split()
                    key, seen, held, begun = (path, start), 0, [], False
                    is_open = head = bool(opens[low].as_py())
                    rec = recs[low].as_py()
                for k in range(low, high):
                    seen += 1
                    if start == 0 and seen <= skip:
                        continue
                    line = lines[k]
                    if quoted[k]:
                        is_open = ends_open(line, is_open, sep)
                    if is_open:
                        held.append(line)
                        continue
                    if held or head:
                        line = "\n".join([*held, line])
                        held = []
                    if head:  # it began in an earlier split
                        if fragments:
                            out.append((line, path, False, rec, start))
                        head = False
                    elif not fragments:
                        out.append((line, path, start == 0 and not begun, None, start))
                        begun = True
            if out:
                yield table()
                out.clear()
        end_split()
        yield table()

    return work


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[tuple[str, int], int] = {}
    for batch in batches:
        nth: list[int] = []
        for path, start, low, high in _runs(batch):
            before = seen.get((path, start), 0)
            nth += range(before, before + high - low)
            seen[path, start] = before + high - low
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nth, pa.int64())], names=[*batch.schema.names, "nth"])


def _with_places(lines: DataFrame, splits: DataFrame, how: str, few: bool) -> DataFrame:
    """Lines in order, with how their split begins; by broadcast of the splits, or else by a shuffle of the lines."""
    if few:
        return lines.join(F.broadcast(splits), ["path", "start"], how)
    joined = lines.mapInArrow(_numbered, _LINES).join(splits, ["path", "start"], how)
    return joined.repartition("path", "start").sortWithinPartitions("path", "start", "nth")


def records(spark: SparkSession, paths: Sequence[str] | str, skip: int = 0, sep: str = ",", most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """``(line, path, first)``: every record after ``skip`` lines of each file, ``first`` where it is the
    file's first, which must end in the file's first split. Blank records are left out. Runs jobs."""
    lines = text_lines(spark, paths)
    states = lines.mapInArrow(_split_states(skip, sep), STATES).groupBy("path", "start").agg(
        F.max("from_closed").alias("from_closed"), F.max("from_open").alias("from_open"), F.max("begins").alias("begins")
    )
    placed = written(states.groupBy("path").applyInPandas(_placed, PLACED), "splits")
    last = placed.groupBy("path").agg(F.max_by("ends", "start").alias("ends")).where("ends")
    broken = last.agg(F.min("path")).first()[0]
    if broken is not None:
        raise ValueError(f"a quoted field is not closed in {broken}")

    crossed = placed.where("open or ends").drop("ends")
    n = crossed.count()
    few = n <= most_broadcast
    columns = ["line", "path", "start", "open", "rec"]
    found = _with_places(lines, placed.where("open").drop("ends"), "left", few).select(*columns)
    found = found.withColumn("open", F.coalesce("open", F.lit(False)))
    whole = found.mapInArrow(_cut(skip, sep, False), RECORDS).select("line", "path", "first")
    if n:
        parts = _with_places(lines, crossed, "inner", few).select(*columns).mapInArrow(_cut(skip, sep, True), RECORDS)
        texts = F.transform(F.array_sort(F.collect_list(F.struct("start", "line"))), lambda x: x.line)
        joined = parts.groupBy("path", "rec").agg(F.array_join(texts, "\n").alias("line"))
        whole = whole.unionByName(joined.select("line", "path", F.lit(False).alias("first")))
    return whole.withColumn("line", _without_return(F.col("line"))).where(F.trim("line") != "")


def _without_return(line: Column) -> Column:
    return F.when(F.endswith(line, F.lit("\r")), F.left(line, F.length(line) - 1)).otherwise(line)
