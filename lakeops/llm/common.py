"""Helpers of several operators: rows dealt into bounded chunks, and counts over the whole corpus.

``corpus_counts`` answers, for chunks of rows, how often each of their keys occurs in all chunks:
every chunk sends its distinct keys with its own counts to buckets by key; every bucket adds up
and sends each chunk the totals of its keys. A key reaches a bucket once per chunk, however often
it occurs, so no bucket holds a hot group, and nothing is collected or broadcast. Where there are
many chunks, the requests of some meet on their way and go on as one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import text as tx

LEAST_CHUNK, CHUNK_BYTES = 2 << 20, 8 << 20
#: Of a digit of a bucket's number: up to 256 chunks ask buckets at once, more by way of nodes.
MOST_BITS = 8
REPLY = "_chunk int, _bucket int, _keys binary, _totals binary"
_ASK = "_from int, _group int, _bucket int, _keys binary, _counts binary"
Keys = Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts; runs a job."""
    return docs.agg(F.sum(F.octet_length(column))).head()[0] or 0


def chunks_for(spark: SparkSession, size: int) -> int:
    """Chunks of CHUNK_BYTES; smaller ones, but not below LEAST_CHUNK, if that keeps all partitions busy."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-size // CHUNK_BYTES), min(tasks, -(-size // LEAST_CHUNK)))


def chunked(rows: DataFrame, chunks: int, *spread_by: str | Column) -> DataFrame:
    """``rows`` with ``_chunk``, one partition each. Rows alike in all of ``spread_by`` share a chunk."""
    dealt = rows.withColumn("_chunk", F.pmod(F.xxhash64(*spread_by), F.lit(chunks)).cast("int"))
    return dealt.repartitionById(chunks, "_chunk")


def range_of(value: Column, bounds: Sequence[int]) -> Column:
    """How many of the sorted bounds are at or below the value, by binary search."""
    if not bounds:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")  # folded to a constant
    leaps = [1 << k for k in reversed(range(len(bounds).bit_length()))]

    def leap(at: Column, by: Column) -> Column:
        reached = at + by
        fits = (reached <= len(bounds)) & (F.element_at(table, F.least(reached, F.lit(len(bounds)))) <= value)
        return F.when(fits, reached).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, leaps)), F.lit(0), leap)


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sum of the counts of each (how often it occurs, by default)."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts[order], first) if len(keys) else counts


def bucket_bits(chunks: int) -> int:
    return max(0, (chunks - 1).bit_length())


def bucket_cuts(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where the sorted keys of each of 2**bits buckets begin, and the end."""
    edges = (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)


def digits_of(bits: int, most: int) -> list[int]:
    """``bits`` parted into as few digits as there can be of ``most`` bits, about equal."""
    levels = max(1, -(-bits // most))
    return [bits // levels + (k < bits % levels) for k in range(levels)]


def _prefix_rows(sender: int, group: int, keys: np.ndarray, counts: np.ndarray, used: int, above: int | None, digit: int) -> pa.Table:
    """Rows of _ASK for sorted keys whose first ``used`` bits are ``above``, one for each value of the next digit."""
    low = 0 if above is None else above << digit
    edges = np.arange(low + 1, low + (1 << digit), dtype=np.uint64) << np.uint64(64 - used - digit) if digit else np.zeros(0, np.uint64)
    cuts = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)
    full = np.flatnonzero(np.diff(cuts))
    return pa.table(
        {
            "_from": pa.array(np.full(len(full), sender), pa.int32()),
            "_group": pa.array(np.full(len(full), group), pa.int32()),
            "_bucket": pa.array(full + low, pa.int32()),
            "_keys": pa.array([tx.pack(keys[cuts[b] : cuts[b + 1]]) for b in full], pa.binary()),
            "_counts": pa.array([tx.pack_counts(counts[cuts[b] : cuts[b + 1]]) for b in full], pa.binary()),
        }
    )


def _asked(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of _ASK in the order of their senders, all their keys, the counts, and where each row's keys end."""
    table = table.take(np.lexsort((table.column("_bucket").to_numpy(), table.column("_from").to_numpy())))
    keys = [tx.unpack(x.as_py()) for x in table.column("_keys")]
    counts = [tx.unpack_counts(x.as_py()) for x in table.column("_counts")]
    return table, np.concatenate(keys), np.concatenate(counts), np.cumsum([len(k) for k in keys])


def _reply(table: pa.Table, keys: np.ndarray, totals: np.ndarray, ends: np.ndarray, told: bool) -> pa.Table:
    """REPLY to every row of ``table``; with ``told``, only of totals above 0, with their keys."""
    parts = list(zip(np.split(keys, ends[:-1]), np.split(totals, ends[:-1])))
    if told:
        parts = [(k[n > 0], n[n > 0]) for k, n in parts]
    return pa.table(
        {
            "_chunk": table.column("_from"),
            "_bucket": table.column("_bucket"),
            "_keys": pa.array([tx.pack(k) if told else None for k, _ in parts], pa.binary()),
            "_totals": pa.array([tx.pack_counts(n) for _, n in parts], pa.binary()),
        }
    )


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Which of the keys are the first of their value."""
    order = np.argsort(keys, kind="stable")
    new = np.append(True, keys[order][1:] != keys[order][:-1])
    out = np.zeros(len(keys), bool)
    out[order[new]] = True
    return out


def _exchange(asked: DataFrame, groups: int, digits: list[int], used: int, least: int | None) -> DataFrame:
    """REPLY for every row of ``asked``, whose buckets are the first ``used`` bits of their keys."""
    told = least is not None

    def add(table: pa.Table) -> pa.Table:
        table, joined, counts, ends = _asked(table)
        distinct, totals = summed(joined, counts)
        found = totals[np.searchsorted(distinct, joined)]
        if told:
            found = np.where(found >= least, 2 * found + _firsts(joined), 0)
        return _reply(table, joined, found, ends, told)

    if len(digits) == 1:
        return asked.repartitionById(1 << used, "_bucket").groupBy("_bucket").applyInArrow(add, REPLY)

    joint = digits[0]  # 2**joint senders' keys of one bucket meet in a node, some 2**-joint of each
    groups = (groups - 1 >> joint) + 1
    nodes = groups << used
    node = F.shiftright("_group", joint) * F.lit(1 << used) + F.col("_bucket")
    met = asked.withColumn("_node", node.cast("int")).repartitionById(nodes, "_node")

    def merge(table: pa.Table) -> pa.Table:
        table, joined, counts, _ = _asked(table)
        keys, sums = summed(joined, counts)
        number = table.column("_node")[0].as_py()
        return _prefix_rows(number, number >> used, keys, sums, used, number & ((1 << used) - 1), digits[1])

    def hand_down(table: pa.Table, replies: pa.Table) -> pa.Table:
        table, joined, _, ends = _asked(table)
        if told:
            keys, totals = told_totals(replies)
            at = np.minimum(np.searchsorted(keys, joined), max(0, len(keys) - 1))
            found = np.where(keys[at] == joined, totals[at], 0) if len(keys) else np.zeros(len(joined), np.int64)
            found = np.where(_firsts(joined), found, found & ~1)
        else:
            found = totals_for(replies)[np.searchsorted(np.unique(joined), joined)]
        return _reply(table, joined, found, ends, told)

    above = _exchange(met.groupBy("_node").applyInArrow(merge, _ASK), groups, digits[1:], used + digits[1], least)
    above = above.withColumnRenamed("_chunk", "_node").repartitionById(nodes, "_node")
    return met.groupBy("_node").cogroup(above.groupBy("_node")).applyInArrow(hand_down, REPLY)


def corpus_counts(chunked_rows: DataFrame, keys_of: Keys, chunks: int, least: int | None = None, most_bits: int = MOST_BITS) -> DataFrame:
    """For every chunk and bucket, the totals over all chunks of the chunk's keys, in the keys' order.

    ``keys_of`` gives a chunk's sorted distinct keys and counts; ``totals_for`` puts the replies of
    one chunk together again. With ``least``, chunks are told only totals of at least that, with their
    keys: ``told_totals`` puts those together, and ``owned`` parts them from a mark at the first
    chunk that has the key.

    A key goes through as many levels as its bucket's number has digits of ``most_bits`` bits. At each
    but the last, a node adds up what as many chunks as a digit has values ask for in one range of
    keys, some one chunk's worth, and asks on for all of them. So rows and blocks of a level are as
    many as chunks times 2**most_bits, in proportion to the input.
    """
    digits = digits_of(bucket_bits(chunks), most_bits)

    def ask(table: pa.Table) -> pa.Table:
        chunk = table.column("_chunk")[0].as_py()
        return _prefix_rows(chunk, chunk, *keys_of(table), 0, None, digits[0])

    asked = chunked_rows.groupBy("_chunk").applyInArrow(ask, _ASK)
    return _exchange(asked, chunks, digits, digits[0], least).repartitionById(chunks, "_chunk")


def found_in(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of ``wanted``, all of which are among the sorted keys. Sorted wishes find their place sooner."""
    order = np.argsort(wanted)
    out = np.empty(len(wanted), values.dtype)
    out[order] = values[np.searchsorted(keys, wanted[order])]
    return out


def totals_for(replies: pa.Table) -> np.ndarray:
    """The totals of one chunk's keys, in their order."""
    order = np.argsort(replies.column("_bucket").to_numpy())
    parts = replies.column("_totals")
    return np.concatenate([np.zeros(0, np.int64), *(tx.unpack_counts(parts[int(i)].as_py()) for i in order)])


def told_totals(replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The sorted keys that one chunk was told of, and their totals with marks."""
    order = np.argsort(replies.column("_bucket").to_numpy())
    parts = replies.column("_keys")
    return np.concatenate([np.zeros(0, np.uint64), *(tx.unpack(parts[int(i)].as_py()) for i in order)]), totals_for(replies)


def owned(totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Totals that were told, and whether this chunk is the first to have the key."""
    return totals >> 1, (totals & 1).astype(bool)


def with_replies(chunked_rows: DataFrame, replies: DataFrame, fn: Callable[[pa.Table, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """``fn(chunk, totals of its keys)`` for every chunk."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        return fn(left, totals_for(right))

    return chunked_rows.groupBy("_chunk").cogroup(replies.groupBy("_chunk")).applyInArrow(work, schema)


def with_told(
    chunked_rows: DataFrame, replies: DataFrame, fn: Callable[[pa.Table, np.ndarray, np.ndarray, np.ndarray], pa.Table], schema: str
) -> DataFrame:
    """``fn(chunk, keys, totals, marks)`` for every chunk, of the keys that it was told of."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, totals = told_totals(right)
        return fn(left, keys, *owned(totals))

    return chunked_rows.groupBy("_chunk").cogroup(replies.groupBy("_chunk")).applyInArrow(work, schema)


def batches(table_of: Callable[[pa.RecordBatch], pa.Table | pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of one batch as one for ``mapInArrow``."""

    def work(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            made = table_of(batch)
            yield from made.to_batches() if isinstance(made, pa.Table) else [made]

    return work
