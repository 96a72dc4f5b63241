"""Counts over the corpus, by one level of buckets and by several."""

import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle

from lakeops.llm import common

CHUNKS = 37
cloudpickle.register_pickle_by_value(sys.modules[__name__])  # its helpers go to tasks


@pytest.fixture(scope="module")
def numbers():
    """(chunk, key): some keys in every chunk, some in one, some often in one."""
    rng = np.random.default_rng(5)
    rows = [(c, int(k)) for c in range(CHUNKS) if c != 11 for k in rng.zipf(1.3, 400) % 5000]
    return rows + [(3, 77)] * 500


def keys_of(table: pa.Table):
    spread = common.tx.mix(table.column("key").to_numpy().astype(np.uint64))
    return common.summed(spread)


def dealt(spark, rows):
    return spark.createDataFrame(rows, "_chunk int, key long").repartitionById(CHUNKS, "_chunk")


def spread_keys(table: pa.Table):
    own = table.column("key").unique().to_numpy()
    keys = common.tx.mix(own.astype(np.uint64))
    order = np.argsort(keys)
    return keys[order], own[order]


def told(table: pa.Table, own, totals, first):
    chunk = pa.array([table.column("_chunk")[0].as_py()] * len(own), pa.int32())
    return pa.table({"chunk": chunk, "key": own, "n": totals, "first": first})


@pytest.mark.parametrize("most_bits", [8, 3, 2, 1])
def test_totals(spark, numbers, most_bits):
    chunks, schema = dealt(spark, numbers), "chunk int, key long, n long, first boolean"
    replies = common.corpus_counts(chunks, keys_of, CHUNKS, most_bits=most_bits)
    tell = lambda table, totals: told(table, spread_keys(table)[1], totals, np.zeros(len(totals), bool))
    rows = common.with_replies(chunks, replies, tell, schema).collect()
    total, per_chunk = Counter(k for _, k in numbers), set(numbers)
    assert Counter((r.chunk, r.key, r.n) for r in rows) == Counter((c, k, total[k]) for c, k in per_chunk)


@pytest.mark.parametrize("most_bits", [8, 3, 2, 1])
def test_totals_that_are_told(spark, numbers, most_bits):
    chunks, schema = dealt(spark, numbers), "chunk int, key long, n long, first boolean"
    replies = common.corpus_counts(chunks, keys_of, CHUNKS, 10, most_bits)

    def tell(table, keys, totals, first):
        every, own = spread_keys(table)
        return told(table, own[np.isin(every, keys)], totals, first)

    rows = common.with_told(chunks, replies, tell, schema).collect()
    total, chunk_of = Counter(k for _, k in numbers), defaultdict(set)
    for c, k in numbers:
        chunk_of[k].add(c)
    want = Counter((c, k, n, c == min(chunk_of[k])) for k, n in total.items() if n >= 10 for c in chunk_of[k])
    assert Counter(map(tuple, rows)) == want


def test_requests_grow_with_the_input(spark, monkeypatch):
    """Twice the chunks, twice the rows that are sent, at a fixed number of levels."""
    sent = Counter()
    rows_of = common._prefix_rows

    def count(chunks):
        rng = np.random.default_rng(1)
        keys = np.sort(rng.integers(0, 2**63, 4000, np.uint64) * np.uint64(2))
        asks = [rows_of(c, c, keys, np.ones(4000, np.int64), 0, None, digits[0]) for c in range(chunks)]
        return sum(map(len, asks))

    digits = common.digits_of(common.bucket_bits(4096), common.MOST_BITS)
    assert digits == [6, 6] and common.digits_of(0, 8) == [0] and common.digits_of(24, 8) == [8, 8, 8]
    sent[2048], sent[4096] = count(2048), count(4096)
    assert sent[4096] == 2 * sent[2048] <= 4096 * 2**common.MOST_BITS
