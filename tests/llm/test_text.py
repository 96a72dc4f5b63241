"""Batch text helpers against plain Python."""

import brute
import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeops.llm import common
from lakeops.llm import suffix_array as sa
from lakeops.llm import text as tx

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\tçé😀", max_size=30)), max_size=12)


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_words_and_hashes(texts):
    raw, offsets = tx.strings(pa.array(texts, pa.string()))
    starts, ends, first = tx.words(raw, offsets)
    found = [[raw[a:b].tobytes().decode() for a, b in zip(starts[i:j], ends[i:j])] for i, j in zip(first, first[1:])]
    assert found == [brute.WORD.findall(t or "") for t in texts]
    hashes = tx.span_hashes(raw, starts, ends).tolist()
    flat = [w for row in found for w in row]
    assert len(set(zip(flat, hashes))) == len(set(flat)) == len(set(hashes))
    folded = tx.span_hashes(tx.folded(raw), starts, ends)
    sets, cuts = tx.unique_per_row(*tx.shingles(folded, first, 5), len(texts))
    assert np.diff(cuts).tolist() == [len(brute.shingles(t)) for t in texts]
    assert len(np.unique(sets)) == len(set().union(*map(brute.shingles, texts)))


def test_hashes_of_a_long_text_in_steps(monkeypatch):
    """Spans of a text longer than a step hash as they do alone, and a worker doesn't keep tables of that length."""
    raw = np.random.default_rng(3).integers(0, 256, 6000).astype(np.uint8)
    starts = np.sort(np.random.default_rng(4).integers(0, 4000, 300))
    ends = np.maximum.accumulate(starts + np.resize([0, 7, 60, 1500], 300))
    monkeypatch.setattr(tx, "STEP", 500)
    monkeypatch.setattr(tx, "_powers", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    want = [int(tx.span_hashes(raw[a:b], np.array([0]), np.array([b - a]))[0]) for a, b in zip(starts, ends)]
    assert tx.span_hashes(raw, starts, ends).tolist() == want
    assert tx.span_hashes(raw, starts[::-1], ends[::-1]).tolist() == want[::-1]
    assert len(tx.span_hashes(raw, starts[:0], ends[:0])) == 0
    assert max(map(len, tx._powers)) <= 501


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1)))
def test_packing_of_numbers(numbers):
    keys = np.sort(np.array(numbers, np.uint64))
    assert tx.unpack(tx.pack(keys)).tolist() == keys.tolist()
    counts = np.array([n % 2**32 for n in numbers], np.int64)
    assert tx.unpack_counts(tx.pack_counts(counts)).tolist() == counts.tolist()
    distinct, n = common.summed(np.array(numbers, np.uint64))
    assert distinct.tolist() == sorted(set(numbers)) and n.tolist() == [numbers.count(x) for x in sorted(set(numbers))]


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=200), st.integers(1, 6))
def test_suffix_array(data, times):
    data = bytes(b % 3 for b in data) * times
    array = np.frombuffer(data, np.uint8)
    word = sa.words(array)
    order = sa.suffix_array(array, word)
    assert sorted(order.tolist()) == list(range(len(data)))
    heads = [data[i : i + sa.DEPTH].ljust(sa.DEPTH, b"\0") for i in order]
    assert heads == sorted(heads)
    for k, n in enumerate(sa.common_prefixes(order, word, 50)[1:].tolist() if len(data) else []):
        a, b = heads[k][:50], heads[k + 1][:50]
        assert n == next((i for i in range(50) if a[i] != b[i]), 50)


def test_range_of(spark):
    from pyspark.sql import functions as F

    for bounds in ([], [5], [-(2**62), -3, 0, 7, 2**62]):
        found = spark.range(-10, 10).select("id", common.range_of(F.col("id"), bounds).alias("k")).collect()
        assert all(r.k == sum(b <= r.id for b in bounds) for r in found)


def test_counts_above_four_bytes():
    for counts in ([], [0, 7], [2**32 - 1], [1, 2**32, 2**40 + 3, 2**62]):
        packed = tx.pack_counts(np.array(counts, np.int64))
        assert tx.unpack_counts(packed).tolist() == counts
