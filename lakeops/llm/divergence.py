"""How far the sources of a language differ in their words, by run-length columns.

Terms are runs of letters (ASCII letters and all other signs outside ASCII, A-Z lower-cased). A
language keeps the V terms that at least LEAST_DOCS of its documents have. A group is a source of a
language; it, and the language as a whole, gives a kept term of count c the share

    p = 1 + floor(SCALE * (c + PRIOR) / (N + PRIOR * V)),    N the sum of c over kept terms

Two sources differ by the sum of |p - q| over all kept terms; a source's terms are those whose share
is above the language's.

1. Texts are dealt into chunks; documents that have a term are counted over the corpus
   (``common.corpus_counts``), and each chunk sends the counts of kept terms only.
2. A language's kept terms are dealt into shards by a hash. In a shard they are put in the order of
   their counts in the LEADERS largest groups, so that equal counts lie together, and every group
   becomes a column of runs: where each begins, and the share that its terms have. Absent terms are
   runs of count 0 and cost nothing.
3. For each pair of groups the runs' boundaries are merged, and |p - q| multiplied by the length of
   each common run. A shard's sums are partial ones; they are added up by pair. A shard also gives
   each group's first TOP terms, of which the first of all are among them.

A source that has a third of all rows is spread over all chunks, and its column over all shards; a
word that all documents have is one row for each chunk and group. A shard's result has a row for
each pair of a language's sources, as the result itself does.

Defined cases: null text, language and source are read as empty; a language without kept terms has
pairs of value 0; every group has its pairs even without terms, and a language of one source has
none; repeated rows each count; a very long text is worked on as one row of a chunk; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm import common
from lakeops.llm import text as tx
from lakeops.session import written

LEAST_DOCS, PRIOR, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Terms of a shard, and the groups by whose counts they are ordered.
SHARD_TERMS, LEADERS = 8192, 8
COUNTS = "lang string, source string, term string, n long"
FOUND = "part string, lang string, source string, item string, value long"
_INSIDE = np.arange(256) >= 128
_INSIDE[65:91] = _INSIDE[97:123] = True
_LANG = np.uint64(0xD6E8FEB86659FD93)


def _terms(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int, int]]:
    """Some rows at a time: folded bytes, starts and ends of terms, their keys by language, their rows, the range of rows."""
    raw, offsets = tx.strings(table.column("text"))
    lang = tx.cell_hashes(table.column("lang")) * _LANG
    for i, j in tx.steps(offsets):
        part, at = tx.folded(raw[offsets[i] : offsets[j]]), offsets[i : j + 1] - offsets[i]
        starts, ends, first = tx.spans(_INSIDE[part], at)
        row = np.repeat(np.arange(j - i), np.diff(first))
        yield part, starts, ends, tx.mix(tx.span_hashes(part, starts, ends) + lang[i + row]), row, i, j


def _documents_with(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a chunk's terms and how many of its documents have each."""
    own = [tx.unique_per_row(key, row, j - i)[0] for _, _, _, key, row, i, j in _terms(table)]
    return common.summed(np.concatenate([np.zeros(0, np.uint64), *own]))


def _kept_counts(table: pa.Table, kept: np.ndarray, *_: np.ndarray) -> pa.Table:
    """COUNTS of those of a chunk's terms whose keys are kept."""
    lang, source = (table.column(c).combine_chunks().dictionary_encode() for c in ("lang", "source"))
    group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    words: list[pa.Array] = []

    def reduced(group: np.ndarray, key: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, ...]:
        """The first place of each (group, key) and its sum."""
        order = np.lexsort((key, group))
        new = np.flatnonzero(np.append(True, (group[order][1:] != group[order][:-1]) | (key[order][1:] != key[order][:-1])))
        count = np.diff(np.append(new, len(order))) if n is None else np.add.reduceat(n[order], new)
        return order[new], count

    for raw, starts, ends, key, row, i, _ in _terms(table):
        at = np.searchsorted(kept, key) if len(kept) else np.zeros(len(key), np.int64)
        stays = np.flatnonzero(kept[np.minimum(at, len(kept) - 1)] == key) if len(kept) else np.zeros(0, np.int64)
        if len(stays):
            first, count = reduced(group[i + row[stays]], key[stays], None)
            own = stays[first]
            parts.append((group[i + row[own]], key[own], count))
            words.append(tx.span_strings(raw, starts[own], ends[own]))
    if not parts:
        return pa.table({c.split()[0]: pa.array([], pa.int64() if c == "n long" else pa.string()) for c in COUNTS.split(", ")})
    groups, found, count = (np.concatenate(x) for x in zip(*parts))
    first, n = reduced(groups, found, count)
    of = groups[first]
    return pa.table(
        {
            "lang": lang.dictionary.take(pa.array(of // len(source.dictionary))),
            "source": source.dictionary.take(pa.array(of % len(source.dictionary))),
            "term": pa.concat_arrays(words).take(pa.array(first)).cast(pa.string()),
            "n": n,
        }
    )


def term_counts(rows: DataFrame, spread_by: Sequence[str], least_docs: int = LEAST_DOCS) -> DataFrame:
    """COUNTS of all kept terms, a row for each group that has one; runs a job. ``rows`` has text, lang, source."""
    chunks = common.chunks_for(rows.sparkSession, common.text_bytes(rows))
    dealt = common.chunked(rows, chunks, "text", F.spark_partition_id(), *spread_by)
    replies = common.corpus_counts(dealt, _documents_with, chunks, least_docs)
    sent = common.with_told(dealt, replies, _kept_counts, COUNTS)
    return sent.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """p of each count; ``total`` is N + PRIOR * V. Products may pass 64 bits, shares never do."""
    return (1 + SCALE * (counts.astype(object) + PRIOR) // total).astype(np.int64)


def runs(places: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equal counts begin in a column of ``n`` terms, and the count of each. The
    terms at ``places``, in order, have ``counts``, all others 0."""
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gaps = np.diff(places, prepend=-1, append=n) > 1  # before each place, and behind the last
    starts = np.concatenate([places, np.append(-1, places)[gaps] + 1])
    values = np.concatenate([counts, np.zeros(gaps.sum(), counts.dtype)])
    order = np.argsort(starts)
    starts, values = starts[order], values[order]
    new = np.append(True, values[1:] != values[:-1])
    return starts[new], values[new]


def difference(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> int:
    """Sum of |p - q| over ``n`` terms of two columns of runs of shares."""
    starts = np.union1d(a[0], b[0])
    p, q = (x[1][np.searchsorted(x[0], starts, "right") - 1] for x in (a, b))
    return int((np.abs(p - q) * np.diff(np.append(starts, n))).sum())


def _order(term: np.ndarray, group: np.ndarray, n: np.ndarray, n_terms: int, weights: np.ndarray) -> np.ndarray:
    """The place of each term in the shard's order."""
    leaders = np.argsort(-weights, kind="stable")[:LEADERS]
    columns = np.zeros((len(leaders), n_terms), np.int64)
    for column, leader in zip(columns, leaders):
        own = group == leader
        column[term[own]] = n[own]
    order = np.lexsort(columns[::-1])
    place = np.empty(n_terms, np.int64)
    place[order] = np.arange(n_terms)
    return place


def _shard(top: int):
    """FOUND rows of one shard: pairs of its language's sources, with the less first, and each source's first terms."""

    def work(counts: pa.Table, groups: pa.Table) -> pa.Table:
        groups = groups.sort_by("source")
        lang, names = groups.column("lang")[0], groups.column("source").to_pylist()
        totals, of_lang = groups.column("total").to_pylist(), groups.column("lang_total")[0].as_py()
        coded = counts.column("term").combine_chunks().dictionary_encode()
        term, n_terms = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
        group = pc.index_in(counts.column("source"), groups.column("source").combine_chunks()).to_numpy().astype(np.int64)
        n = counts.column("n").to_numpy()

        place = _order(term, group, n, n_terms, np.array([int(t) for t in totals]))
        by_group = np.lexsort((place[term], group))
        cuts = np.searchsorted(group[by_group], np.arange(len(names) + 1))
        columns = []
        for g, total in enumerate(totals):
            own = by_group[cuts[g] : cuts[g + 1]]
            starts, values = runs(place[term[own]], n[own], n_terms)
            columns.append((starts, shares(values, int(total))))
        out = [
            ("pair", names[a], names[b], difference(columns[a], columns[b], n_terms) if n_terms else 0)
            for a in range(len(names)) for b in range(a + 1, len(names))
        ]

        whole = np.zeros(n_terms, np.int64)
        np.add.at(whole, term, n)
        q = shares(whole, int(of_lang)) if n_terms else whole
        rank = np.empty(n_terms, np.int64)  # strings compare as their UTF-8 bytes
        rank[pc.sort_indices(coded.dictionary.cast(pa.binary())).to_numpy()] = np.arange(n_terms)
        for g, total in enumerate(totals):
            own = by_group[cuts[g] : cuts[g + 1]]
            above = shares(n[own], int(total)) - q[term[own]] if len(own) else np.zeros(0, np.int64)
            own, above = own[above > 0], above[above > 0]
            first = np.lexsort((rank[term[own]], -above))[:top]
            out += [("term", names[g], coded.dictionary[int(term[own[k]])].as_py(), int(above[k])) for k in first]
        columns_of = list(zip(*out)) or [[], [], [], []]
        part, source, item = (pa.array(columns_of[k], pa.string()) for k in range(3))
        return pa.table({"part": part, "lang": pa.array([lang.as_py()] * len(out), pa.string()), "source": source, "item": item, "value": pa.array(columns_of[3], pa.int64())})

    return work


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    spread_by: Sequence[str] = ("doc_id",),
    least_docs: int = LEAST_DOCS,
    top: int = TOP,
    shard_terms: int = SHARD_TERMS,
) -> DataFrame:
    """lang, source, part, item, value, rank; runs jobs. ``spread_by`` names columns of ``docs`` that tell equal texts apart."""
    none = lambda name: F.coalesce(F.col(name), F.lit(""))
    rows = docs.select(
        none(text_col).alias("text"), none(lang_col).alias("lang"), none(source_col).alias("source"),
        F.xxhash64(*spread_by).alias("_spread"),
    )
    counts = written(term_counts(rows, ["_spread"], least_docs), "term-counts")
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    kept = counts.groupBy("lang", "term").agg(F.lit(1).alias("one")).groupBy("lang").agg(F.sum("one").alias("terms"))
    groups = rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(kept, "lang", "left")
    groups = written(groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("terms", F.lit(0)).alias("terms")), "groups")
    langs = groups.groupBy(F.col("lang").alias("_lang")).agg(F.sum("n").alias("of_lang"), F.max("terms").alias("of_terms"))
    langs = written(langs.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("of_terms") / shard_terms)).cast("int")), "langs")

    own = F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard")
    left = counts.join(langs, F.col("lang") == F.col("_lang")).select("lang", own, "source", "term", "n")
    right = groups.join(langs, F.col("lang") == F.col("_lang")).select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "source",
        (F.col("n") + PRIOR * F.col("terms")).alias("total"), (F.col("of_lang") + PRIOR * F.col("terms")).alias("lang_total"),
    )
    found = left.groupBy("lang", "shard").cogroup(right.groupBy("lang", "shard")).applyInArrow(_shard(top), FOUND)
    found = written(found, "shards")

    sums = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = sums.select("lang", ways.alias("_way"), "value").select("lang", "_way.source", F.lit("pair").alias("part"), "_way.item", "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    terms = found.where("part = 'term'").select("lang", "source", "part", "item", "value", rank).where(F.col("rank") <= top)
    return pairs.select("*", rank).unionByName(terms)
