"""Collocations: phrases of two and three words that occur more often than their parts let expect.

Texts are folded (A-Z), cut into pieces at marks and line ends, and pieces into words. Per language,
f counts a phrase's occurrences. Candidates have a = f(phrase) >= LEAST. Cut in two, a candidate has
the score floor(SCALE a^2 / (l r)), l and r the counts of both parts; its lowest-scoring cut counts.
A candidate that stands in a longer one with at least half as many occurrences is dropped.

1. Texts are dealt into chunks. A chunk's pieces are cut into shards of some megabytes, and each
   shard gets an FM-index over word ids in both directions (``fm_index``). Its words' intervals are
   extended to the left, those of two words to the right, each symbol at once: that enumerates all
   phrases with their counts.
2. Counts are summed over shards and chunks (``common.corpus_counts``): a phrase goes by a 64-bit
   hash of its language and words, once for each chunk. Chunks are told totals of at least LEAST.
3. A chunk builds its indexes once more and extends only intervals of words and pairs that are
   frequent everywhere, as all of a candidate's parts are. The first chunk that has a candidate
   gives its row: the parts occur where it does, so their totals are at hand, and no join is needed
   in which a frequent word would be a hot key. It also names pairs that its triples swallow.
4. Rows that are not swallowed are ranked, by language and a salt first.

No phrase is capped or sampled, and only counts of phrases that a chunk has are sent.

Defined cases: a null text is empty; a null language is NO_LANG, an empty one is itself; repeated
rows each count; a very long text is cut between pieces, a piece that is longer than a shard is one;
fewer candidates than ``first`` are all returned; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm import common
from lakeops.llm import text as tx
from lakeops.llm.fm_index import Bidirectional, Phrases
from lakeops.session import written

LEAST, SCALE, FIRST, NO_LANG = 10, 1_000_000, 2000, "und"
#: A candidate is dropped if OF * f(longer) >= SHARE * a.
SHARE, OF = 50, 100
SHARD_BYTES, SALTS = 2 << 20, 64
FOUND = "lang string, phrase string, words int, key long, a long, l long, r long, n long, score long"
_DEPTH = 3
_CUT, _SPACE = np.zeros(256, bool), np.zeros(256, bool)
_CUT[list(b".,;:!?\n\x0b\x0c\r")] = True
_SPACE[list(b" \t")] = True
_LANG, _TOTAL = np.uint64(0x9FB21C651E98DF25), np.uint64(0x7D1)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


class _Shard(NamedTuple):
    """Folded bytes of some pieces, their words, each word's key and row, and the symbols of the index."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    key: np.ndarray
    row: np.ndarray
    symbol_key: np.ndarray  # of symbol k at k - 1
    text: np.ndarray
    word_at: np.ndarray  # number of the word at each place of the text


def _blocks(raw: np.ndarray, offsets: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of about ``most`` at a time, with offsets and numbers of their rows; a long row is cut behind marks."""
    for i, j in tx.steps(offsets, most):
        part, at = raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        if len(part) <= 2 * most:
            yield part, at, np.arange(i, j)
            continue
        marks, begin = np.flatnonzero(_CUT[part]) + 1, 0
        while begin < len(part):
            after = np.searchsorted(marks, begin + most)
            end = int(marks[after]) if after < len(marks) else len(part)
            yield part[begin:end], np.array([0, end - begin]), np.array([i])
            begin = end


def _shards(table: pa.Table, most: int) -> Iterator[_Shard]:
    raw, offsets = tx.strings(table.column("text"))
    lang = tx.cell_hashes(table.column("lang")) * _LANG
    for part, at, rows in _blocks(raw, offsets, most):
        part = tx.folded(part)
        cut = _CUT[part]
        starts, ends, first = tx.spans(~(cut | _SPACE[part]), at)
        row = rows[np.repeat(np.arange(len(rows)), np.diff(first))]
        hashes = [np.zeros(0, np.uint64)]
        for i, j in tx.steps(np.append(starts, len(part))):  # a hash takes several times its bytes
            low, high = (starts[i], ends[j - 1]) if j > i else (0, 0)
            hashes.append(tx.span_hashes(part[low:high], starts[i:j] - low, ends[i:j] - low))
        key = tx.mix(np.concatenate(hashes) + lang[row])
        symbol_key, symbol = np.unique(key, return_inverse=True)
        marks = np.concatenate([[0], np.cumsum(cut)])
        begins = np.ones(len(starts), bool)
        begins[1:] = (row[1:] != row[:-1]) | (marks[starts[1:]] != marks[ends[:-1]])
        place = np.arange(len(starts)) + np.cumsum(begins)
        text = np.zeros(len(starts) + int(begins.sum()) + 1, np.int64)
        text[place] = symbol + 1
        word_at = np.full(len(text), -1)
        word_at[place] = np.arange(len(starts))
        yield _Shard(part, starts, ends, key, row, symbol_key, text, word_at)


def _phrase_keys(shard: _Shard, place: np.ndarray, words: int) -> np.ndarray:
    """Keys of the phrases of so many words that begin at these places of the text."""
    word = shard.word_at[place]
    key = shard.key[word]
    for k in range(1, words):
        key = tx.mix(key * _STEP + shard.key[word + k])
    return key


def _lang_keys(langs: np.ndarray) -> np.ndarray:
    """Keys under which all words of a language are counted."""
    return tx.mix(langs * _LANG + _TOTAL)


def _all_phrases(most: int):
    """Keys of a chunk's words, pairs and triples, and of its languages, with their counts."""

    def work(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        langs = _lang_keys(tx.cell_hashes(table.column("lang")))
        for shard in _shards(table, most):
            index = Bidirectional(shard.text, _DEPTH)
            words = index.words()
            pairs = index.left(words)
            triples = index.right(pairs)
            own = [shard.symbol_key, *(_phrase_keys(shard, index.place(p), n) for n, p in ((2, pairs), (3, triples)))]
            sizes = [words.size, pairs.size, triples.size]
            row, n = np.unique(shard.row, return_counts=True)
            found = common.summed(np.concatenate([*own, langs[row]]), np.concatenate([*sizes, n]))
            keys.append(found[0])
            counts.append(found[1])
        return common.summed(np.concatenate(keys), np.concatenate(counts))

    return work


def scores(a: np.ndarray, left: np.ndarray, right: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale a^2 / (l r)), exact beyond 64 bits."""
    whole = a.astype(object)
    return np.array(scale * whole * whole // (left.astype(object) * right.astype(object)), np.int64)


def _candidates(most: int, least: int):
    """FOUND rows of the candidates that this chunk is the first to have, and of the pairs they swallow (by key alone)."""

    def work(table: pa.Table, keys: np.ndarray, totals: np.ndarray, first: np.ndarray) -> pa.Table:
        def look(wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Totals, 0 if below ``least``, and whether they are this chunk's to tell."""
            if not len(keys):
                return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
            order = np.argsort(wanted)
            at = np.empty(len(wanted), np.int64)
            at[order] = np.minimum(np.searchsorted(keys, wanted[order]), len(keys) - 1)
            known = keys[at] == wanted
            return np.where(known, totals[at], 0), known & first[at]

        langs = table.column("lang").combine_chunks()
        lang_total = look(_lang_keys(tx.cell_hashes(table.column("lang"))))[0]
        parts: list[pa.Table] = []
        for shard in _shards(table, most):
            index = Bidirectional(shard.text, _DEPTH)
            word_total = look(shard.symbol_key)[0]
            words = index.words().where(word_total >= least)
            pairs = index.left(words)
            pairs = pairs.where(word_total[pairs.symbol - 1] >= least)
            pair_key = _phrase_keys(shard, index.place(pairs), 2)
            pair_total, pair_own = look(pair_key)
            kept = pair_total >= least
            pairs, pair_key, pair_total, pair_own = pairs.where(kept), pair_key[kept], pair_total[kept], pair_own[kept]
            triples = index.right(pairs)
            triple_key = _phrase_keys(shard, index.place(triples), 3)
            triple_total, triple_own = look(triple_key)
            own = triple_total >= least
            triples, triple_key, triple_total, triple_own = triples.where(own), triple_key[own], triple_total[own], triple_own[own]

            first_word = word_total[pairs.symbol - 1]
            last_word = word_total[shard.text[index.place(pairs) + 1] - 1]
            parts.append(_rows(shard, index, pairs, pair_key, pair_own, langs, lang_total, 2, pair_total, [(first_word, last_word)]))
            tail = index.suffix_of(triples, pairs)
            of_first = word_total[shard.text[index.place(triples)] - 1]
            cuts = [(of_first, pair_total[tail]), (pair_total[triples.parent], word_total[triples.symbol - 1])]
            parts.append(_rows(shard, index, triples, triple_key, triple_own, langs, lang_total, 3, triple_total, cuts))
            for part in (triples.parent, tail):
                swallowed = triple_own & (OF * triple_total >= SHARE * pair_total[part])
                parts.append(_swallowed(np.unique(pair_key[part[swallowed]])))
        rows = pa.concat_tables(parts) if parts else _swallowed(np.zeros(0, np.uint64))
        # Shards of one chunk may have the same candidate; a row of words 0 names a pair to drop.
        marks = tx.mix(rows.column("key").to_numpy().view(np.uint64)) + rows.column("words").to_numpy().astype(np.uint64)
        return rows.take(np.sort(np.unique(marks, return_index=True)[1]))

    return work


def _swallowed(keys: np.ndarray) -> pa.Table:
    none = pa.nulls(len(keys), pa.int64())
    text = pa.nulls(len(keys), pa.string())
    return pa.table(
        {"lang": text, "phrase": text, "words": pa.array(np.zeros(len(keys)), pa.int32()), "key": pa.array(keys.view(np.int64)),
         "a": none, "l": none, "r": none, "n": none, "score": none}
    )


def _rows(
    shard: _Shard, index: Bidirectional, phrases: Phrases, key: np.ndarray, own: np.ndarray, langs: pa.Array,
    lang_total: np.ndarray, words: int, total: np.ndarray, cuts: list[tuple[np.ndarray, np.ndarray]],
) -> pa.Table:
    """FOUND rows of the phrases marked ``own``; ``cuts`` has the totals of both parts for each cut."""
    word = shard.word_at[index.place(phrases)[own]]
    a = total[own]
    best = left = right = None
    for x, y in ((x[own], y[own]) for x, y in cuts):
        score = scores(a, x, y)
        if best is None:
            best, left, right = score, x, y
        else:
            lower = score < best
            best, left, right = np.where(lower, score, best), np.where(lower, x, left), np.where(lower, y, right)
    texts = [tx.span_strings(shard.raw, shard.starts[word + k], shard.ends[word + k]).cast(pa.string()) for k in range(words)]
    row = shard.row[word]
    return pa.table(
        {
            "lang": langs.take(pa.array(row)).cast(pa.string()),
            "phrase": pc.binary_join_element_wise(*texts, " "),
            "words": pa.array(np.full(len(word), words), pa.int32()),
            "key": pa.array(key[own].view(np.int64)),
            "a": pa.array(a, pa.int64()), "l": pa.array(left, pa.int64()), "r": pa.array(right, pa.int64()),
            "n": pa.array(lang_total[row], pa.int64()), "score": pa.array(best, pa.int64()),
        }
    )


def mine(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    spread_by: Sequence[str] = ("doc_id",),
    least: int = LEAST,
    first: int = FIRST,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score; runs jobs. ``spread_by`` names columns of ``docs`` that tell equal texts apart."""
    rows = docs.select(
        F.coalesce(text_col, F.lit("")).alias("text"), F.coalesce(lang_col, F.lit(NO_LANG)).alias("lang"),
        F.xxhash64(*spread_by).alias("_spread"),
    )
    chunks = common.chunks_for(docs.sparkSession, common.text_bytes(rows))
    dealt = common.chunked(rows, chunks, "text", "_spread", F.spark_partition_id())
    replies = common.corpus_counts(dealt, _all_phrases(shard_bytes), chunks, least)
    found = written(common.with_told(dealt, replies, _candidates(shard_bytes, least), FOUND), "candidates")
    swallowed = found.where("words = 0").select(F.col("key").alias("_key")).distinct()
    kept = found.where("words > 0").join(swallowed, (F.col("key") == F.col("_key")) & (F.col("words") == 2), "left_anti")
    order = (F.desc("score"), F.desc("a"), F.col("phrase"))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    kept = kept.withColumn("_salt", salt).withColumn("_nth", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order)))
    ranked = kept.where(F.col("_nth") <= first).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
