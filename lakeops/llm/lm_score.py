"""Language-model scoring with a weighted backoff automaton.

The model is an interpolated bigram model with Dirichlet smoothing. With c the training counts,
N tokens, V of them distinct, and s = PRIOR:

    p(w)     = (c(w) + 1) / (N + V + 1)
    p(w | v) = (c(v w) + s p(w)) / (c(v) + s)

As an automaton: a state for the start and for each known word; an arc from v to w, of weight
log p(w | v), for each bigram that occurs in training; a failure arc from v to the root, of weight
log s / (c(v) + s); at the root an arc for every word, of weight log p(w). A text is read from left
to right once; each token takes the arc of the present state, or the failure arc and then the
root's, and its word is the next state. The weights of one state sum to one.

The corpus is dealt into chunks; each gets the arcs its own texts may take, with counts over all
training rows (``common.corpus_counts``), and walks its texts at once as arrays. So the model may
grow with the corpus: no machine ever holds it whole.

Defined cases: a null or blank text has the end token alone; repeated rows each count; a null id
has a remainder of its own (its crc32 is null) and is held out; a very long text is read whole, in its
chunk; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm import common
from lakeops.llm import text as tx

PRIOR = 100.0
SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)
# Hashes of the tokens that are no words, and what tells a bigram from a word.
START, END = np.uint64(0x51A7), np.uint64(0xE4D)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 7 == 2, F.lit(True))


def _tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of each row and its end token, and n + 1 offsets."""
    raw = tx.folded(raw)
    starts, ends, first = tx.words(raw, offsets)
    at = first + np.arange(len(first))
    tokens = np.full(at[-1], END, np.uint64)
    inside = np.ones(at[-1], bool)
    inside[at[1:] - 1] = False
    tokens[inside] = tx.span_hashes(raw, starts, ends)
    return tokens, at


def _states(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The state in which each token is read: the token before it, or the start."""
    states = np.empty_like(tokens)
    states[1:] = tokens[:-1]
    states[at[:-1]] = START
    return states


def _bigrams(states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return tx.mix(tx.mix(states + _PAIR) * np.uint64(3) + tokens)


def _read(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray, int, int]]:
    """Tokens, offsets, and the range of rows, a step of bytes at a time."""
    raw, offsets = tx.strings(table.column("text"))
    return [
        (*_tokens(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), i, j) for i, j in tx.steps(offsets)
    ]


def _keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All words, states and bigrams of a chunk with their counts in its training rows."""
    train = ~table.column("held_out").to_numpy()
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for tokens, at, i, j in _read(table):
        own = np.repeat(train[i:j], np.diff(at)).astype(np.int64)
        begins = np.full(j - i, START, np.uint64)
        every = np.concatenate([tokens, begins, _bigrams(_states(tokens, at), tokens)])
        found = common.summed(every, np.concatenate([own, train[i:j].astype(np.int64), own]))
        keys.append(found[0])
        counts.append(found[1])
    return common.summed(np.concatenate(keys), np.concatenate(counts))


def training_tokens(rows: DataFrame, chunks: int) -> tuple[int, int]:
    """Number of tokens in the texts of ``rows``, and of distinct ones; runs a job."""
    bits = common.bucket_bits(chunks)

    def distinct_words(batch: pa.RecordBatch) -> pa.RecordBatch:
        read = _read(pa.Table.from_batches([batch]))
        keys = np.unique(np.concatenate([np.zeros(0, np.uint64), *(tokens for tokens, *_ in read)]))
        cuts = common.bucket_cuts(keys, bits)
        tokens = np.zeros(1 << bits, np.int64)
        tokens[0] = sum(len(x) for x, *_ in read)
        packed = [tx.pack(keys[cuts[b] : cuts[b + 1]]) for b in range(1 << bits)]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.arange(1 << bits)), pa.array(tokens), pa.array(packed, pa.binary())],
            names=["_bucket", "tokens", "_keys"],
        )

    def add(table: pa.Table) -> pa.Table:
        keys = np.unique(np.concatenate([tx.unpack(x.as_py()) for x in table.column("_keys")]))
        return pa.table({"tokens": [sum(table.column("tokens").to_pylist())], "words": [len(keys)]})

    asked = rows.select("text").mapInArrow(common.batches(distinct_words), "_bucket long, tokens long, _keys binary")
    found = asked.groupBy("_bucket").applyInArrow(add, "tokens long, words long")
    tokens, words = found.agg(F.sum("tokens"), F.sum("words")).head()
    return tokens or 0, words or 0


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prior: float = PRIOR) -> DataFrame:
    """The contract's columns for every row of ``docs``; runs jobs."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), held_out(F.col(id_col)).alias("held_out")
    )
    chunks = common.chunks_for(docs.sparkSession, common.text_bytes(rows))
    total, distinct = training_tokens(rows.where("not held_out"), chunks)
    dealt = common.chunked(rows, chunks, "doc_id", "text")
    replies = common.corpus_counts(dealt, _keys, chunks)
    return common.with_replies(dealt, replies, _walk(total, distinct, prior), SCHEMA)


def _walk(total: int, distinct: int, prior: float):
    size = total + distinct + 1

    def walk(table: pa.Table, totals: np.ndarray) -> pa.Table:
        known_keys, _ = _keys(table)

        def count(keys: np.ndarray) -> np.ndarray:
            return common.found_in(known_keys, totals, keys)

        starts = count(np.array([START]))[0]
        out = {name: [] for name in ("n_tokens", "n_known", "base_score", "score")}
        for tokens, at, _, _ in _read(table):
            seen = count(tokens)
            base = (seen + 1.0) / size
            arc = count(_bigrams(_states(tokens, at), tokens))
            visits = np.empty_like(seen)
            visits[1:] = seen[:-1]
            visits[at[:-1]] = starts
            taken = np.log10((arc + prior * base) / (visits + prior))
            failure = np.log10(prior / (visits + prior))
            root = np.log10(base)
            weight = np.where(arc > 0, taken, failure + root)
            out["n_tokens"].append(np.diff(at))
            out["n_known"].append(tx.per_row(seen > 0, at))
            out["base_score"].append(np.add.reduceat(root, at[:-1]))
            out["score"].append(np.add.reduceat(weight, at[:-1]))
        made = {k: np.concatenate(v) for k, v in out.items()}
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "held_out": table.column("held_out"),
                "n_tokens": made["n_tokens"],
                "n_known": made["n_known"],
                "train_tokens": np.full(len(table), total),
                "base_score": made["base_score"],
                "score": made["score"],
            }
        )

    return walk
