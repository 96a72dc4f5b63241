"""Quality rules judged by an isolation forest over their statistics.

Every document's rule statistics are computed in one pass over its whole text. Random trees split
a bounded sample of these rows (TREES x SAMPLE of them, the rows of smallest hash of id); rows that
few splits set apart are anomalous. The threshold comes from all labelled rows that pass the base
rules: of the scores'
HISTOGRAM steps, the one where most labelled bad rows less COST times the labelled good ones lie
above. Without labels nothing is rejected by the forest.

Defined cases: a null text counts as empty, an empty one has no words and fails the base rules;
equal texts get equal scores; a null id is an id like any other but has no label; labels of
unknown documents are ignored, several labels of one count each; a very long text is counted whole, in
its batch; an empty table gives an empty result and a forest that rejects nothing; further columns are kept, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm import text as tx
from lakeops.session import scratch_scope, written

TREES, SAMPLE, SEED = 64, 256, 11
HISTOGRAM, COST = 1024, 5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_code_points", "n_lines")
STATS_SCHEMA = ", ".join(f"{c} long" for c in COUNTS + _MORE)
FEATURES = ("symbol_share", "symbols_per_word", "symbol_words", "dup_line_share", "repeat_share", "word_length")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _stats(raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    n = len(offsets) - 1
    starts, ends, first = tx.words(raw, offsets)
    n_words = np.diff(first)
    begins = (raw & 0xC0) != 0x80
    in_word = np.zeros(len(raw) + 1, np.int8)
    in_word[starts] = 1
    np.add.at(in_word, ends, -1)
    in_word = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)

    line_start, line_end, line_first = tx.spans(raw != 10, offsets)
    filled = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(in_word, out=filled[1:])
    wordy = filled[line_end] > filled[line_start]
    line_row = np.repeat(np.arange(n), np.diff(line_first))[wordy]
    lines = tx.span_hashes(raw, line_start[wordy], line_end[wordy])
    n_lines = np.bincount(line_row, minlength=n)
    distinct, cuts = tx.unique_per_row(lines, line_row, n)

    hashes, row, at = tx.windows(tx.span_hashes(raw, starts, ends), first, 3)
    key = tx.mix(hashes + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(starts) + 1, np.int64)
    np.add.at(covered, at[twice], 1)
    np.add.at(covered, at[twice] + 3, -1)
    repeated = np.cumsum(covered[:-1]) > 0

    return [
        n_words, tx.per_row(begins & in_word, offsets), tx.per_row(_SYMBOL[raw], offsets), n_lines - np.diff(cuts),
        tx.per_row(repeated, first), tx.per_row(begins, offsets), n_lines,
    ]


def statistics(column: pa.Array | pa.ChunkedArray) -> dict[str, np.ndarray]:
    """Rule statistics of every text, whole."""
    raw, offsets = tx.strings(column)
    parts = [_stats(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in tx.steps(offsets)]
    names = COUNTS + _MORE
    if not parts:
        return {c: np.zeros(0, np.int64) for c in names}
    return {c: np.concatenate(x).astype(np.int64) for c, x in zip(names, zip(*parts))}


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    at_least_1 = {c: np.maximum(1, stats[c]) for c in ("n_words", "n_code_points", "n_lines")}
    per_word = stats["n_symbols"] / at_least_1["n_words"]
    return np.column_stack(
        [
            stats["n_symbols"] / at_least_1["n_code_points"],
            per_word,
            np.minimum(1, per_word),
            stats["n_dup_lines"] / at_least_1["n_lines"],
            stats["n_repeat_words"] / at_least_1["n_words"],
            stats["word_chars"] / at_least_1["n_words"],
        ]
    )


def base_failed(stats: dict[str, np.ndarray]) -> np.ndarray:
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


class Forest(NamedTuple):
    """Trees as flat arrays, one row per tree: split feature (-1 at leaves), split value, left child
    (the right one follows), and the path length that ends at a leaf."""

    feature: np.ndarray
    value: np.ndarray
    child: np.ndarray
    length: np.ndarray
    expected: float
    threshold: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; the higher, the sooner random splits set the row apart."""
        total = np.zeros(len(rows))
        everyone = np.arange(len(rows))
        for t in range(len(self.feature)):
            node = np.zeros(len(rows), np.int64)
            while True:
                f = self.feature[t][node]
                inner = f >= 0
                if not inner.any():
                    break
                right = rows[everyone, np.maximum(f, 0)] >= self.value[t][node]
                node = np.where(inner, self.child[t][node] + right, node)
            total += self.length[t][node]
        if not len(self.feature):
            return np.zeros(len(rows))
        return np.exp2(-total / len(self.feature) / self.expected)


def _average_path(n: int) -> float:
    """Mean length of an unsuccessful search among n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(rows: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> Forest:
    """A forest of ``rows``, dealt out among the trees; every tree gets ``sample`` of them at most."""
    random = np.random.default_rng(seed)
    depth = max(1, math.ceil(math.log2(sample)))
    built = []
    for t in range(trees if len(rows) else 0):
        own = rows[t::trees][:sample] if len(rows) >= 2 * trees else rows[:sample]
        nodes: list[list[float]] = [[-1, 0.0, 0, 0.0]]
        todo = [(0, own, 0)]
        while todo:
            at, part, level = todo.pop()
            spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(part) else []
            if level >= depth or len(part) < 2 or not len(spread):
                nodes[at][3] = level + _average_path(len(part))
                continue
            f = int(random.choice(spread))
            cut = random.uniform(part[:, f].min(), part[:, f].max())
            right = part[:, f] >= cut
            nodes[at][:3] = [f, cut, len(nodes)]
            todo += [(len(nodes), part[~right], level + 1), (len(nodes) + 1, part[right], level + 1)]
            nodes += [[-1, 0.0, 0, 0.0], [-1, 0.0, 0, 0.0]]
        built.append(np.array(nodes))
    size = max((len(x) for x in built), default=1)
    table = np.array([np.pad(x, ((0, size - len(x)), (0, 0)), constant_values=-1) for x in built]).reshape(-1, size, 4)
    expected = _average_path(min(sample, max(2, len(rows))))
    return Forest(table[:, :, 0].astype(int), table[:, :, 1], table[:, :, 2].astype(int), table[:, :, 3], expected, 1.0)


def _rows(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` as one, ``_row``."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def _rule_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` and the rule statistics of every row, written; runs a job."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def work(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            made = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, made.values())], names=["doc_id", *made])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return written(rows.mapInArrow(work, f"doc_id {kind}, {STATS_SCHEMA}"), "statistics")


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> Forest:
    """Grow the forest and set its threshold; runs jobs over ``stats`` (an id and the statistics).

    ``labels`` has the id and ``quality``, 0 for bad rows. What comes to the driver is the sample,
    TREES x SAMPLE rows, and a histogram of HISTOGRAM steps.
    """
    names = list(COUNTS + _MORE)
    least = stats.orderBy(F.xxhash64(id_col, F.lit(SEED)), *names).limit(TREES * SAMPLE).select(*names)
    sample = written(least, "sample").toPandas()  # executors cut it down first
    forest = grow(features({c: sample[c].to_numpy() for c in names}))
    known = stats.join(labels.select(F.col(id_col).alias("_id"), "quality").dropna(), F.col(id_col) == F.col("_id"))

    def steps(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            stats = {c: batch.column(c).to_numpy() for c in names}
            open_ = pa.array(~base_failed(stats))
            step = np.minimum(HISTOGRAM - 1, (forest.score(features(stats)) * HISTOGRAM).astype(np.int64))
            made = pa.RecordBatch.from_arrays([pa.array(step), batch.column("bad")], names=["step", "bad"])
            yield made.filter(open_)

    counted = known.select(*names, (F.col("quality") == 0).alias("bad")).mapInArrow(steps, "step long, bad boolean")
    gain = np.zeros(HISTOGRAM + 1)
    for step, bad, n in counted.groupBy("step", "bad").count().collect():
        gain[step] += n if bad else -COST * n
    above = np.cumsum(gain[::-1])[::-1]
    return forest._replace(threshold=int(np.argmax(above)) / HISTOGRAM if above.max() > 0 else math.inf)


def verdicts(stats: dict[str, np.ndarray], forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base_failed, the anomaly score, and kept, by the statistics."""
    failed, score = base_failed(stats), forest.score(features(stats))
    return failed, score, ~failed & (score < forest.threshold)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, the rule counts, ``base_failed``, ``anomaly`` and ``kept`` of every row; runs jobs."""
    rows = _rule_statistics(docs, id_col, text_col)
    forest = fit(rows, labels.withColumnRenamed(id_col, "doc_id"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, anomaly double, kept boolean"

    def work(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            made = [pa.array(x) for x in verdicts({c: batch.column(c).to_numpy() for c in COUNTS + _MORE}, forest)]
            own = [batch.column(c) for c in ("doc_id", *COUNTS)]
            yield pa.RecordBatch.from_arrays(own + made, names=["doc_id", *COUNTS, "base_failed", "anomaly", "kept"])

    return rows.mapInArrow(work, schema)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns; runs jobs.

    The statistics are computed again where the rows are, which is cheaper than to shuffle the texts.
    """
    with scratch_scope(docs.sparkSession):
        forest = fit(_rule_statistics(docs, id_col, text_col), labels.withColumnRenamed(id_col, "doc_id"))
    at = docs.columns.index(text_col)

    def work(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            row = batch.column("_row")
            kept = row.filter(pa.array(verdicts(statistics(row.field(at)), forest)[2]))
            yield pa.RecordBatch.from_arrays([kept], names=["_row"])

    rows = _rows(docs)
    return rows.mapInArrow(work, f"_row {rows.schema['_row'].dataType.simpleString()}").select("_row.*")
