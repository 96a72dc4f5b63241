"""Best-fit packing of tokenized documents into sequences of bounded length.

Texts become token ids plus an end id; only documents longer than a sequence are cut. Packing is
best-fit decreasing in bulk-synchronous rounds: each round takes the longest documents left, sends
them to the smallest gap that holds them (its successor in the sorted gaps), the k-th document to
the k-th gap of that size (conflicts are resolved by rank), and puts the smaller gaps back.

Documents of one length, and gaps of one size, are exchangeable. So a round sorts and sweeps runs:
(length, first rank, count) for documents and (size, first sequence, count) for gaps. There are at
most as many lengths as a sequence has tokens, whatever the number of documents, and the sweep is
done once for all of them; ``rounds`` returns runs too. The documents themselves are never
gathered: ranks are counted in parallel and each document finds its place by the run of its rank.

Defined cases: a null or empty text is the end id alone; repeated rows are packed one by one; a
null id is kept; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm import common
from lakeops.llm import text as tx
from lakeops.session import written

LENGTH, END = 2048, 0
STEP = 2 << 20  # bytes of text tokenized at once
#: Words that a Python worker keeps with their ids, in each of two generations, at most.
KNOWN_WORDS = 200_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
# A character that the tokenizer gives one id of its own; it parts the words of one call.
_PART = "\u260e"
_STOPS = ".,;:!?"
_GROUP = 256


class Words:
    """Token ids of words, as bytes, kept for the next text.

    The tokenizer lower-cases, drops white space, never joins what it parts, and takes a run of
    letters as one part and a run of other signs as another. So the ids of a text are those of its
    words in turn, and those of letters with stops after them are the letters' and the stops'.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        mark = self._tokenizer.encode(_PART, add_special_tokens=False).ids
        self._mark = mark[0] if len(mark) == 1 else None
        self._last = np.zeros(self._tokenizer.get_vocab_size(), bool)  # ids that end a part
        self._last[[i for t, i in self._tokenizer.get_vocab().items() if t.endswith("</w>")]] = True

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def _learn(self, words: list[str], glue: str, ends: Callable[[np.ndarray], np.ndarray], skip: int) -> list[str]:
        """Encode words in groups; ``ends`` finds where each word's ids end, ``skip`` ids of glue follow.
        Returns the words of groups that don't come apart as they should."""
        groups = [words[i : i + _GROUP] for i in range(0, len(words), _GROUP)]
        odd = []
        for group, ids in zip(groups, self._encode([glue.join(g) for g in groups])):
            stop = ends(ids)
            if len(stop) != len(group):
                odd += group
                continue
            data, begin = ids.tobytes(), 0
            for word, end in zip(group, (stop * 4).tolist()):
                self._young[word] = data[begin:end]
                begin = end + 4 * skip
        return odd

    def ids(self, words: list[str], letters: list[bool]) -> list[bytes]:
        """Of distinct words; ``letters`` says which have nothing but letters."""
        if len(self._young) > KNOWN_WORDS:
            self._old, self._young = self._young, {}
        young, old, plain, other = self._young, self._old, [], []
        for word, simple in zip(words, letters):
            if word in young:
                continue
            if word in old:
                young[word] = old[word]
            else:
                (plain if simple else other).append(word)
        odd = self._learn(plain, " ", lambda ids: np.flatnonzero(self._last[ids]) + 1, 0)
        if self._mark is not None:
            easy = [w for w in other if w and _PART not in w and "<|" not in w]
            cut = lambda ids: np.append(np.flatnonzero(ids == self._mark), len(ids))
            odd += self._learn(easy, f" {_PART} ", cut, 1)
        rest = odd + [w for w in other if w not in young]
        young.update(zip(rest, (x.tobytes() for x in self._encode(rest))))
        return [young[w] for w in words]


@lru_cache(maxsize=2)
def _words(path: str) -> Words:
    return Words(path)


def _letters(words: pa.Array) -> pa.Array:
    """Words of letters only, which remain so in lower case (one letter does not)."""
    return pc.and_(pc.utf8_is_alpha(words), pc.invert(pc.match_substring(words, "\u0130")))


def _ids(words: Words, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts, an end id after each, and n + 1 offsets."""
    plain = pc.replace_substring_regex(texts, "[\t\n\x0b\x0c\r]", " ")
    split = pc.split_pattern(plain, " ")
    whole = split.flatten()
    bare = pc.utf8_rtrim(whole, characters=_STOPS)
    simple = _letters(bare)
    core = pc.if_else(simple, pc.ascii_lower(bare), whole).dictionary_encode()
    stops = pc.if_else(simple, pc.replace_substring_regex(whole, f"^[^{_STOPS}]*", ""), "").dictionary_encode()
    known = words.ids(core.dictionary.to_pylist(), _letters(core.dictionary).to_pylist())
    n = len(known)
    known += words.ids(stops.dictionary.to_pylist(), [False] * len(stops.dictionary))
    known.append(np.array([END], "<u4").tobytes())

    size = np.fromiter(map(len, known), np.int64, len(known)) // 4
    begin = np.cumsum(size) - size
    codes = np.empty(2 * len(whole), np.int64)
    codes[::2] = core.indices.to_numpy()
    codes[1::2] = stops.indices.to_numpy() + n
    row_ends = 2 * np.cumsum(pc.list_value_length(split).to_numpy())
    codes = np.insert(codes, row_ends, len(known) - 1)
    lengths = size[codes]
    after = np.cumsum(lengths)
    flat = np.frombuffer(b"".join(known), "<u4")
    ids = flat[np.repeat(begin[codes] - (after - lengths), lengths) + np.arange(after[-1])]
    return ids, np.concatenate([[0], after[row_ends + np.arange(len(row_ends))]])


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """PIECES of every row: its ids in cuts of ``length``, the last one shorter."""

    def cut(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(tokenizer)
        for batch in found:
            texts = batch.column("text").cast(pa.large_string()).fill_null("")
            sizes = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy())])
            for i, j in tx.steps(sizes, STEP):
                ids, at = _ids(words, texts[i:j])
                n = np.diff(at)
                count = -(-n // length)
                row = np.repeat(np.arange(j - i), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * length
                size = np.minimum(length, n[row] - start)
                begin = at[:-1][row] + start
                crc = [zlib.crc32(ids[a : a + m]) for a, m in zip(begin.tolist(), size.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row + i)), pa.array(piece, pa.int32()),
                     pa.array(start), pa.array(size), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def rounds(lengths: dict[int, int], length: int = LENGTH) -> np.ndarray:
    """Where ``lengths`` (how many documents have each) go: rows of (length, first rank, count,
    first sequence, offset). The k-th document of a run goes to its k-th sequence."""
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, deque] = {}
    sizes: list[int] = []
    sequences = 0

    def free(size: int, first: int, count: int) -> None:
        if size and count:
            if size not in gaps:
                gaps[size] = deque()
                insort(sizes, size)
            gaps[size].append((first, count))

    for own in sorted(lengths, reverse=True):
        rank, left = 0, lengths[own]
        while left:
            at = bisect_left(sizes, own)
            if at == len(sizes):
                break
            size = sizes[at]
            first, count = gaps[size].popleft()
            taken = min(left, count)
            if taken < count:
                gaps[size].appendleft((first + taken, count - taken))
            if not gaps[size]:
                del gaps[size]
                sizes.pop(at)
            runs.append((own, rank, taken, first, length - size))
            free(size - own, first, taken)
            rank, left = rank + taken, left - taken
        each = length // own
        full, rest = divmod(left, each)
        for k in range(each if full else 0):
            runs.append((own, rank + k * full, full, sequences, k * own))
        free(length - each * own, sequences, full)
        sequences, rank = sequences + full, rank + each * full
        for k in range(rest):
            runs.append((own, rank + k, 1, sequences, k * own))
        if rest:
            free(length - rest * own, sequences, 1)
            sequences += 1
    return np.array(runs, np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """PIECES with ``sequence_id`` and ``offset``; runs jobs. ``tokenizer`` is a file's path."""
    found = written(pieces(docs, tokenizer, id_col, text_col, length), "pieces")
    lengths = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}
    runs = rounds(lengths, length)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    key = (runs[:, 0] << 48) + runs[:, 1]

    parts = max(16, sum(lengths.values()) // 50_000)
    dealt = found.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
    earlier = Window.partitionBy("_length").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(F.col("length").alias("_length"), F.col("_part").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_length", "_of", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("_nth", F.row_number().over(within) - 1).join(
        before, (F.col("length") == F.col("_length")) & (F.col("_part") == F.col("_of"))
    )
    names = [c.split()[0] for c in PIECES.split(", ")]

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        rank = batch.column("_rank").to_numpy()
        run = np.searchsorted(key, (batch.column("length").to_numpy() << 48) + rank, "right") - 1
        sequence = runs[run, 3] + rank - runs[run, 1]
        own = [batch.column(c) for c in names]
        return pa.RecordBatch.from_arrays(
            [*own, pa.array(sequence), pa.array(runs[run, 4])], names=[*names, "sequence_id", "offset"]
        )

    rows = ranked.select(*names, (F.col("_before") + F.col("_nth")).cast("long").alias("_rank"))
    return rows.mapInArrow(common.batches(place), f"{PIECES}, sequence_id long, offset long")
