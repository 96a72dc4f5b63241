"""Removal of passages that stand in an earlier document, by suffix arrays.

Each byte covered by a string of LENGTH bytes that also starts in a document of smaller id is
removed. Matches are judged on the whole texts' UTF-8 bytes and never cross documents.

One suffix array of a corpus fits no machine, so strings meet in blocks. The minimizer of a string
is the GRAM bytes in it whose hash is least, the leftmost of equals; equal strings have equal
minimizers at equal places. So

1. the minimizers of all strings are counted over the corpus, chunk by chunk
   (``common.corpus_counts``); a string whose minimizer is in one document only is unique;
2. consecutive strings with one minimizer are a piece; pieces go to blocks by the minimizer's
   hash, a content once per chunk with the places where it stands. Of a minimizer in more than
   SPLIT documents each string is a piece of its own and goes by its own hash, so that a block
   stays small however common its minimizer is;
3. a block's different contents, one after the other, get a suffix array by two-stage sorting and
   the common prefixes of neighbours. Runs of suffixes that share LENGTH bytes are the occurrences
   of one string; a place is repeated if its run has a smaller document;
4. repeated places go back to their chunk, which removes what they cover.

The chunks' texts are shuffled once and read three times.

Defined cases: a null text has no bytes; null ids follow all others and never make each other's
strings repeated, nor do rows of equal id; a text of any length is worked on in steps; an empty
table gives an empty result; ``dedup`` ignores further columns, ``remove`` keeps them, whatever
their names. Where a cut parts a character, ``remove`` drops the rest of the character too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm import common
from lakeops.llm import suffix_array as sa
from lakeops.llm import text as tx

LENGTH, GRAM, SPLIT = 50, 16, 4096
BLOCK_BYTES = 2 << 20
_LAST = np.iinfo(np.int64).max
# Arrays of a chunk's pieces for one bucket (key, size, bytes), and of the places where they stand.
_PIECES = (
    "_chunk int, _bucket int, _key binary, _size binary, _bytes binary, "
    "_piece binary, _at_row binary, _at_order binary, _at_start binary"
)
_SPANS = "_chunk int, _at_row binary, _from binary, _to binary"


class Runs(NamedTuple):
    """Runs of consecutive strings of one row that have one minimizer: its hash, the row, the place of
    the first string in the row and in all bytes, and how many strings."""

    key: np.ndarray
    row: np.ndarray
    start: np.ndarray
    place: np.ndarray
    n: np.ndarray


def _order(table: pa.Table) -> pa.Table:
    """A chunk's rows in an order of their own, however they arrived. Equal rows are exchangeable."""
    return table.sort_by([("_order", "ascending"), ("_hash", "ascending")])


def _windows(offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of rows with ranges of bytes: a row longer than a step is cut, with an overlap."""
    for i, j in tx.steps(offsets):
        low, high = int(offsets[i]), int(offsets[j])
        if high - low <= tx.STEP or j > i + 1:
            yield i, j, low, high
        else:
            for at in range(low, high - LENGTH + 1, tx.STEP):
                yield i, j, at, min(high, at + tx.STEP + LENGTH - 1)


def _runs(raw: np.ndarray, offsets: np.ndarray) -> Runs:
    found = []
    for i, j, low, high in _windows(offsets):
        part = raw[low:high]
        n = len(part) - LENGTH + 1
        if n <= 0:
            continue
        at = np.clip(offsets[i : j + 1] - low, 0, high - low)
        row = np.repeat(np.arange(i, j), np.diff(at))
        grams = tx.rolling_hashes(part, GRAM)
        bits = np.uint64(max(1, len(part)).bit_length())
        least = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while 2 * width <= LENGTH - GRAM + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = LENGTH - GRAM + 1 - width
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        inside = row[:n] == row[LENGTH - 1 :]
        new = inside.copy()
        new[1:] &= ~inside[:-1] | (least[1:] != least[:-1]) | (row[1:n] != row[: n - 1])
        first = np.flatnonzero(new)
        # a run ends where the next one begins, or where strings would leave the row
        size = np.diff(np.append(first, n))
        size = np.minimum(size, at[row[first] - i + 1] - LENGTH + 1 - first)
        minimizer = (least[first] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        # Hashed again: least hashes are small, and buckets go by a key's size.
        key = tx.mix(grams[minimizer] + np.uint64(GRAM))
        found.append((key, row[first], first + low - offsets[row[first]], first + low, size))
    empty = (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 4)
    return Runs(*(np.concatenate(x) for x in zip(empty, *found)))


def _counts(runs: Runs, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimizers of a chunk and the number of its documents that have them."""
    return common.summed(tx.unique_per_row(runs.key, runs.row, n_rows)[0])


def _keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return _counts(_runs(*tx.strings(table.column("text"))), len(table))


def _pack(x: np.ndarray) -> bytes:
    """Any numbers."""
    return tx.squeeze(x.astype("<i8").view(np.uint8).reshape(-1, 8))


def _unpack(data: bytes) -> np.ndarray:
    return tx.spread(data, 8).view("<i8").ravel()


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names, kinds = zip(*(f.split() for f in schema.split(", ")))
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.table([pa.array(c, pa.int32() if k == "int" else pa.binary()) for c, k in zip(columns, kinds)], names=list(names))


def _gather(raw: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    after = np.cumsum(size)
    return raw[np.repeat(begin - (after - size), size) + np.arange(after[-1] if len(size) else 0)]


def _in_steps(raw: np.ndarray, place: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of pieces, some at a time: with fewer than STEP bytes together, whatever a piece's length."""
    some = tx.STEP // (2 * LENGTH)
    for i in range(0, len(place), some):
        at, n = place[i : i + some], size[i : i + some]
        after = np.cumsum(n)
        yield tx.span_hashes(_gather(raw, at, n), after - n, after)


def _shared_pieces(bits: int, split: int):
    """A chunk's pieces whose minimizer several documents have, each content once, by bucket."""

    def work(table: pa.Table, totals: np.ndarray) -> pa.Table:
        table = _order(table)
        raw, offsets = tx.strings(table.column("text"))
        orders = table.column("_order").to_numpy()
        runs = _runs(raw, offsets)
        keys, _ = _counts(runs, len(table))
        times = common.found_in(keys, totals, runs.key)
        whole, single = (times > 1) & (times <= split), times > split
        n = runs.n[single]  # strings of the runs that are split, and no others, become rows of arrays
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        both = lambda x: np.concatenate([x[whole], np.repeat(x[single], n)])
        add = np.concatenate([np.zeros(whole.sum(), np.int64), step])
        row, start, place = both(runs.row), both(runs.start) + add, both(runs.place) + add
        size = np.concatenate([runs.n[whole], np.ones(len(step), np.int64)]) + LENGTH - 1
        content = np.concatenate([np.zeros(0, np.uint64), *_in_steps(raw, place, size)])
        key = np.concatenate([runs.key[whole], content[whole.sum() :]])
        content = tx.mix(content + key)
        if not len(key):
            return _table([], _PIECES)
        # one of each content, in the order of keys; places follow their content
        order = np.lexsort((start, row, content, key))
        new = np.append(True, (key[order][1:] != key[order][:-1]) | (content[order][1:] != content[order][:-1]))
        piece = np.cumsum(new) - 1
        firsts = order[new]
        cuts = common.bucket_cuts(key[firsts], bits)
        at = np.searchsorted(piece, cuts)
        chunk, out = table.column("_chunk")[0].as_py(), []
        for b in np.flatnonzero(np.diff(cuts)):
            own, places = firsts[cuts[b] : cuts[b + 1]], order[at[b] : at[b + 1]]
            data = tx.squeeze(_gather(raw, place[own], size[own]).reshape(-1, 1))
            which = piece[at[b] : at[b + 1]] - cuts[b]
            arrays = (which, row[places], orders[row[places]], start[places])
            out.append((chunk, int(b), tx.pack(key[own]), _pack(size[own]), data, *map(_pack, arrays)))
        return _table(out, _PIECES)

    return work


def _least_documents(data: np.ndarray, size: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each string of the contents that follow one another in ``data``, in order of place, its least
    owner, by the block's suffix array."""
    word = sa.words(data)
    # Bytes to the content's end, if fewer than LENGTH.
    left = np.minimum(np.repeat(np.cumsum(size, dtype=np.int32), size) - np.arange(len(data), dtype=np.int32), LENGTH).astype(np.uint8)
    fits = left >= LENGTH
    # A place behind the last string helps to order those before it, and only that far.
    order = sa.suffix_array(data, word, left)
    order = order[fits[order]]
    begins = np.flatnonzero(sa.common_prefixes(order, word, LENGTH) < LENGTH)
    least = np.minimum.reduceat(np.repeat(owner, size)[order], begins)
    out = np.full(len(data), _LAST)
    out[order] = np.repeat(least, np.diff(np.append(begins, len(order))))
    return out[fits]


def _repeated(table: pa.Table) -> pa.Table:
    """The repeated places of one bucket's pieces, for each chunk."""
    column = lambda name: [x.as_py() for x in table.column(name)]
    sizes, pieces = [_unpack(x) for x in column("_size")], [_unpack(x) for x in column("_piece")]
    key = np.concatenate([tx.unpack(x) for x in column("_key")])
    body = np.concatenate([tx.spread(x, 1).ravel() for x in column("_bytes")])
    row, order, start = (np.concatenate([_unpack(x) for x in column(c)]) for c in ("_at_row", "_at_order", "_at_start"))
    base = np.cumsum([0, *map(len, sizes)])
    piece = np.concatenate([p + b for p, b in zip(pieces, base)])
    place_cut = np.cumsum([0, *map(len, pieces)])
    size = np.concatenate(sizes)
    begin = np.cumsum(size) - size

    # Each content once, contents of one key together.
    content = tx.mix(np.concatenate([np.zeros(0, np.uint64), *_in_steps(body, begin, size)]) + key)
    by_key = np.lexsort((content, key))
    new = np.append(True, (key[by_key][1:] != key[by_key][:-1]) | (content[by_key][1:] != content[by_key][:-1]))
    distinct = np.empty(len(key), np.int64)
    distinct[by_key] = np.cumsum(new) - 1
    first = by_key[new]
    own_size = size[first]
    owner = np.full(len(first), _LAST)
    np.minimum.at(owner, distinct[piece], order)

    # Blocks end where a key does.
    own_begin = np.cumsum(own_size) - own_size
    own_n = own_size - LENGTH + 1
    own_string = np.cumsum(own_n) - own_n
    least = np.empty(int(own_n.sum()), np.int64)
    ends = np.append(np.flatnonzero(key[first][1:] != key[first][:-1]) + 1, len(first))
    done = 0
    while done < len(first):
        over = np.searchsorted(own_begin[ends - 1] + own_size[ends - 1], own_begin[done] + BLOCK_BYTES)
        upto = ends[min(over, len(ends) - 1)]
        part = slice(done, upto)
        found = _least_documents(_gather(body, begin[first[part]], own_size[part]), own_size[part], owner[part])
        least[own_string[done] : own_string[done] + len(found)] = found
        done = upto

    out = []
    for k, chunk in enumerate(table.column("_chunk").to_pylist()):
        places = slice(place_cut[k], place_cut[k + 1])
        which, mine = distinct[piece[places]], order[places]
        n = own_n[which]
        offsets = np.concatenate([[0], np.cumsum(n)])
        parts = []
        for i, j in tx.steps(offsets):
            before = _gather(least, own_string[which[i:j]], n[i:j]) < np.repeat(mine[i:j], n[i:j])
            at = offsets[i : j + 1] - offsets[i]
            low, high, firsts = tx.spans(before, at)
            place = np.repeat(np.arange(j - i), np.diff(firsts))
            move = start[places][i:j][place] - at[:-1][place]
            parts.append((row[places][i:j][place], low + move, high - 1 + move + LENGTH))
        found = [np.concatenate(x) for x in zip(*parts)]
        if found and len(found[0]):
            out.append((chunk, *map(_pack, found)))
    return _table(out, _SPANS)


def _cut(kept_text: bool):
    """Remove what spans cover from a chunk's texts."""

    def work(table: pa.Table, spans: pa.Table) -> pa.Table:
        table = _order(table)
        raw, offsets = tx.strings(table.column("text"))
        row, low, high = (
            np.concatenate([np.zeros(0, np.int64), *(_unpack(x.as_py()) for x in spans.column(c))]) for c in ("_at_row", "_from", "_to")
        )
        by_row = np.argsort(row, kind="stable")
        row, low, high = row[by_row], low[by_row], high[by_row]
        removed, n_spans, kept = [], [], []
        for i, j in tx.steps(offsets):
            own, at = slice(*np.searchsorted(row, [i, j])), offsets[i : j + 1] - offsets[i]
            part, size, move = raw[offsets[i] : offsets[j]], int(at[-1]) + 1, at[row[own] - i]
            depth = np.bincount(move + low[own], minlength=size) - np.bincount(move + high[own], minlength=size)
            covered = np.cumsum(depth[:-1]) > 0
            removed.append(tx.per_row(covered, at))
            n_spans.append(np.diff(tx.spans(covered, at)[2]))
            kept += [(part[a:b][~covered[a:b]] if n else part[a:b]).tobytes() for a, b, n in zip(at, at[1:], removed[-1])]
        removed, n_spans = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (removed, n_spans))
        if kept_text:
            text = pa.array([x.decode("utf-8", "ignore") if n else None for x, n in zip(kept, removed)], pa.string())
            cut = pa.array(removed > 0)
            whole = table.column("text").combine_chunks()
            return pa.table({"_row": table.column("_row"), "_left": pc.if_else(cut, text, whole)})
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_bytes": np.diff(offsets),
                "n_removed": removed,
                "n_spans": n_spans,
                "kept_sha256": [hashlib.sha256(x).hexdigest() for x in kept],
            }
        )

    return work


def _run(rows: DataFrame, split: int, schema: str, kept_text: bool) -> DataFrame:
    rows = rows.withColumn("_order", F.coalesce("doc_id", F.lit(_LAST))).withColumn("_hash", F.xxhash64("text"))
    chunks = common.chunks_for(rows.sparkSession, common.text_bytes(rows))
    bits = common.bucket_bits(chunks)
    dealt = common.chunked(rows, chunks, "doc_id", "_hash")
    replies = common.corpus_counts(dealt, _keys, chunks)
    pieces = common.with_replies(dealt, replies, _shared_pieces(bits, split), _PIECES)
    blocks = pieces.repartitionById(1 << bits, "_bucket").groupBy("_bucket").applyInArrow(_repeated, _SPANS)
    spans = blocks.repartitionById(chunks, "_chunk")
    return dealt.groupBy("_chunk").cogroup(spans.groupBy("_chunk")).applyInArrow(_cut(kept_text), schema)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", split: int = SPLIT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of every row; runs a small job."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _run(rows, split, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", False)


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", split: int = SPLIT) -> DataFrame:
    """The rows of ``docs`` with what is left of their texts; runs a small job."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.struct(F.col(id_col).alias("_"), *others).alias("_row"))
    cut = _run(rows, split, f"_row {rows.schema['_row'].dataType.simpleString()}, _left string", True)
    return cut.select(*[F.col("_left").alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns])
