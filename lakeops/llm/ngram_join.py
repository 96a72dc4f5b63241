"""Self-join of documents by the Jaccard similarity of their word shingles, by count vectors.

A document's set has the 64-bit hashes of its distinct 5-word shingles. Two documents link when
100 * intersection >= 80 * union. All links between different sets count; what is returned is
connected components.

1. Half of all shingles (by a bit of their hash) are counted over the corpus, chunk by chunk
   (``common.corpus_counts``). A set of n that links with another shares all but n / 5 of its
   shingles with it, so one with more shingles that no other document has is alone.
2. In any order of all shingles, sets that link share one of their first n / 5 + 1. The order begins
   with the rarest counted ones and ends with those that weren't counted. What remains of a set's first
   ones without those that no other document has are the keys of blocks, so a line that many documents
   have makes no block of them all. A set is in as many blocks as it has keys, as a number, without its
   content. Of blocks with the same members one is kept.
3. A block belongs to its member with the fewest shingles of its own, as that is the likeliest to
   link with all others of a group of copies. Blocks of one owner are a group, with every set once.
   A group of many bytes is cut into tiles, and every two tiles meet in a task of their own.
4. In a group, every set is first compared with the owner. Then the sets' counts of hashes by
   GROUPS groups of hashes are points of a count-vector R-tree. Two nodes are descended into, down
   to two sets, only if the sum over coordinates of the lesser of their maxima can reach the overlap
   that a link needs, and if they aren't of one component already. Pairs that remain are verified
   with the whole sets, some at a time, and what gets connected is not descended into any more.

So a group of copies is compared with one of them, not each with each, and no link between
different components is lost: what shares no key, or is below the bound, cannot link. Links leave
a group only where they connect what was not.

Defined cases: null, empty and blank texts have no set, link with nothing and are their own
component; with fewer words than a shingle all words are one shingle; repeated rows and equal texts
are one set; a null id has part in links, is never a component's id while another one is there; a very
long text has a set of all its shingles, held by the tasks that verify its pairs; an empty table gives
an empty result; further columns are ignored by ``join`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm import common
from lakeops.llm import text as tx
from lakeops.llm.components import components
from lakeops.session import scratch_scope, shuffles_freed, written

WORDS, SHARE, OF = 5, 80, 100  # a link needs OF * intersection >= SHARE * union
GROUPS, FANOUT, TILE_BYTES = 128, 16, 8 << 20
NODES, PAIRS = 512, 4096  # pairs of nodes that are descended into, and of sets that are verified, at a time
_SETS = "doc_id long, _hash long, n long, set_id long, alone long, shingles binary, keyed binary"
# Sets are compared by the upper 48 bits of their hashes, which take a third less room.
_DROPPED = np.uint64(16)
_NONE = np.zeros(0, np.uint64)


def _sets(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct shingles of some rows at a time, and their offsets."""
    raw, offsets = tx.strings(table.column("text"))
    for i, j in tx.steps(offsets):
        part, at = tx.folded(raw[offsets[i] : offsets[j]]), offsets[i : j + 1] - offsets[i]
        starts, ends, first = tx.words(part, at)
        yield tx.unique_per_row(*tx.shingles(tx.span_hashes(part, starts, ends), first, WORDS), j - i)


def _counted(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(1)) == 0


def _keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return common.summed(np.concatenate([_NONE, *(s[_counted(s)] for s, _ in _sets(table))]))


def _spare(n: np.ndarray) -> np.ndarray:
    """How many of n shingles a set that it links with may lack."""
    return n - -(-SHARE * n // OF)


def _block_keyed(totals: np.ndarray, row: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which shingles, in order of row and hash, are keys: of each row's first ones, where those of least total come
    first, the ones whose total isn't 1. ``n`` has the size of each shingle's set."""
    order = np.lexsort((totals, row))
    first = np.append(True, row[1:] != row[:-1])
    place = np.arange(len(row)) - np.maximum.accumulate(np.where(first, np.arange(len(row)), 0))
    keyed = np.zeros(len(row), bool)
    keyed[order[place <= _spare(n)]] = True
    return keyed & (totals != 1)


def _sets_of_chunk(table: pa.Table, totals: np.ndarray) -> pa.Table:
    keys, _ = _keys(table)
    sizes, ids, lone, kept, keyed = [], [], [], [], []
    for shingles, at in _sets(table):
        n = np.diff(at)
        counted = _counted(shingles)
        often = np.full(len(shingles), np.iinfo(np.int64).max)
        often[counted] = common.found_in(keys, totals, shingles[counted])
        alone = often == 1
        total = np.zeros(len(shingles) + 1, np.uint64)
        np.cumsum(tx.mix(shingles + np.uint64(1)), out=total[1:])
        ids.append(tx.mix((total[at[1:]] - total[at[:-1]]) * np.uint64(3) + n.astype(np.uint64)).view(np.int64))
        sizes.append(n)
        lone.append(tx.per_row(alone, at))
        may_link = (n > 0) & (lone[-1] <= _spare(n))
        short = shingles >> _DROPPED
        kept += [tx.pack(short[at[k] : at[k + 1]]) if ok else None for k, ok in enumerate(may_link)]
        of = np.repeat(np.arange(len(n)), n)
        of = of[may_link[of]]
        marks = np.zeros(len(shingles), bool)
        marks[np.repeat(may_link, n)] = _block_keyed(often[np.repeat(may_link, n)], of, n[of])
        keyed += [np.packbits(marks[at[k] : at[k + 1]]).tobytes() if ok else None for k, ok in enumerate(may_link)]
    return pa.table(
        {
            "doc_id": table.column("doc_id"),
            "_hash": table.column("_hash"),
            "n": np.concatenate([np.zeros(0, np.int64), *sizes]),
            "set_id": np.concatenate([np.zeros(0, np.int64), *ids]),
            "alone": np.concatenate([np.zeros(0, np.int64), *lone]),
            "shingles": pa.array(kept, pa.binary()),
            "keyed": pa.array(keyed, pa.binary()),
        }
    )


def shingle_sets(docs: DataFrame) -> DataFrame:
    """_SETS of every row of ``docs`` (doc_id, text): its size and a number of its set, and the set
    itself, with a bit for each shingle that is a key, if it may link; runs a job."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"))
    chunks = common.chunks_for(docs.sparkSession, common.text_bytes(rows))
    dealt = common.chunked(rows, chunks, "doc_id", "_hash")
    replies = common.corpus_counts(dealt, _keys, chunks)
    return common.with_replies(dealt, replies, _sets_of_chunk, _SETS)


def _block_keys(batch: pa.RecordBatch) -> pa.Table:
    """Keys of each set, with its number and the share of its shingles that no other set has."""
    sets = list(zip(*(batch.column(c).to_pylist() for c in ("shingles", "set_id", "n", "alone", "keyed"))))
    keys = [tx.unpack(packed)[np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)] for packed, _, n, _, bits in sets]
    count = [len(k) for k in keys]
    each = lambda values: np.repeat(np.array(values, np.int64), count)
    return pa.table(
        {
            "key": np.concatenate([_NONE, *keys]).view(np.int64),
            "set_id": each([s[1] for s in sets]),
            "odd": each([1_000_000 * s[3] // s[2] for s in sets]),
        }
    )


def points(shingles: np.ndarray) -> np.ndarray:
    """How many hashes of a set fall into each group."""
    return np.bincount((shingles % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS).astype(np.int32)


class CountTree:
    """A packed R-tree over count vectors: leaves in order of size, FANOUT to a node.

    A node needs no minima for an upper bound of overlaps: the coordinates' maxima, and its least
    and largest size.
    """

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray) -> None:
        order = np.lexsort((*(vectors[:, k] for k in range(min(4, vectors.shape[1]))), sizes))
        self.order = order
        self.levels = [(vectors[order].astype(np.int32, copy=False), sizes[order], sizes[order])]
        while len(self.levels[-1][0]) > FANOUT:
            top, low, high = self.levels[-1]
            at = np.arange(0, len(top), FANOUT)
            self.levels.append((np.maximum.reduceat(top, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))

    def _possible(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        top, low, high = self.levels[level]
        bound = np.empty(len(a), np.int64)
        for i in range(0, len(a), 8192):
            bound[i : i + 8192] = np.minimum(top[a[i : i + 8192]], top[b[i : i + 8192]]).sum(1)
        sizes = (OF * high[a] >= SHARE * low[b]) & (OF * high[b] >= SHARE * low[a])
        # intersection >= SHARE / (OF + SHARE) of the sum of both sizes
        return sizes & ((OF + SHARE) * bound >= SHARE * (low[a] + low[b]))

    def _one_root(self, root: np.ndarray) -> list[np.ndarray]:
        """For each level the component that all points of a node are of, or -1."""
        low = high = root[self.order]
        found = [low]
        for _ in self.levels[1:]:
            at = np.arange(0, len(low), FANOUT)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            found.append(np.where(low == high, low, -1))
        return found

    def batches(self, parts: _Parts | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of points that the bound does not exclude, as numbers of the given vectors, a bounded
        number at a time; with ``parts``, which may grow meanwhile, those of different components."""
        joins, one = -1, []

        def apart(level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            nonlocal joins, one
            if parts is None:
                return a, b
            if joins != parts.joins:
                joins, one = parts.joins, self._one_root(parts.of)
            ok = (one[level][a] != one[level][b]) | (one[level][a] < 0)
            return a[ok], b[ok]

        def left(level: int, a: np.ndarray, b: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
            a, b = apart(level, a, b)
            ok = self._possible(level, a, b)
            if level == 0:
                ok &= a != b
            return level, a[ok], b[ok]

        top = len(self.levels) - 1
        todo = [left(top, *np.triu_indices(len(self.levels[top][0])))]
        while todo:
            level, a, b = todo.pop()
            if level == 0:
                yield self.order[a], self.order[b]
                continue
            if len(a) > NODES:  # what waits is not descended into yet, so that it stays small
                todo.append((level, a[NODES:], b[NODES:]))
            a, b = apart(level, a[:NODES], b[:NODES])
            n = len(self.levels[level - 1][0])
            x = (a[:, None, None] * FANOUT + np.arange(FANOUT)[None, :, None]).repeat(FANOUT, 2).ravel()
            y = (b[:, None, None] * FANOUT + np.arange(FANOUT)[None, None, :]).repeat(FANOUT, 1).ravel()
            inside = (x < n) & (y < n) & (x <= y)
            todo.append(left(level - 1, x[inside], y[inside]))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """All of ``batches`` at once."""
        found = list(self.batches())
        x, y = (np.concatenate([p[k] for p in found]) for k in (0, 1))
        return x, y


class _Parts:
    """Components of a group's sets: ``of`` has a number for each set, the same for those connected."""

    def __init__(self, n: int) -> None:
        self.of, self.joins = np.arange(n), 0
        self._members = [[x] for x in range(n)]

    def join(self, x: int, y: int) -> None:
        less, more = sorted((int(self.of[x]), int(self.of[y])), key=lambda p: len(self._members[p]))
        self.of[self._members[less]] = more
        self._members[more] += self._members[less]
        self._members[less] = []
        self.joins += 1


def _links_of(sets: list[np.ndarray], odd: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect all sets of a group that are connected in it, as numbers in the list."""
    n = np.array([len(s) for s in sets])
    parts, found = _Parts(len(sets)), []

    def compare(x: int, y: int) -> None:
        if parts.of[x] == parts.of[y]:
            return
        both = np.concatenate([sets[x], sets[y]])
        both.sort()
        shared = int((both[1:] == both[:-1]).sum())
        if OF * shared >= SHARE * (len(both) - shared):
            parts.join(x, y)
            found.append((x, y))

    owner = int(odd.argmin())
    close = OF * np.minimum(n, n[owner]) >= SHARE * np.maximum(n, n[owner])
    for x in np.flatnonzero(close).tolist():
        compare(owner, x)
    if len(found) == len(sets) - 1:
        return found
    for a, b in CountTree(np.stack([points(s) for s in sets]), n).batches(parts):
        while len(a):
            apart = parts.of[a] != parts.of[b]
            a, b = a[apart], b[apart]
            for x, y in zip(a[:PAIRS].tolist(), b[:PAIRS].tolist()):
                compare(x, y)
            a, b = a[PAIRS:], b[PAIRS:]
    return found


def _links(table: pa.Table) -> pa.Table:
    """The links of all groups of one task."""
    group = table.column("group").to_numpy()
    ids, odd = table.column("set_id").to_numpy(), table.column("odd").to_numpy()
    packed = table.column("shingles")
    order = np.lexsort((ids, odd, group))
    cuts = np.append(np.flatnonzero(np.append(True, group[order][1:] != group[order][:-1])), len(order))
    a, b = [], []
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        rows = order[i:j]
        for x, y in _links_of([tx.unpack(packed[int(r)].as_py()) for r in rows], odd[rows]):
            a.append(ids[rows[x]])
            b.append(ids[rows[y]])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def links(sets: DataFrame) -> DataFrame:
    """``node`` and ``component`` of every set of ``sets`` (set_id, n, alone, shingles, keyed) that links; runs jobs."""
    tasks = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sets = written(sets.dropDuplicates(["set_id"]), "sets")
    keys = written(sets.mapInArrow(common.batches(_block_keys), "key long, set_id long, odd long"), "keys")
    members = keys.groupBy("key").agg(
        F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("set_id")).alias("x"),
        F.sum(F.xxhash64("set_id", F.lit(1)).bitwiseAND((1 << 40) - 1)).alias("y"),
        F.min(F.struct("odd", "set_id")).alias("first"),
    )
    # Of blocks with the same members one is enough, of those with one member none.
    distinct = members.where("m > 1").groupBy("m", "x", "y").agg(F.min(F.struct("key", "first")).alias("one"))
    blocks = written(distinct.select(F.col("one.key").alias("_key"), F.col("one.first.set_id").alias("owner")), "blocks")
    grouped = keys.join(blocks, F.col("key") == F.col("_key")).select("owner", "set_id", "odd").distinct()
    sizes = sets.select(F.col("set_id").alias("_set"), F.octet_length("shingles").alias("bytes"))
    grouped = written(grouped.join(sizes, F.col("set_id") == F.col("_set")).drop("_set"), "groups")

    tiles = grouped.groupBy(F.col("owner").alias("_owner")).agg(F.ceil(F.sum("bytes") / TILE_BYTES).cast("int").alias("tiles"))
    placed = grouped.join(written(tiles, "tiles"), F.col("owner") == F.col("_owner"))
    own = F.pmod(F.xxhash64("set_id"), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    met = placed.select("owner", "set_id", "odd", "bytes", own.alias("own"), other.alias("other"))
    group = F.xxhash64("owner", F.least("own", "other"), F.greatest("own", "other"))
    met = written(met.select(group.alias("group"), "set_id", "odd", "bytes"), "groups")
    total = met.agg(F.sum("bytes")).head()[0] or 0
    buckets = max(tasks, total // TILE_BYTES)
    contents = sets.select(F.col("set_id").alias("_set"), "shingles")
    whole = met.join(contents, F.col("set_id") == F.col("_set")).select("group", "set_id", "odd", "shingles")
    dealt = whole.withColumn("_bucket", F.pmod(F.col("group"), F.lit(buckets)).cast("int")).repartitionById(buckets, "_bucket")
    return components(written(dealt.groupBy("_bucket").applyInArrow(_links, "a long, b long"), "links"))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``text_hash`` of every row; runs jobs."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with scratch_scope(docs.sparkSession), shuffles_freed(docs.sparkSession):
        rows = written(shingle_sets(rows), "shingles")
        parts = written(links(rows.where("shingles is not null").select("set_id", "n", "alone", "shingles", "keyed")), "components")
        labelled = rows.drop("shingles", "alone", "keyed").join(parts, F.col("set_id") == F.col("node"), "left")
        label = F.coalesce("component", "set_id").alias("label")
        labelled = written(labelled.select("doc_id", "_hash", "n", label), "labels")
        firsts = labelled.where("n > 0").groupBy(F.col("label").alias("_label")).agg(F.min("doc_id").alias("first"))
        named = labelled.join(written(firsts, "firsts"), (F.col("label") == F.col("_label")) & (F.col("n") > 0), "left")
        component = F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("doc_id")).alias("component_id")
        found = named.select("doc_id", F.col("n").alias("n_shingles"), component, F.col("_hash").alias("text_hash"))
        return written(found, "joined", outlives=True)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that link, over others, with one of smaller id; runs jobs.

    Of rows alike in id and component one stays; a document without words always does.
    """
    found = join(docs, id_col, text_col)
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    first = Window.partitionBy("doc_id").orderBy(F.desc("n_shingles"), "text_hash")
    stays = found.where(own).withColumn("_nth", F.row_number().over(first)).where("_nth = 1 or n_shingles = 0")
    kept = stays.groupBy("doc_id", "text_hash").agg(F.count_if(F.col("n_shingles") == 0).alias("_empty"))
    with shuffles_freed(docs.sparkSession):
        kept = written(kept, "kept")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_of"),
    )
    joined = rows.join(kept, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_of") == F.col("text_hash")))
    nth = F.row_number().over(Window.partitionBy("_id", "_of").orderBy(F.hash("_row")))
    return joined.withColumn("_nth", nth).where("_nth = 1 or _empty > 0").select("_row.*")
