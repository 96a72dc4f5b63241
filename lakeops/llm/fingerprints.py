"""Document fingerprints by consistent weighted sampling.

A text's terms are its words, weighted by how often they occur. For slot k and term w of weight x,
with r and c drawn from Gamma(2, 1) and b from [0, 1), all three by hashes of (w, k):

    t = floor(ln x / r + b),    ln a = ln c - r (t - b + 1)

The slot keeps (w, t) of the term with the least a. Two texts agree in a slot with a probability
equal to their generalised Jaccard similarity, sum of min weights / sum of max weights, so the
share of equal slots estimates it (standard error sqrt(J (1 - J) / SLOTS)). A slot is kept as 16
bits of a hash of (w, t).

A draw takes one of STEPS equal steps of the law and a place in it, between the quantiles at the step's
ends; in the TAIL highest steps of r and the TAIL lowest of c, where the least a of a long text comes
from, it comes from the law itself. (Between quantiles the error of r and ln c is below 0.005.) Slots
are rows, PER_ROW to each, not columns: a short expression is all that is compiled.

Everything is DataFrame functions. Rows are dealt into ranges of (id, hash of the text) once, each
range with a copy of the row that follows it, so that a document meets the next one without another
shuffle; terms are counted and sampled where the text is, those of a text and of its edited form
together, as they share their draws.

Defined cases: a null or blank text has no terms and the empty fingerprint, which is like another
empty one (1) and unlike all others (0); ids descend, null ids follow all others, rows of one id
are ordered by a hash of their text, and may be parted by it; the one row of a table is its own
next; a very long text has its terms counted in one task, which sorts and spills them; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm import common

SLOTS, PER_ROW, STEPS, TAIL = 64, 4, 512, 8
#: Ranges of so many bytes; larger ones, which sorting spills, beyond so many ranges.
SHARD_BYTES, MOST_SHARDS = 8 << 20, 50_000


def _gamma_quantiles(p: np.ndarray) -> np.ndarray:
    """Where the distribution function of Gamma(2, 1), 1 - (1 + x) exp(-x), reaches p; by bisection."""
    low, high = np.zeros(len(p)), np.full(len(p), 60.0)
    for _ in range(100):
        mid = (low + high) / 2
        below = 1 - (1 + mid) * np.exp(-mid) < p
        # near 0 the function is x^2 / 2 - x^3 / 3 + ..., which cancels less
        below = np.where(mid < 1e-3, mid**2 / 2 - mid**3 / 3 + mid**4 / 8 < p, below)
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return (low + high) / 2


#: Quantiles at the ends of the steps, the first and last a quarter of a step inside. They bound the
#: least r and the greatest c, which no slot keeps for their sake; the other tails come from the law.
_ENDS = _gamma_quantiles(np.clip(np.arange(STEPS + 1) / STEPS, 0.25 / STEPS, 1 - 0.25 / STEPS))
#: Where the TAIL highest steps begin.
_HIGH = float(_ENDS[STEPS - TAIL])


def _between(ends: np.ndarray, step: Column, place: Column) -> Column:
    """A value between the ends of a step."""
    table = F.split(F.lit(",".join(f"{v:.9g}" for v in ends)), ",").cast("array<double>")  # folded to a constant
    low = F.get(table, step)
    return low + (F.get(table, step + 1) - low) * place


def _uniform(bits: Column, shift: int = 0, width: int = 31) -> Column:
    """``width`` bits of a hash as a number in (0, 1)."""
    return (F.shiftrightunsigned(bits, shift).bitwiseAND((1 << width) - 1) + F.lit(0.5)) * F.lit(2.0**-width)


def _high_r(bits: Column, more: Column) -> Column:
    """Gamma(2, 1) above _HIGH, which exceeds it by Gamma(1, 1), or by Gamma(2, 1) once in _HIGH + 1 times."""
    twice = _uniform(more) < F.lit(1 / (_HIGH + 1))
    return F.lit(_HIGH) - F.ln(_uniform(bits) * F.when(twice, _uniform(more, 31)).otherwise(1.0))


def _low_ln_c(bits: Column) -> Column:
    """ln of Gamma(2, 1) in its TAIL lowest steps, where c^2 / 2 - c^3 / 3 + c^4 / 8 is the uniform number."""
    s = F.sqrt(_uniform(bits, 31) * F.lit(2.0 * TAIL / STEPS))
    return F.ln(s * (F.lit(1.0) + s / 3 + s * s * F.lit(11 / 72)))


def draws(term: Column, slot: Column) -> tuple[Column, Column, Column]:
    """r, b and ln c of a term in a slot."""
    x = F.xxhash64(term, slot)
    y = F.xxhash64(x)
    bits, more = (F.xxhash64(x, F.lit(k)) for k in (2, 3))  # of few terms
    step = lambda h: h.bitwiseAND(STEPS - 1).cast("int")
    r = F.when(step(x) >= STEPS - TAIL, _high_r(bits, more)).otherwise(_between(_ENDS, step(x), _uniform(x, 10, 24)))
    ln_c = F.when(step(y) < TAIL, _low_ln_c(bits)).otherwise(_between(np.log(_ENDS), step(y), _uniform(y, 10, 24)))
    return r, _uniform(x, 34, 30), ln_c


def sample(term: Column, ln_weight: Column, r: Column, b: Column, ln_c: Column) -> Column:
    """One slot's candidate of a term: ln a in the high bits, 16 bits that name (term, t) in the low
    ones; NULL without a weight."""
    t = F.floor(ln_weight / r + b)
    ln_a = ln_c - r * (t - b + 1)
    named = (term.bitwiseAND(0xFFFF) + t * 40503).bitwiseAND(0xFFFF)
    return F.shiftleft(F.floor(ln_a * F.lit(float(1 << 32))), 16).bitwiseOR(named)


def words_of(text: Column) -> Column:
    plain = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.array_remove(F.split(plain, " "), "")


def signatures(texts: DataFrame, keys: list[str], columns: list[str], slots: int = SLOTS) -> DataFrame:
    """``keys``, and the fingerprint of each text column of ``columns`` under the column's name, for each
    row of ``texts``, which ``keys`` tell apart.

    Rows that lie together by a prefix of ``keys`` are not shuffled.
    """
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("text")) for k, c in enumerate(columns)])).alias("_v")
    words = texts.select(*keys, kinds).select(*keys, "_v.kind", F.explode_outer(words_of(F.col("_v.text"))).alias("_word"))
    terms = words.select(*keys, "kind", F.when(F.col("_word").isNotNull(), F.xxhash64("_word")).alias("_term"))
    times = [F.nullif(F.count_if(F.col("kind") == k), F.lit(0)).alias(f"_n{k}") for k in range(len(columns))]
    counts = terms.groupBy(*keys, "_term").agg(*times)
    # A null term has no weight: it only keeps a row for a text without words.
    weights = [F.when(F.col("_term").isNotNull(), F.ln(F.col(f"_n{k}").cast("double"))).alias(f"_ln{k}") for k in range(len(columns))]
    groups = -(-slots // PER_ROW)
    spread = counts.select(*keys, "_term", *weights, F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_group"))
    least = []
    for j in range(PER_ROW):
        drawn = draws(F.col("_term"), F.col("_group") * PER_ROW + j)
        least += [F.min(sample(F.col("_term"), F.col(f"_ln{k}"), *drawn)).alias(f"_s{k}_{j}") for k in range(len(columns))]
    found = spread.groupBy(*keys, "_group").agg(*least)
    # A text without words has no marks.
    mark = lambda c: F.when(F.col(c).isNotNull(), F.lpad(F.lower(F.hex(F.col(c).bitwiseAND(0xFFFF))), 4, "0"))
    own = [F.concat_ws("", *[mark(f"_s{k}_{j}") for j in range(PER_ROW)]) for k in range(len(columns))]
    whole = found.groupBy(*keys).agg(*[F.array_sort(F.collect_list(F.struct("_group", m.alias("m")))).alias(f"_m{k}") for k, m in enumerate(own)])
    shown = [F.substring(F.array_join(F.transform(f"_m{k}", lambda x: x.m), ""), 1, 4 * slots).alias(c) for k, c in enumerate(columns)]
    return whole.select(*keys, *shown)


def likeness(a: Column, b: Column, slots: int = SLOTS) -> Column:
    """Share of equal slots of two fingerprints."""
    place = lambda c, k: F.substring(c, 4 * k + 1, 4)
    equal = sum((F.when(place(a, k) == place(b, k), 1).otherwise(0) for k in range(slots)), F.lit(0))
    empty = (F.length(a) == 0) | (F.length(b) == 0)
    return F.when(empty, (a == b).cast("double")).otherwise(equal / F.lit(float(slots)))


def _ranges(rows: DataFrame, shards: int) -> tuple[DataFrame, int]:
    """``rows`` with ``_shard``, ranges of descending (_order, _tie) of about equal numbers, and how many
    there are; runs small jobs. An id that fills several ranges alone is parted by its ties, which are
    hashes of texts, so only rows alike in both stay together."""
    marks = [k / shards for k in range(1, shards)]
    found = rows.agg(F.percentile_approx("_order", marks, max(10_000, 10 * shards))).head()[0] if marks else []
    bounds, times = np.unique(np.array(found or [], np.int64), return_counts=True)
    hot = [(int(b), int(n)) for b, n in zip(bounds, times) if n > 1]
    cuts: dict[int, list[int]] = {}
    if hot:  # fewer than shards
        spark = rows.sparkSession
        known = F.broadcast(spark.createDataFrame(hot, "_hot long, _parts int"))
        ties = rows.select("_order", "_tie").join(known, F.col("_order") == F.col("_hot"))
        most = max(n for _, n in hot)
        inside = ties.groupBy("_hot").agg(F.percentile_approx("_tie", [k / most for k in range(1, most)], 10 * most).alias("at")) if most > 1 else None
        quantiles = {r["_hot"]: r["at"] for r in inside.collect()}
        for b, n in hot:
            own = quantiles[b]
            cuts[b] = sorted({own[min(len(own) - 1, max(0, round(k * most / n) - 1))] for k in range(1, n)})
    starts = np.concatenate([[0], np.cumsum([len(cuts.get(int(b), [])) for b in bounds])]).astype(int)  # ranges that ties add below
    below = common.range_of(F.col("_order"), [int(b) for b in bounds])  # how many bounds are at or below
    sums = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<int>")  # folded to a constant
    added = F.element_at(sums, below + 1) if cuts else F.lit(0)
    place = below + added
    if cuts:
        table = F.broadcast(rows.sparkSession.createDataFrame(list(cuts.items()), "_cut long, _cuts array<long>"))
        rows = rows.join(table, F.col("_order") == F.col("_cut"), "left").drop("_cut")
        # a hot id is a bound itself: its ties count down from all that it adds
        above = F.coalesce(F.size(F.filter("_cuts", lambda c: c > F.col("_tie"))), F.lit(0))
        place = place - F.when(F.col("_cuts").isNotNull(), above).otherwise(0)
    ranges = len(bounds) + int(starts[-1])
    return rows.withColumn("_shard", (F.lit(ranges) - place).cast("int")).drop("_cuts"), ranges + 1


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """The contract's columns for every row of ``docs``; runs small jobs over the ids."""
    # The order stands for the id, so that all uses of the dealt rows have the same columns and share a shuffle.
    none = F.lit(-(1 << 63))
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), none).alias("_order"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.col(id_col).isNull().alias("_unnamed"),
    )
    tie = F.shiftrightunsigned(F.xxhash64("text"), 1)
    rows = rows.select("_order", "text", F.when(F.col("_unnamed"), -1 - tie).otherwise(tie).alias("_tie"))  # null ids are behind the least id
    shards = max(1, min(MOST_SHARDS, common.text_bytes(rows) // SHARD_BYTES))
    rows, ranges = _ranges(rows, shards)

    # Each range gets the first row of the next one that has any; the last gets the first row of all.
    first_of = F.max(F.struct("_order", "_tie")).alias("top")
    heads = sorted((r["_shard"], r["top"]["_order"], r["top"]["_tie"]) for r in rows.groupBy("_shard").agg(first_of).collect())
    before = [(s, top, tie, heads[k - 1][0]) for k, (s, top, tie) in enumerate(heads)]
    tops = rows.sparkSession.createDataFrame(before, "_of int, _top long, _first long, _to int")
    first = Window.partitionBy("_shard").orderBy(F.xxhash64("text"))
    on = (F.col("_shard") == F.col("_of")) & (F.col("_order") == F.col("_top")) & (F.col("_tie") == F.col("_first"))
    ghosts = (
        rows.join(F.broadcast(tops), on)
        .withColumn("_nth", F.row_number().over(first))
        .where("_nth = 1")
        .select("_order", "text", "_tie", F.col("_to").alias("_shard"), F.lit(True).alias("_ghost"))
    )
    dealt = rows.withColumn("_ghost", F.lit(False)).unionByName(ghosts).repartitionById(ranges, "_shard")
    order = Window.partitionBy("_shard").orderBy("_ghost", F.desc("_order"), F.desc("_tie"))
    third = F.floor(F.length("text") / 3).cast("int")
    kept = F.expr("left(text, length(text) - cast(floor(length(text) / 3) as int))")
    placed = dealt.select(
        "*", F.row_number().over(order).alias("_row"), F.lead("text").over(order).alias("_next")
    ).withColumn("_edited", F.coalesce(F.concat(kept, F.substring(F.col("_next"), F.lit(1), third)), F.lit("")))

    texts = placed.select("_shard", "_row", F.col("text").alias("fingerprint"), F.col("_edited").alias("edited_fingerprint"))
    marked = signatures(texts, ["_shard", "_row"], ["fingerprint", "edited_fingerprint"], slots)
    after = F.lead("fingerprint").over(Window.partitionBy("_shard").orderBy("_row"))
    paired = marked.withColumn("_after", after).withColumnsRenamed({"_shard": "_s", "_row": "_r"})
    base = placed.where("not _ghost").select(
        F.when(F.col("_tie") >= 0, F.col("_order")).alias("doc_id"), F.length("text").cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"), "_shard", "_row",
    )
    return base.join(paired, (F.col("_shard") == F.col("_s")) & (F.col("_row") == F.col("_r"))).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), slots).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_after"), slots).alias("near_next"),
    )
