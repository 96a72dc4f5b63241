"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected target / size of the source times. The running sum of these
expectations over the source's documents, plus one random offset, is cut at the integers: a
document is taken once for each integer crossed. Documents run in order of size, and those
above 1 / LARGE of the target are cut first: what they miss or exceed changes the expectation of
the others, so that a source gives its target to about 1 / LARGE as long as the others can.

Defined cases: a null or blank text has size 0 and is taken like any other, at no cost; null is a
source of its own, after all others; repeated rows are documents of their own; a source of size 0
has target 0 and none of its documents are taken; a very long text is a number, its size, and cut first
if it is large for its source's target; an empty table gives an empty result; further columns are ignored by ``plan_mix`` and kept by ``mix``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.session import written

#: A document of more than 1 / LARGE of its source's target is sampled before the others.
LARGE = 400


def word_count(text: Column) -> Column:
    """Number of words; null has none. ``translate`` first, as a plain blank splits much faster than a class."""
    plain = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.array_remove(F.split(plain, " "), "")).cast("long")


def source_targets(sizes: DataFrame, source: str, size: str, weights: Sequence[float], most: float) -> DataFrame:
    """``source``, ``source_size`` and ``target``, one row per source; runs small jobs.

    Targets share the total by weight but stop at ``most`` times their source's size; what is left
    over is shared again by weight among the others until none is above. All of it works on one
    row per source.
    """
    per_source = sizes.groupBy(source).agg(F.sum(size).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (place % len(weights) + 1).cast("int"))
    table = written(per_source.select(source, "source_size", weight.alias("_weight")), "sources")
    most_of = F.col("source_size") * F.lit(float(most))
    level = 0.0
    while True:
        full = most_of < F.col("_weight") * level
        total, capped, open_weight = table.agg(
            F.sum("source_size"),
            F.sum(F.when(full, most_of).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("_weight"))),
        ).head()
        after = (total - capped) / open_weight if open_weight else level
        if after <= level:
            break
        level = after
    return table.select(source, "source_size", F.least(most_of, F.col("_weight") * level).alias("target"))


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (1, 2, 3),
    most: float = 3.0,
    seed: int = 7,
) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` of every row.

    Reruns agree: neither order nor offset depend on how rows are dealt out. The running sums are
    counts per partition of a range sort, so that a source of any size is cut at any row.
    """
    sized = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")
    )
    shuffled = F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.lit(str(seed))))
    sort = ["source", "size", shuffled, "doc_id"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = sized.repartitionByRange(parts, *sort).withColumn("_part", F.spark_partition_id())
    rows = written(ranged, "sizes")
    targets = source_targets(rows, "source", "size", weights, most)

    spread = rows.select("source", "_part").distinct().join(
        targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))
    )
    large = F.col("size") * LARGE > F.col("target")
    rows = written(_beside(rows, spread.drop("_source"), ["source", "_part"]).withColumn("_large", large), "targets")

    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    drawn = F.md5(F.concat_ws(":", "source", F.lit(str(seed))))
    offset = (F.conv(F.substring(drawn, 1, 7), 16, 10).cast("double") + 0.5) / float(1 << 28)
    within = Window.partitionBy("source", "_part", "_large").orderBy("size", shuffled, "doc_id")
    rows = rows.withColumn("_row", F.row_number().over(within))
    earlier = Window.partitionBy("source", "_large").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("source", "_part", "_large").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    rows = _beside(rows, counts, ["source", "_part", "_large"])
    k = F.col("_before") + F.col("_row")
    cut = lambda i, r: F.floor(i * r + offset)
    first = rows.where("_large").withColumn("copies", (cut(k, rate) - cut(k - 1, rate)).cast("long"))

    # What the large documents miss or exceed is made up for by the others' expected copies.
    by_part = first.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("_took"), F.sum("size").alias("_of"))
    rest = _beside(
        rows.where("not _large").select("source", "_part").distinct(), by_part, ["source"], "left"
    ).select("source", "_part", F.coalesce("_took", F.lit(0)).alias("_took"), F.coalesce("_of", F.lit(0)).alias("_of"))
    others = _beside(rows.where("not _large"), rest, ["source", "_part"])
    left = F.col("source_size") - F.col("_of")
    rest_rate = F.when(left > 0, F.least(F.lit(float(most)), F.greatest(F.lit(0.0), (F.col("target") - F.col("_took")) / left)))
    rest_rate = F.coalesce(rest_rate, F.lit(0.0))
    second = others.withColumn("copies", (cut(k, rest_rate) - cut(k - 1, rest_rate)).cast("long"))
    names = ["doc_id", "source", "size", "source_size", "target", "copies"]
    return first.select(*names).unionByName(second.select(*names)).withColumn("taken", F.col("copies") * F.col("size"))


def _beside(rows: DataFrame, facts: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys of which the first may be null."""
    names = {key: f"_f{key}" for key in keys}
    on = reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in names.items()])
    return rows.join(facts.withColumnsRenamed(names), on, how).drop(*names.values())


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with their own columns.

    Rows of equal id, source and size are exchangeable to the plan; a number among them deals out
    its decisions.
    """
    id_col, text_col, source_col = (options.get(k, d) for k, d in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source")))
    same = ["_id", "_source", "_size"]
    plan = plan_mix(docs, **options).groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"))
    plan = plan.agg(F.array_sort(F.collect_list("copies")).alias("_copies"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), word_count(F.col(text_col)).alias("_size"),
    )
    joined = _beside(rows, plan, same)
    nth = F.row_number().over(Window.partitionBy(*same).orderBy(F.hash("_row")))
    once = F.size("_copies") == 1
    copies = F.when(once, F.col("_copies")[0]).otherwise(F.element_at("_copies", nth))
    kept = joined.withColumn("_taken", copies).where("_taken > 0")
    return kept.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_taken").cast("int")))).select("_row.*")
