"""URL filters: given rules first, then a tree of path templates judged by labelled pages.

Per host, paths become templates segment by segment. Runs of digits and long hexadecimal words are
wildcards by their form. Of a node with more than BRANCHES children, most of them rare (seen SEEN
times at most), the rare ones are generalised to ``*``. Of other children, those whose share of bad
labelled pages differs from that of all children by more than Z standard errors stay branches of their
own, and the rest is alike and merged to one branch ``~``. A template's share of bad pages is smoothed towards the share of all pages, which counts as
PRIOR labelled pages; at REJECT or more its pages are blocked.

The tree is as deep as the paths: rounds go on until no template has two paths with further
segments. Segments that all paths of a template have in common are one step, however many they are, so
rounds follow the branchings on a path. An end is a child as well, and a slash at a path's end does not
count.

All levels work on distinct paths with counts. Facts per node are written before they are joined,
so that both sides are plain shuffles and Spark can split a host that holds a third of all rows.

Defined cases: a null url or one without ``://`` has an empty host and path, and the template of
those; a null page id has no label; rows repeat freely; no labels at all block nothing beyond the
rules; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.session import scratch_scope, written

BRANCHES, SEEN, Z, PRIOR, REJECT = 20, 5, 2.0, 4.0, 0.5

# The contract's rules.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
_UPPER, _LOWER = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at, _, rest = rule.partition("/")
        fits = ((host == at) | F.endswith(host, F.lit(f".{at}"))) & F.startswith(path, F.lit(f"/{rest}"))
        found, verdict = F.when(fits, F.lit(rule)).otherwise(found), F.when(fits, F.lit(says)).otherwise(verdict)
    return found, verdict


def form_of(path: Column) -> Column:
    """The path with its variable parts replaced, without slashes around it."""
    plain = F.regexp_replace(path, r"(?<![0-9A-Za-z])(?=[0-9a-fA-F]*[0-9])(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{8,}(?![0-9A-Za-z])", "{x}")
    plain = F.regexp_replace(plain, r"[0-9]+", "{n}")
    return F.rtrim(F.regexp_replace(plain, "^/", ""), F.lit("/"))


def _joined(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    names = {k: f"_f{k}" for k in keys}
    on = reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in names.items()])
    return rows.join(facts.withColumnsRenamed(names), on).drop(*names.values())


def _in_common(low: Column, high: Column) -> Column:
    """The segments with which the least and the greatest of some lists, and so all of them, begin."""
    differ = F.array_position(F.zip_with(low, high, lambda a, b: a.eqNullSafe(b)), False).cast("int")
    return F.slice(low, F.lit(1), F.when(differ > 0, differ - 1).otherwise(F.size(low)))


def template_verdicts(paths: DataFrame) -> DataFrame:
    """``paths`` (host, form, n, labelled, bad: one row per distinct path) with ``template`` and
    ``bad_share``; runs jobs, a few for each round."""
    counts, settled = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")], []
    # {}: nothing between slashes
    parts = F.transform(F.split("form", "/"), lambda s: F.when(s == "", "{}").otherwise(s))
    rest = F.when(F.col("form") == "", F.array().cast("array<string>")).otherwise(parts)
    rows = written(paths.withColumn("template", F.col("host")).withColumn("rest", rest), "paths")
    while True:
        going = F.size("rest") > 0
        rows = rows.withColumn("segment", F.when(going, F.get("rest", F.lit(0))).otherwise(""))
        ends = [F.count_if(going).alias("_going"), F.min("rest").alias("_low"), F.max("rest").alias("_high")]
        children = written(rows.groupBy("template", "segment").agg(*counts, *ends), "children")
        parents = children.groupBy("template").agg(
            F.count(F.lit(1)).alias("_kinds"), F.sum((F.col("n") <= SEEN).cast("long")).alias("_rare"),
            F.sum("labelled").alias("_labelled"), F.sum("bad").alias("_bad"),
            (F.sum("_going") <= 1).alias("_done"),
        )
        judged = _joined(children, written(parents, "parents"), ["template"])
        pooled = F.when(F.col("_labelled") > 0, F.col("_bad") / F.col("_labelled")).otherwise(0.0)
        error = F.sqrt(pooled * (1 - pooled) / F.greatest(F.col("labelled"), F.lit(1)))
        apart = F.abs(F.col("bad") - pooled * F.col("labelled")) > Z * error * F.col("labelled")
        variable = (F.col("_kinds") > BRANCHES) & (F.col("_rare") * 2 > F.col("_kinds")) & (F.col("n") <= SEEN)
        branch = F.when(variable, "*").when(apart | (F.col("_kinds") == 1), F.col("segment")).otherwise("~")
        common = F.when((F.col("_kinds") == 1) & (F.col("_going") > 0), _in_common(F.col("_low"), F.col("_high")))
        taken = F.coalesce(common, F.array(branch))
        facts = judged.select("template", "segment", taken.alias("_taken"), "_done")
        rows = _joined(rows, written(facts, "branches"), ["template", "segment"])
        # one path among ends would have the same two children at all further steps
        left = F.slice("rest", F.size("_taken") + 1, F.greatest(F.size("rest") - F.size("_taken"), F.lit(0)))
        left = F.when(going, left).otherwise(F.array().cast("array<string>"))
        own = F.col("_done") & (F.get("_taken", F.lit(0)) == F.col("segment"))
        rows = rows.withColumn("template", F.concat_ws("/", "template", "_taken", F.when(own, left))).withColumn("rest", left)
        rows = written(rows.drop("_taken", "segment"), "paths")
        settled.append(rows.where("_done").drop("_done", "rest"))
        rows = rows.where("not _done").drop("_done")
        if rows.isEmpty():
            break
    rows = reduce(DataFrame.unionByName, settled)
    labelled, bad = rows.agg(F.sum("labelled"), F.sum("bad")).head()
    share = bad / labelled if labelled else 0.0
    stats = rows.groupBy("template").agg(F.sum("labelled").alias("_labelled"), F.sum("bad").alias("_bad"))
    smoothed = (F.col("_bad") + PRIOR * share) / (F.col("_labelled") + PRIOR)
    facts = stats.select("template", smoothed.alias("bad_share"))
    return _joined(rows, written(facts, "shares"), ["template"])


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """The contract's columns, ``template`` and ``bad_share`` for every row of ``pages``; runs jobs.

    ``labels`` has ``id`` and ``bad``, a boolean.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("form", form_of(F.col("path")))
    known = labels.where("id is not null").groupBy("id").agg(F.max(F.col("bad").cast("int")).alias("_bad"))
    marked = rows.join(written(known, "labels"), F.col("page_id") == F.col("id"), "left")
    paths = marked.groupBy("host", "form").agg(
        F.count(F.lit(1)).alias("n"), F.count("_bad").alias("labelled"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad")
    )
    with scratch_scope(pages.sparkSession):
        facts = template_verdicts(paths).select("host", "form", "template", "bad_share")
        facts = written(facts, "verdicts", outlives=True)
    judged = _joined(rows, facts, ["host", "form"])
    rule, says = longest_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bad_share") >= REJECT, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(says, method).alias("verdict"), "template", "bad_share"
    )
